"""From pipeline rows to a modelling dataset: ids, near-duplicates, bins and splits.

Ties have a total order: duplicates keep the row with most targets, then the least id;
splits follow the MD5 of seed and row id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from casequarry.functions.md5 import first_words

SHINGLE, HASHES = 5, 64
NO_FINGERPRINT = "0" * 16


def row_id(search_result_id: Column, build_id: Column, text: Column) -> Column:
    """First 16 hex digits of SHA-256 of id, build and the first 2,000 characters."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (search_result_id, build_id, F.substring(text, 1, 2000))]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def text_sha1(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 16)


def parsed_targets(targets_json: Column) -> Column:
    """A JSON list of ids as an array; null or malformed text is empty."""
    return F.coalesce(F.from_json(targets_json, "array<string>"), F.array().cast("array<string>"))


def cardinality_bin(n: Column) -> Column:
    return F.when(n <= 1, "1").when(n <= 3, "2-3").when(n <= 7, "4-7").otherwise("8+")


#: Characters of texts whose shingles are hashed together.
_CHARACTERS = 1 << 20


def _shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles as rows of code points, the shingles of all texts as places among them, and each text's first."""
    sizes = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    ends = np.cumsum(sizes)
    counts = np.maximum(sizes - SHINGLE + 1, 0)
    starts = np.repeat(ends - sizes - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    alphabet, letter = np.unique(points, return_inverse=True)
    wide = len(alphabet)
    if wide**SHINGLE < 1 << 63:
        key = np.zeros(len(starts), np.int64)
        for k in range(SHINGLE):
            key = key * wide + letter[starts + k]
        _, first, place = np.unique(key, return_index=True, return_inverse=True)
    else:
        rows = np.ascontiguousarray(points[starts[:, None] + np.arange(SHINGLE)])
        _, first, place = np.unique(rows.view(f"V{4 * SHINGLE}").ravel(), return_index=True, return_inverse=True)
    return points[starts[first][:, None] + np.arange(SHINGLE)], place.ravel(), np.cumsum(counts) - counts


def _hashed(rows: np.ndarray) -> np.ndarray:
    """The hashes of shingles (rows of code points), one row for each seed."""
    if not len(rows):
        return np.empty((HASHES, 0), np.uint32)
    said = [r.tobytes().decode("utf-32-le").encode() for r in rows]
    sizes = np.array([len(s) for s in said])
    body = np.zeros((len(said), int(sizes.max())), np.uint8)
    body[np.arange(body.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(said), np.uint8)
    out = np.empty((HASHES, len(said)), np.uint32)
    for seed in range(HASHES):
        prefix = np.frombuffer(b"%d:" % seed, np.uint8)
        messages = np.concatenate((np.broadcast_to(prefix, (len(said), len(prefix))), body), axis=1)
        out[seed] = first_words(messages, sizes + len(prefix))
    return out


def _minima(texts: list[str]) -> np.ndarray:
    """HASHES minima of each text, which has a shingle; a shingle of several texts is hashed once."""
    rows, place, first = _shingles(texts)
    out = np.full((HASHES, len(texts)), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(rows), _KEPT):  # as many hashes as a worker keeps
        hashes = _hashed(rows[lo : lo + _KEPT])
        own = (place >= lo) & (place < lo + _KEPT)
        near = np.where(own, place - lo, 0)
        for seed in range(HASHES):
            out[seed] = np.minimum(out[seed], np.minimum.reduceat(np.where(own, hashes[seed][near], np.uint32(0xFFFFFFFF)), first))
    return out.T


#: Shingles whose hashes a worker keeps (4 * HASHES bytes each), slots of the table for each of them, bits of a letter in a shingle's key, rows that are met at once.
_KEPT, _SLOTS, _LETTER, _ROWS = 1 << 18, 4, 12, 1024


class _Hashes:
    """The HASHES hashes of shingles met so far, so that a shingle is hashed about once a worker.

    When it is full, few others are hashed for their texts only, and it begins anew where many are needed.
    Letters are numbered as they come, so a shingle is one number; an open table of such numbers leads to its row.
    """

    def __init__(self):
        self.rows = np.empty((_KEPT + _KEPT // 4, HASHES), np.uint32)
        self.slots = 1 << (_KEPT * _SLOTS - 1).bit_length()
        self.number = np.full(0x110000, -1, np.int64)
        self.clear()

    def clear(self) -> None:
        self.number[:] = -1
        self.points = np.zeros(0, np.uint32)
        self.keys, self.row = np.full(self.slots, -1, np.int64), np.zeros(self.slots, np.int32)
        self.used = 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(self.slots - 1)).view(np.int64)

    def _rows_of(self, keys: np.ndarray) -> np.ndarray:
        """Each key's row, or -1."""
        slot, out = self._slot(keys), np.full(len(keys), -1, np.int32)
        there = self.keys[slot]
        hit = there == keys
        out[hit] = self.row[slot[hit]]
        left = np.flatnonzero(~hit & (there >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (self.slots - 1)
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self.row[slot[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out

    def _add(self, keys: np.ndarray) -> None:
        """Hash distinct new keys behind the used rows, and keep as many as there is room for."""
        rows = np.arange(self.used, self.used + len(keys))
        letters = (keys[:, None] >> (_LETTER * np.arange(SHINGLE - 1, -1, -1))) & ((1 << _LETTER) - 1)
        self.rows[rows] = _hashed(self.points[letters]).T
        keys = keys[: _KEPT - self.used]
        self.used += len(keys)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            self.keys[slot[free]] = keys[free]  # of several for one slot the last one stays
            self.row[slot[free]] = rows[free]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & (self.slots - 1)

    def minima(self, texts: list[str]) -> np.ndarray | None:
        """HASHES minima of each text, which has a shingle; None if the texts have more letters or shingles than are kept."""
        sizes = np.array([len(t) for t in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        for _ in range(2):  # as it is, or begun anew
            new = np.unique(points[self.number[points] < 0])
            if len(self.points) + len(new) <= 1 << _LETTER:
                self.number[new] = len(self.points) + np.arange(len(new))
                self.points = np.concatenate((self.points, new))
                letter = self.number[points]
                key = np.zeros(len(points) - SHINGLE + 1, np.int64)
                for k in range(SHINGLE):
                    key = (key << _LETTER) | letter[k : k + len(key)]
                ends = np.cumsum(sizes)
                within = np.ones(len(key), bool)  # not from one text into the next
                for k in range(1, SHINGLE):
                    within[ends[:-1] - k] = False
                key = key[within]
                place = self._rows_of(key)
                unknown = place < 0
                fresh, nth = np.unique(key[unknown], return_inverse=True)
                if self.used + len(fresh) <= len(self.rows):
                    place[unknown] = self.used + nth
                    self._add(fresh)
                    return self._least(place, sizes - SHINGLE + 1)
            self.clear()
        return None

    def _least(self, place: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.full((len(counts), HASHES), 0xFFFFFFFF, np.uint32)
        some = np.empty((_ROWS, HASHES), np.uint32)
        ends = np.cumsum(counts).tolist()
        for n, (lo, hi) in enumerate(zip([0, *ends], ends, strict=False)):
            for at in range(lo, hi, _ROWS):
                own = place[at : min(hi, at + _ROWS)]
                np.take(self.rows, own, axis=0, out=some[: len(own)], mode="clip")
                np.minimum(out[n], some[: len(own)].min(axis=0), out=out[n])
        return out


@lru_cache(1)
def _hashes() -> _Hashes:
    return _Hashes()


def fingerprints_of(texts: list[str | None]) -> list[str]:
    """MinHash signature of each text's character shingles, hashed to 16 hex digits.

    Equal only if all minima agree.  The 64 minima come from the first 32 bits of MD5
    over ``seed:shingle``, so they can be checked against any other implementation.
    """
    clean = [(t or "").lower().strip() for t in texts]
    out = [NO_FINGERPRINT] * len(texts)
    long = [i for i, t in enumerate(clean) if len(t) >= SHINGLE]
    cuts = np.searchsorted(np.cumsum([len(clean[i]) for i in long]) // _CHARACTERS, np.arange(sum(len(clean[i]) for i in long) // _CHARACTERS + 2))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        own = long[lo:hi]
        if not own:
            continue
        some = [clean[i] for i in own]
        least = _hashes().minima(some)
        for i, minima in zip(own, (_minima(some) if least is None else least).tolist(), strict=True):
            out[i] = hashlib.sha256(str(minima).encode()).hexdigest()[:16]
    return out


def fingerprint(text: str | None) -> str:
    return fingerprints_of([text])[0]


@F.arrow_udf(StringType())
def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """``fingerprint`` of each text; equal texts of a batch are hashed once."""
    for batch in batches:
        coded = batch.dictionary_encode()
        known = np.array([*fingerprints_of(coded.dictionary.to_pylist()), NO_FINGERPRINT], object)
        codes = coded.indices.fill_null(len(known) - 1).to_numpy(zero_copy_only=False)
        yield pa.array(known[codes], pa.string())


def keep_best(rows: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """One row of each key, the first by ``order``.  Row-number filters are cut off per task before the shuffle."""
    place = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def deduplicate(rows: DataFrame, id_col: str = "search_result_id", text_col: str = "facts_text_masked", targets_col: str = "targets") -> DataFrame:
    """By id, then by fingerprint, each time keeping the row with most targets and then the least id.

    Of rows with equal texts (by the whole SHA-1) one goes on, so no text is hashed twice.  Fingerprints cost far more
    time than bytes, so the rest are dealt out to all tasks first.
    """
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.size(targets_col).desc(), F.col(id_col).asc_nulls_last()]
    by_id = keep_best(rows, F.col(id_col), order)
    by_text = keep_best(by_id, F.sha1(F.coalesce(F.col(text_col), F.lit(""))), order)
    marked = by_text.repartition(tasks).withColumn("_mark", fingerprints(text_col))
    return keep_best(marked, F.col("_mark"), order).drop("_mark")


def ranked(rows: DataFrame, group: str, order: Column, name: str) -> DataFrame:
    """Adds ``name``, the place of each row in its group by ``order``, and ``<name>_of``, the group's size.

    ``order`` must be a hex digest.  A group may hold most rows, so places are built from
    counts of the digests' first three digits and a number within these; no task sees
    more than a 4,096th of a group.
    """
    keyed = rows.withColumn("_order", order).withColumn("_slot", F.substring("_order", 1, 3))
    slots = keyed.groupBy(F.col(group).alias("_g"), F.col("_slot").alias("_s")).agg(F.count("*").alias("_n"))
    every = W.partitionBy("_g")
    slots = slots.select(
        "_g", "_s", (F.sum("_n").over(every.orderBy("_s")) - F.col("_n")).alias("_before"), F.sum("_n").over(every).alias(f"{name}_of")
    )
    within = F.row_number().over(W.partitionBy(group, "_slot").orderBy("_order"))
    return (
        keyed.withColumn("_within", within)
        .join(slots, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_slot") == F.col("_s")))
        .withColumn(name, F.col("_within") + F.col("_before"))
        .drop("_order", "_slot", "_g", "_s", "_before", "_within")
    )


def split(rows: DataFrame, bin_col: str = "label_cardinality_bin", id_col: str = "row_id", train: float = 0.7, val: float = 0.15, seed: int = 42) -> DataFrame:
    """Adds ``split``: in each bin the first max(1, int(train n)) rows, the next int(val n), the rest test.

    If no row falls to test and there are more than two rows, the last train row does.
    """
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))
    placed = ranked(rows, bin_col, order, "_rank")
    n = F.col("_rank_of")
    first = F.greatest(F.lit(1), F.floor(n * train + 1e-9))
    named = placed.withColumn(
        "split", F.when(F.col("_rank") <= first, "train").when(F.col("_rank") <= first + F.floor(n * val + 1e-9), "val").otherwise("test")
    )
    # The totals follow from the groups' sizes.
    size = F.col("_size")
    heads = F.least(size, F.greatest(F.lit(1), F.floor(size * train + 1e-9)))
    tests = F.greatest(F.lit(0), size - heads - F.floor(size * val + 1e-9))
    sizes = rows.groupBy(F.col(bin_col).alias("_bin")).agg(F.count("*").alias("_size"))
    whole = sizes.agg(F.sum("_size").alias("_all"), F.sum(tests).alias("_tests"), F.max(F.struct("_bin", heads.alias("_head"))).alias("_last"))
    last = F.col(bin_col).eqNullSafe(F.col("_last._bin")) & (F.col("_rank") == F.col("_last._head"))
    moved = (F.col("_tests") == 0) & (F.col("_all") > 2) & last
    # One row of totals.
    return named.crossJoin(F.broadcast(whole)).withColumn("split", F.when(moved, "test").otherwise(F.col("split"))).drop("_rank", "_rank_of", "_all", "_tests", "_last")


def load_dataset(rows: DataFrame, dedupe: bool = True, with_split: bool = True, min_targets: int = 1, seed: int = 42) -> DataFrame:
    """The modelling dataset from pipeline rows: targets, filter, ids, bins, duplicates, split."""
    out = rows.withColumn("targets", parsed_targets(F.col("targets_case_ids"))).withColumn("label_cardinality", F.size("targets"))
    out = out.where(F.col("label_cardinality") >= min_targets)
    build = F.col("build_id") if "build_id" in rows.columns else F.lit("")
    out = out.withColumn("row_id", row_id(F.col("search_result_id"), build, F.col("facts_text_masked")))
    out = out.withColumn("label_cardinality_bin", cardinality_bin(F.col("label_cardinality")))
    out = deduplicate(out) if dedupe else out
    return split(out, seed=seed) if with_split else out
