"""Benchmark decontamination by winnowing.

Documents and benchmark items are cut into lower-case words.  Both sides keep the
least hash of every run of consecutive k-grams; a shared span of ``window`` words
always holds one shared kept hash.  Kept document hashes go through a fixed-size bit set
of the benchmark's, which only spares moving most of them, and are joined with the
benchmark's hashes.  Hits are extended to every window around them, and these windows
are joined with the benchmark's on their full text, so neither hash collisions nor the
bit set can change a result.

Defined results: a null or wordless text has no words and no hits.  An item of fewer
words than ``window`` is one window of all its words; an item without words is never
found.  Repeated document rows each get their own result row; repeated items count
once by id; a null item id is left out of the item list.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from casequarry.llm import common as C

WINDOW = 10
#: Words of a hashed k-gram; a run of WINDOW - KGRAM + 1 k-grams covers WINDOW words.
KGRAM = 5

_CANDS = pa.list_(pa.struct([("w", pa.string()), ("n", pa.int32()), ("starts", pa.list_(pa.int32())), ("marks", pa.list_(pa.int64()))]))
_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


@F.arrow_udf(ArrayType(StructType().add("s", IntegerType()).add("e", IntegerType())))
def _united(column: pa.Array) -> pa.Array:
    """Lists of spans, in order, as lists of the ranges that they cover together."""
    offsets, values = column.offsets.to_numpy(), column.values
    s, e = (values.field(i).to_numpy().astype(np.int64) for i in (0, 1))
    out = []
    for i in range(len(column)):
        a, b = s[offsets[i] : offsets[i + 1]], e[offsets[i] : offsets[i + 1]]
        reach = np.maximum.accumulate(b)
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(a)), bool), a[1:] > reach[:-1])))
        ends = reach[np.concatenate((first[1:] - 1, [len(a) - 1]))] if len(a) else reach
        out.append([{"s": int(p), "e": int(q)} for p, q in zip(a[first], ends, strict=True)] if column[i].is_valid else None)
    return pa.array(out, _SPANS)


def _hashed(texts: C.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    low = C.lower_bytes(texts.data)
    starts, ends, counts = C.words(texts, C.ALNUM, low)
    return low, starts, ends, counts, C.span_hash(C.byte_sums(low), starts, ends)


def _window_text(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: int, n: int) -> str:
    return b" ".join(low[starts[i] : ends[i]].tobytes() for i in range(at, at + n)).decode("utf-8")


def _benchmark_rows(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in C.passes(batch.column(1)):
                ids = batch.column(0).slice(at, len(texts)).to_pylist()
                at += len(texts)
                low, starts, ends, counts, hashes = _hashed(texts)
                first = np.cumsum(counts) - counts
                rows: list[tuple] = []
                for i, item in enumerate(ids):
                    n, lo = int(counts[i]), int(first[i])
                    if n == 0:
                        continue
                    size = min(n, window)
                    if n >= window:
                        h, f = C.kgrams(hashes[lo : lo + n], np.array([n]), k)
                        marks = h[C.winnow(h, f, window - k + 1)]
                    else:
                        marks, _ = C.kgrams(hashes[lo : lo + n], np.array([n]), n)
                    rows += [(item, None, size, int(m)) for m in marks.astype(np.int64)]
                    rows += [(item, _window_text(low, starts, ends, lo + s, size), size, None) for s in range(n - size + 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], batch.column(0).type),
                        pa.array([r[1] for r in rows], pa.string()),
                        pa.array([r[2] for r in rows], pa.int32()),
                        pa.array([r[3] for r in rows], pa.int64()),
                    ],
                    names=["item_id", "w", "n", "mark"],
                )

    return run


def _candidates(window: int, k: int, short: list[int], shared):
    @F.arrow_udf("n_words bigint, cands array<struct<w:string,n:int,starts:array<int>,marks:array<bigint>>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bits = shared.value
        for column in batches:
            totals: list[np.ndarray] = []
            found: list[list[dict]] = []
            for texts in C.passes(column):
                low, starts, ends, counts, hashes = _hashed(texts)
                totals.append(counts)
                owner = np.repeat(np.arange(len(counts)), counts)
                limit = np.cumsum(counts)
                picks: list[tuple[int, np.ndarray, np.ndarray]] = []
                h, f = C.kgrams(hashes, counts, k)
                keep = C.winnow(h, f, window - k + 1)
                keep = keep[C.in_filter(bits, h[keep])]
                if len(keep):  # every window of the same text around a kept k-gram
                    around = (f[keep][:, None] - np.arange(window - k + 1)).ravel()
                    marks = np.repeat(h[keep], window - k + 1)
                    inside = (around >= 0) & (around + window <= len(owner))
                    around, marks = around[inside], marks[inside]
                    inside = owner[around] == owner[around + window - 1]
                    picks.append((window, around[inside], marks[inside]))
                for n in short:
                    h, f = C.kgrams(hashes, counts, n)
                    inside = C.in_filter(bits, h)
                    picks.append((n, f[inside], h[inside]))
                rows: list[dict[tuple[str, int], tuple[set[int], set[int]]]] = [{} for _ in counts]
                for n, where, marks in picks:
                    for s, mark in zip(where.tolist(), marks.view(np.int64).tolist(), strict=True):
                        doc = int(owner[s])
                        seen, by = rows[doc].setdefault((_window_text(low, starts, ends, s, n), n), (set(), set()))
                        seen.add(s - int(limit[doc] - counts[doc]))
                        by.add(mark)
                found += [[{"w": w, "n": n, "starts": sorted(v), "marks": list(m)} for (w, n), (v, m) in r.items()] for r in rows]
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate(totals) if totals else [], pa.int64()), pa.array(found, _CANDS)],
                names=["n_words", "cands"],
            )

    return find


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = KGRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items, spans.

    ``spans`` lists the hit word ranges as (start, end) structs in order.
    """
    spark = docs.sparkSession
    C.tune(spark)
    items = benchmark.select(F.col("item_id"), F.col("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    marked = C.written(
        items.mapInArrow(_benchmark_rows(window, k), f"item_id {kind}, w string, n int, mark bigint")
    )
    short = sorted(r[0] for r in marked.where(F.col("n") < window).select("n").distinct().collect())  # at most window - 1
    bits = spark.sparkContext.broadcast(C.membership_filter(marked.where("mark is not null"), "mark"))

    find = _candidates(window, k, short, bits)
    scanned = C.written(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
        .select("doc_id", find("t").alias("f"))
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", "f.n_words", "f.cands")
    )
    kept = scanned.where(F.size("cands") > 0).select("row", F.explode("cands").alias("c")).select("row", "c.w", "c.n", "c.starts", F.explode("c.marks").alias("mark"))
    # The benchmark's side is written before each join, so that a common phrase's rows can be split where it is not sent to all tasks.
    met = kept.join(C.written(marked.where("mark is not null").select("mark", "n").distinct()), ["mark", "n"], "left_semi")
    cands = C.written(met.groupBy("row", "w", "n").agg(F.first("starts").alias("starts")))
    windows = C.written(marked.where("w is not null").select("w", "n", F.col("item_id").cast("string").alias("item")).distinct())
    hits = cands.join(C.written(windows.select("w", "n").distinct()), ["w", "n"], "left_semi")
    spans = hits.groupBy("row").agg(
        F.array_sort(
            F.flatten(F.collect_list(F.transform("starts", lambda s: F.struct(s.alias("s"), (s + F.col("n")).alias("e")))))
        ).alias("found")
    )
    found = (
        cands.join(windows, ["w", "n"])
        .select("row", "item")
        .distinct()
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    covered = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + (x["e"] - x["s"]))
    none = F.array().cast("array<string>")
    return (
        scanned.select("row", "doc_id", "n_words")
        .join(spans.select("row", _united("found").alias("spans")), "row", "left")
        .join(found, "row", "left")
        .withColumn("items", F.coalesce("items", none))
        .select(
            "doc_id",
            "n_words",
            F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_hit"),
            F.size("items").cast("bigint").alias("n_items"),
            "items",
            "spans",
        )
    )
