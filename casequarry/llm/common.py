"""Shared helpers: tables in the shared folder, ASCII folding and byte-level text batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of text that one numpy pass works on; longer texts form a pass of their own.
PASS_BYTES = 1 << 20
#: Rows and bytes of an Arrow batch sent to a Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches small so that a worker's memory does not follow text length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    A temporary folder stands in only where all tasks run on the driver's machine, as in local tests.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="casequarry-checkpoint-"))
    return sc.getCheckpointDir()


#: Lets the shuffle files of a finished execution go at once; unset is the same as false.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def new_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def save(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write compressed Parquet; the shuffle files of doing so go at once."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    finally:
        conf.set(_CLEANUP, before)


def written(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read it back."""
    path = new_path(df.sparkSession)
    save(df, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["folder"] = path
    return out


def remove(*frames: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.__dict__["folder"])
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; pure ASCII texts take the faster built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def hash128(value: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of one string."""
    return F.xxhash64(value), F.xxhash64(F.lit(7), value)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Texts:
    """UTF-8 bytes of a run of texts: ``data`` with ``starts`` (one more than texts)."""

    __slots__ = ("data", "starts")

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        self.data, self.starts = data, starts

    def __len__(self) -> int:
        return len(self.starts) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i + 1]].tobytes()


def passes(column: pa.Array, size: int = PASS_BYTES) -> Iterator[Texts]:
    """Cut an Arrow string column into runs of about ``size`` bytes; nulls become empty."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    n = len(column)
    if not n:
        return
    bufs = column.buffers()
    ends = np.frombuffer(bufs[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, side="right")) - 1)
        to = min(to, n)
        yield Texts(data[ends[at] : ends[to]], ends[at : to + 1] - ends[at])
        at = to


def lower_bytes(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def byte_class(pattern_bytes: str) -> np.ndarray:
    """Lookup table of the bytes that belong to a class, given as latin-1 text."""
    table = np.zeros(256, bool)
    table[np.frombuffer(pattern_bytes.encode("latin-1"), np.uint8)] = True
    return table


#: Word bytes of the decontamination contract: digits, lower-case letters, all of non-ASCII.
ALNUM = byte_class("".join(map(chr, [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])))
#: Everything but the six ASCII spaces.
NONSPACE = ~byte_class(" \t\n\x0b\x0c\r")


def words(texts: Texts, table: np.ndarray, data: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number per text of the maximal runs of bytes in ``table``."""
    data = texts.data if data is None else data
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[texts.starts] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    counts = np.diff(np.searchsorted(starts, texts.starts))
    return starts, ends, counts


BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_TABLE = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, PASS_BYTES * 2)
        for name, base in (("up", BASE), ("down", INVERSE)):
            values = np.full(size, base, np.uint64)
            values[0] = 1
            _powers[name] = np.cumprod(values, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values[i] * base**i`` modulo 2**64, with a leading zero."""
    up, _ = _power(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def byte_sums(data: np.ndarray) -> np.ndarray:
    return prefix_sums(_TABLE[data])


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans, equal for equal contents wherever they stand."""
    _, down = _power(len(sums))
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def kgrams(word_hash: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``k`` words within one text."""
    n = len(word_hash)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums = prefix_sums(word_hash)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.flatnonzero(owner[: n - k + 1] == owner[k - 1 :])
    return span_hash(sums, first, first + k), first


def _sliding(values: np.ndarray, size: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) of every run of ``size`` values, by runs of doubling length."""
    have = 1
    while 2 * have <= size:
        values, have = least(values[: len(values) - have], values[have:]), 2 * have
    return least(values[: len(values) - (size - have)], values[size - have :]) if have < size else values


def winnow(hashes: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """Indices of the least hashes of each run of ``window`` consecutive k-grams.

    ``first`` has the k-grams' word positions; a gap marks the next text.  Texts with
    fewer k-grams than ``window`` keep all of them.  Two texts that share ``window``
    consecutive k-grams share a chosen one.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    cut = np.flatnonzero(np.diff(first) != 1) + 1
    sizes = np.diff(np.concatenate(([0], cut, [n])))
    chosen = np.repeat(sizes < window, sizes)
    if n >= window:
        run = np.repeat(np.arange(len(sizes)), sizes)
        low = _sliding(hashes, window, np.minimum)
        low[run[: n - window + 1] != run[window - 1 :]] = 0
        # A k-gram is the least of some run exactly if the greatest of its runs' least is its own.
        ends = np.zeros(window - 1, low.dtype)
        chosen |= _sliding(np.concatenate((ends, low, ends)), window, np.maximum) == hashes
    return np.flatnonzero(chosen)


#: Bits of the fixed-size membership filter: 2 MiB whatever the input.
FILTER_BITS = 1 << 24


def membership_filter(keys: DataFrame, column: str, size: int = FILTER_BITS) -> np.ndarray:
    """A bit set over ``key mod size``, a power of two.

    It has false positives and no false negatives, so it only saves work: what passes
    is still joined.  At most size / 64 rows of 12 bytes reach the driver, however many
    keys there are.
    """
    slot = F.pmod(F.col(column), F.lit(size))
    words_ = (
        keys.select(F.shiftright(slot, 6).cast("int").alias("w"), (slot % 64).cast("int").alias("b"))
        .groupBy("w")
        .agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(size // 64, np.int64)
    out[words_["w"].to_numpy()] = words_["bits"].to_numpy()
    return out


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes & np.uint64(64 * len(bits) - 1)).astype(np.int64)
    return (bits[slot >> 6] >> (slot & 63)) & 1 == 1
