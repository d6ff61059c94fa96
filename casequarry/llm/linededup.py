"""Line deduplication: lines found in many documents go from every document.

Lines are normalised, hashed to 128 bits and exploded once per row; the distinct
documents of each hash are counted, with map-side combining, and the frequent hashes are
joined back to line positions.  Texts are reassembled from the positions that stay.

Defined results: a null or empty text is one empty line.  Rows of one id
are one document when documents are counted, rows with a null id together are one too;
each row loses its own lines.  A key shorter than ``min_chars`` code points
is never dropped.  A text that loses all its lines becomes empty.  A null id is an
ordinary value.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.llm import common as C

MIN_DOCS, MIN_CHARS = 10, 1
SPACES = " \t\n\x0b\x0c\r"


def line_keys(text: Column) -> Column:
    return F.transform(F.split(C.ascii_lower(text), "\n"), lambda line: F.btrim(line, F.lit(SPACES)))


def _hashes(text: Column, min_chars: int) -> Column:
    """A 128-bit hash for each line; null where the line's key is too short."""
    return F.transform(
        line_keys(text),
        lambda key: F.when(F.length(key) >= min_chars, F.struct(*(h.alias(n) for h, n in zip(C.hash128(key), ("a", "b"), strict=True)))),
    )


def drop_common_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Every input row's id with n_lines, n_dropped, the kept text and a struct of the ``carry`` columns."""
    carried = F.struct(*(F.col(c) for c in carry)) if carry else F.lit(None).cast("struct<none:int>")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), carried.alias("carried"))
    keyed = rows.select("doc_id", F.xxhash64("t").alias("version"), _hashes(F.col("t"), min_chars).alias("lines"))
    hashes = keyed.select("doc_id", F.explode(F.array_distinct("lines")).alias("h")).where("h is not null")
    # Rows of their own ids need no comparison of ids, and leave each task as one row for each hash.
    repeated = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    documents = F.count("*")
    if not repeated.isEmpty():
        documents = F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))
    # Written first: its size is then known, so a small set can be sent to all tasks, and
    # beyond that the join below deals both sides alike and a common line's rows can be split.
    common = C.written(hashes.groupBy("h.a", "h.b").agg(documents.alias("n")).where(F.col("n") >= min_docs).select("a", "b"))
    drops = (
        keyed.select("doc_id", "version", F.posexplode("lines").alias("pos", "h"))
        .where("h is not null")
        .select("doc_id", "version", "pos", "h.a", "h.b")
        .join(common, ["a", "b"], "left_semi")
        .groupBy(F.col("doc_id").alias("d"), F.col("version").alias("v"))
        .agg(F.collect_set("pos").alias("drop"))
    )
    lines = F.split("t", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drop"))
    return rows.join(drops, F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("t") == F.col("v")), "left").select(
        "doc_id",
        F.size(lines).cast("bigint").alias("n_lines"),
        F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("bigint").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("t"))
        .otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
        .alias("kept"),
        "carried",
    )
