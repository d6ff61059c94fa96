"""Exact deduplication by 128-bit content hash, confirmed byte by byte.  DataFrame functions only.

Rows are grouped by the hash of their normalised text.  The least and the greatest text
of each group are kept while grouping, with map-side combining, so a large group of
copies leaves each task as one row; they are equal bytes exactly when the whole group
is.  Rows of a group whose bytes differ (a hash collision) are grouped again by text.

Defined results: a null text counts as empty.  Of equal texts the row with the chosen
id stays, null ids last; of repeated rows with that id all are marked kept.  Groups with
only null ids have a null keep_id and keep all.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.llm import common as C


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_duplicates(
    docs: DataFrame,
    keep: str = "least",
    normalise: Callable[[Column], Column] = C.ascii_lower,
    hashed: Callable[[Column], Column] = content_hash,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row; ``keep`` is least or largest."""
    best = {"least": F.min, "largest": F.max}[keep]
    rows = docs.select(F.col(id_col).alias("doc_id"), normalise(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    rows = rows.select("doc_id", "norm", hashed(F.col("norm")).alias("h"))
    sizes = [F.count("*").alias("group_size"), best("doc_id").alias("keep_id")]
    groups = C.written(
        rows.groupBy("h")
        .agg(*sizes, F.min("norm").alias("low"), F.max("norm").alias("high"))
        .select("h", "group_size", "keep_id", (F.col("low") == F.col("high")).alias("same"))
    )
    collided = groups.where("not same").select("h")
    sha = F.sha2("norm", 256).alias("text_sha256")
    out = rows.select("doc_id", "h", sha).join(groups.where("same"), "h")
    if not collided.isEmpty():
        split = rows.join(collided, "h").groupBy("h", "norm").agg(*sizes)
        again = rows.join(split, ["h", "norm"]).select("doc_id", "h", sha, "group_size", "keep_id", F.lit(True).alias("same"))
        out = out.unionByName(again)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
