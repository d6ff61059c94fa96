"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words: its weight's share of all words, at most
``cap`` times its own size, the excess reshared by weight.  A document's expected
copies are target / source size.  Documents are ordered by size within their source,
the expected copies are prefix-summed, one offset is added, and a document is emitted
once for each integer that its stretch crosses.

Ranks are built without gathering a source: rows are dealt out by ranges of (source,
size, id), counted per range, and numbered within a range after the counts before it.

Defined results: a null text has size 0.  Null sources form a source of their own, the
last.  A source of size 0 has target 0 and its documents no copies.  Repeated rows are
sampled apart, tied rows are interchangeable.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from casequarry.llm import common as C

WEIGHTS, CAP, SEED = (5, 2, 1), 3, "mix-1"


@F.arrow_udf(LongType())
def word_count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Number of runs of anything but the six ASCII spaces."""
    for column in batches:
        counts = [C.words(t, C.NONSPACE)[2] for t in C.passes(column)]
        yield pa.array(np.concatenate(counts) if counts else [], pa.int64())


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size and target from one row for each source.

    All sources are ordered in one task, some 100 bytes each: millions of sources fit, whatever the documents.

    Sources are met in the order of cap * size / weight.  ``level`` is what a unit of
    weight gets if those met earlier stop at their cap; the first source that need not
    stop sets it, and later rows of the order can only have less.
    """
    place = F.row_number().over(W.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights)) + 1)
    order = W.orderBy("turn", F.col("source").isNull(), "source")
    before, onward = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    return (
        sources.select("source", "source_size", weight.alias("weight"), (cap * F.col("source_size")).alias("limit"))
        .withColumn("turn", F.col("limit") / F.col("weight"))
        .withColumn("rest", F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("level", F.col("rest") / F.sum("weight").over(onward))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("turn"), F.col("level"))).over(W.partitionBy()))
        .select(
            "source",
            "source_size",
            F.least(F.col("limit").cast("double"), F.coalesce(F.col("weight") * F.col("level"), F.col("limit").cast("double"))).alias("target"),
        )
    )


def offset(source: Column, seed: str) -> Column:
    """A number from 0 up to 1 that depends on the seed and the source alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("(null)"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(16**8)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Every row's doc_id with source, size, source_size, target, copies and taken."""
    C.tune(docs.sparkSession)
    sized = C.written(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    )
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    ranged = C.written(
        sized.repartitionByRange(F.col("source"), F.col("size"), F.col("doc_id")).withColumn("part", F.spark_partition_id())
    )
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = (
        ranged.groupBy("source", "part")
        .agg(F.count("*").alias("n"))
        .select("source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    info = parts.alias("p").join(goal.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source"))).select(
        F.col("p.source").alias("s"), F.col("part").alias("p"), "before", "source_size", "target"
    )
    within = F.row_number().over(W.partitionBy("source", "part").orderBy("size", "doc_id"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    start = offset(F.col("source"), seed)
    return (
        ranged.withColumn("rank", within)
        .join(info, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
        .withColumn("rank", F.col("rank") + F.col("before"))
        .withColumn("copies", F.floor(rate * F.col("rank") + start) - F.floor(rate * (F.col("rank") - 1) + start))
        .withColumn("copies", F.least(F.col("copies"), F.lit(cap)).cast("bigint"))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )
