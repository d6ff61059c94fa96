"""Places and running sums over a whole table, without one task that sees it all.

Rows are dealt out by ranges of their order and written; a range's total is one row, and what lies before a range is a
running sum over these.  Within a range a window counts on.  The order must be total enough that equal keys fit one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casequarry.tables import written


def running(rows: DataFrame, order: list[str], value: Column | None = None, name: str = "upto", only_below: int | None = None) -> DataFrame:
    """Adds ``name``, the sum of ``value`` (default: 1) over the rows up to and with each in ``order``, and ``<name>_total``.

    With ``only_below``, rows of ranges that begin at or above this sum are not counted on: their ``name`` is null.
    """
    value = F.lit(1) if value is None else value
    ranged = written(rows.repartitionByRange(*order).withColumn("_value", value.cast("bigint")).withColumn("_range", F.spark_partition_id()))
    every = W.orderBy("_range")  # over one row for each range
    sums = ranged.groupBy("_range").agg(F.sum("_value").alias("_in"))
    sums = sums.select(
        F.col("_range").alias("_r"), (F.sum("_in").over(every) - F.col("_in")).alias("_before"), F.sum("_in").over(W.partitionBy()).alias(f"{name}_total")
    )
    placed = ranged.join(sums, F.col("_range") == F.col("_r"))
    near = placed if only_below is None else placed.where(F.col("_before") < only_below)
    within = F.sum("_value").over(W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    out = near.withColumn(name, F.col("_before") + within)
    if only_below is not None:
        out = out.unionByName(placed.where(F.col("_before") >= only_below).withColumn(name, F.lit(None).cast("bigint")))
    return out.select(*rows.columns, name, f"{name}_total")
