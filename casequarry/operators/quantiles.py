"""Exact order statistics of groups that may hold most rows, for any distribution of values.

Equal values are counted first.  A rank is then looked for by histogram refinement: each pass counts the values between the
bounds of the last one in BINS bins and keeps the bin that holds the rank, with the least and greatest value in it as new
bounds, until few enough distinct values are left to be put in order.  A pass reads only the values within
its bounds and adds them up before they move, so no task passes over a whole group, however close its values lie.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casequarry.tables import written

#: Bins of a pass, and distinct values that a task puts in order.
BINS, FEW = 4096, 4096


def at_ranks(
    rows: DataFrame, keys: list[str], value: str, ranks: dict[str, Callable[[Column], Column]], weight: str | None = None, bins: int = BINS, few: int = FEW
) -> DataFrame:
    """(keys, names): for each name the value at a rank, counted from 0, of its group; the rank is a function of the group's size.

    ``weight`` counts a row more than once.  Null values are left out, null keys are a group.
    """
    times = F.count("*") if weight is None else F.sum(weight)
    counts = written(rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(times.alias("_c")))
    wanted = F.explode(F.create_map(*[x for name, rank in ranks.items() for x in (F.lit(name), rank(F.col("_n")).cast("bigint"))])).alias("_name", "_rank")
    sizes = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_m"))
    spans = written(sizes.select(*(F.col(k).alias(f"_key_{k}") for k in keys), "_lo", "_hi", "_m", wanted))
    group = [f"_key_{k}" for k in keys] + ["_name"]

    def inside(of: DataFrame) -> DataFrame:
        met = F.col("_v").between(F.col("_lo"), F.col("_hi"))
        for k in keys:
            met &= F.col(k).eqNullSafe(F.col(f"_key_{k}"))
        return counts.join(of, met)

    while (spans.agg(F.max("_m")).first()[0] or 0) > few:
        # Halves keep the width of any two doubles finite; a bin's number never falls as values rise.
        half = lambda c: F.col(c).cast("double") / 2
        place = F.least(F.floor((half("_v") - half("_lo")) / (half("_hi") - half("_lo")) * bins), F.lit(bins - 1))
        open_ = spans.where(F.col("_m") > few)
        filled = inside(open_).groupBy(*group, "_rank", place.alias("_bin")).agg(F.sum("_c").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_m"))
        upto = F.sum("_c").over(W.partitionBy(*group).orderBy("_bin"))  # over at most ``bins`` rows
        found = filled.withColumn("_upto", upto).where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_c")))
        narrowed = found.withColumn("_rank", F.col("_rank") - (F.col("_upto") - F.col("_c"))).select(*spans.columns)
        spans = written(spans.where(F.col("_m") <= few).unionByName(narrowed))
    upto = F.sum("_c").over(W.partitionBy(*group).orderBy("_v"))  # over at most ``few`` values
    placed = inside(spans).withColumn("_upto", upto)
    named = placed.groupBy(*(F.col(f"_key_{k}").alias(k) for k in keys))
    return named.agg(*(F.min(F.when((F.col("_name") == name) & (F.col("_upto") > F.col("_rank")), F.col("_v"))).alias(name) for name in ranks))


def median(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """(keys, name): the mean of the one or two middle values."""
    half = {"_low": lambda n: F.floor((n - 1) / 2), "_high": lambda n: F.ceil((n - 1) / 2)}
    return at_ranks(rows, keys, value, half).select(*keys, ((F.col("_low") + F.col("_high")) / 2).alias(name))
