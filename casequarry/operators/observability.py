"""Request logs and run histories, summarised in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casequarry.functions.metrics import nearest_rank
from casequarry.operators.quantiles import at_ranks

PLACES = 4


def _failed() -> Column:
    return F.coalesce(F.col("error"), F.lit("")) != ""


def request_columns() -> dict[str, Column]:
    """Measures of a group of requests; rates are over requests without error, escalation over those that report it."""
    ok = ~_failed()
    cost = F.when(ok, F.col("cost_usd"))
    told = ok & F.col("escalated").isNotNull()

    def share(hit: Column, base: Column) -> Column:
        return F.try_divide(F.count_if(base & F.coalesce(hit, F.lit(False))), F.count_if(base))

    return {
        "n": F.count("*"),
        "n_errors": F.count_if(_failed()),
        "error_rate": F.try_divide(F.count_if(_failed()), F.count("*")),
        "span_found_rate": share(F.col("span_found"), ok),
        "validation_pass_rate": share(F.col("validation_ok"), ok),
        "cost_usd_total": F.round(F.coalesce(F.sum(cost), F.lit(0.0)), PLACES),
        "cost_usd_per_doc": F.round(F.avg(cost), PLACES),
        "latency_p50": nearest_rank(F.col("latency_s"), 0.5),
        "latency_p95": nearest_rank(F.col("latency_s"), 0.95),
        "escalation_rate": share(F.col("escalated"), told),
    }


def _named(log: DataFrame) -> DataFrame:
    return log.withColumn("method", F.coalesce("method", F.lit("None"))).withColumn("day", F.substring(F.coalesce("ts", F.lit("")), 1, 10))


def summarize_requests(log: DataFrame) -> DataFrame:
    """One row for all requests and for each method and day, by grouping sets: grouping, value and measures.

    Percentiles come from ``latency_percentiles``, which gathers no group.
    """
    method, day = F.col("method"), F.col("day")
    measured = _named(log).groupingSets([[], [method], [day]], method, day).agg(
        *(c.alias(n) for n, c in request_columns().items() if not n.startswith("latency")), F.grouping("method").alias("gm"), F.grouping("day").alias("gd")
    )
    grouping = F.when(F.col("gm") == 0, "method").when(F.col("gd") == 0, "day").otherwise("all")
    value = F.when(F.col("gm") == 0, method).when(F.col("gd") == 0, day).otherwise("all")
    names = [n for n in request_columns() if not n.startswith("latency")]
    out = measured.select(grouping.alias("grouping"), value.alias("value"), *names)
    return out.join(latency_percentiles(log), ["grouping", "value"], "left")


def latency_percentiles(log: DataFrame, quantiles: dict[str, float] | None = None) -> DataFrame:
    """Nearest-rank percentiles per grouping without gathering a group.

    Equal latencies are counted first; the wanted rank, rounded half to even, is looked up
    in running counts within quarters of a second.
    """
    wanted = quantiles or {"latency_p50": 0.5, "latency_p95": 0.95}
    tagged = F.array(
        F.struct(F.lit("all").alias("grouping"), F.lit("all").alias("value")),
        F.struct(F.lit("method").alias("grouping"), F.col("method").alias("value")),
        F.struct(F.lit("day").alias("grouping"), F.col("day").alias("value")),
    )
    counts = _named(log).where(F.col("latency_s").isNotNull()).groupBy("method", "day", "latency_s").agg(F.count("*").alias("c"))
    tagged_counts = counts.select(F.explode(tagged).alias("g"), "latency_s", "c").select("g.grouping", "g.value", "latency_s", "c")
    ranks = {name: (lambda n, q=q: F.bround(F.lit(q) * (n - 1))) for name, q in wanted.items()}
    return at_ranks(tagged_counts, ["grouping", "value"], "latency_s", ranks, weight="c")


def latency_histogram(log: DataFrame, digits: int = 1) -> DataFrame:
    """Counts per method and rounded latency: a bounded summary that later percentiles can be read from."""
    return _named(log).where("latency_s is not null").groupBy("method", F.round("latency_s", digits).alias("latency_s")).agg(F.count("*").alias("n"))


def top_values(log: DataFrame, kind: str = "flags", n: int = 5, by: str | None = "method") -> DataFrame:
    """The most frequent flags (up to the first colon, of requests without error) or errors (60 characters), ties by name."""
    named = _named(log)
    if kind == "flags":
        items = named.where(~_failed()).select(F.col(by) if by else F.lit("all").alias("all"), F.explode("flags").alias("x")).withColumn("item", F.split_part("x", F.lit(":"), F.lit(1)))
    else:
        items = named.where(_failed()).select(F.col(by) if by else F.lit("all").alias("all"), F.substring("error", 1, 60).alias("item"))
    key = by or "all"
    counts = items.groupBy(key, "item").agg(F.count("*").alias("n"))
    place = F.row_number().over(W.partitionBy(key).orderBy(F.desc("n"), "item"))
    return counts.withColumn("place", place).where(F.col("place") <= n).drop("place")


def time_range(log: DataFrame) -> DataFrame:
    said = F.when(F.col("ts") != "", F.col("ts"))
    return log.agg(F.min(said).alias("first_ts"), F.max(said).alias("last_ts"))


def run_history(summaries: DataFrame) -> DataFrame:
    """One row per run and method from summaries (meta struct, methods map of structs), oldest first."""
    rows = summaries.select("meta", F.explode("summaries").alias("method", "s"))
    return rows.select(
        F.col("meta.run_id").alias("run_id"),
        F.substring(F.col("meta.timestamp"), 1, 19).alias("timestamp"),
        F.col("meta.subset").alias("subset"),
        F.col("meta.n_docs").alias("n_docs"),
        F.col("meta.n_gold").alias("n_gold"),
        "method",
        *(F.col(f"s.{c}").alias(c) for c in ("iou_mean", "iou_ge_0_9", "citation_support_mean", "cost_usd_per_doc", "latency_s_mean")),
    ).orderBy("timestamp", "run_id", "method")
