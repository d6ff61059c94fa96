"""Ranking, span and rating metrics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CORRECT, PARTIAL = 0.9, 0.5


def _hit(ranked: Column, truth: Column, k: int) -> Column:
    """1 or 0 for each of the first k ranks."""
    return F.transform(F.slice(ranked, 1, k), lambda x: F.array_contains(truth, x).cast("int"))


def recall_at(ranked: Column, truth: Column, k: int) -> Column:
    truth = F.array_distinct(truth)
    found = F.size(F.array_intersect(F.slice(ranked, 1, k), truth))
    return F.when(F.size(truth) > 0, found / F.size(truth)).otherwise(0.0)


def mrr_at(ranked: Column, truth: Column, k: int) -> Column:
    first = F.array_position(_hit(ranked, truth, k), 1)
    return F.when((F.size(truth) > 0) & (first > 0), 1.0 / first).otherwise(0.0)


def ideal_gain(n: Column, k: int) -> Column:
    """Sum of 1 / log2(rank + 1) over the first min(n, k) ranks."""
    ranks = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(n, F.lit(k))))
    return F.aggregate(ranks, F.lit(0.0), lambda acc, r: acc + 1.0 / F.log2(r + F.lit(1)))


def ndcg_at(ranked: Column, truth: Column, k: int) -> Column:
    truth = F.array_distinct(truth)
    gains = F.transform(_hit(ranked, truth, k), lambda hit, i: hit / F.log2(i + F.lit(2)))
    gain = F.aggregate(gains, F.lit(0.0), lambda acc, g: acc + g)
    return F.when(F.size(truth) > 0, gain / ideal_gain(F.size(truth), k)).otherwise(0.0)


def span_iou(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Overlap over hull of two half-open spans; a span is null where its start is.

    Two null spans agree (1.0), one null span does not (0.0); an empty hull gives 0.0.
    """
    overlap = F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))
    hull = F.greatest(a_end, b_end) - F.least(a_start, b_start)
    return (
        F.when(a_start.isNull() & b_start.isNull(), 1.0)
        .when(a_start.isNull() | b_start.isNull(), 0.0)
        .when(hull > 0, overlap / hull)
        .otherwise(0.0)
    )


def auto_rating(iou: Column) -> Column:
    return F.when(iou >= CORRECT, "correct").when(iou >= PARTIAL, "partially_correct").when(iou.isNotNull(), "incorrect")


def nearest_rank(values: Column, q: float) -> Column:
    """The element of the sorted non-null values at round-half-even(q * (n - 1)), as an aggregate."""
    sorted_ = F.array_sort(F.collect_list(values))
    return F.try_element_at(sorted_, (F.bround(F.lit(q) * (F.size(sorted_) - 1)) + 1).cast("int"))


def cost_usd(model: Column, usage: Column, prices: dict[str, dict[str, float]]) -> Column:
    """Price of a call by tokens; cache writes cost 1.25 and cache reads 0.1 of input. Null for unknown models."""
    price_in = F.element_at(F.create_map(*(F.lit(x) for m, p in prices.items() for x in (m, float(p["input"])))), model)
    price_out = F.element_at(F.create_map(*(F.lit(x) for m, p in prices.items() for x in (m, float(p["output"])))), model)

    def tokens(name: str) -> Column:
        return F.coalesce(usage[name].cast("double"), F.lit(0.0))

    cached = tokens("cache_creation_input_tokens") * 1.25 + tokens("cache_read_input_tokens") * 0.1
    total = (tokens("input_tokens") + cached) * price_in + tokens("output_tokens") * price_out
    return F.when(usage.isNotNull(), F.round(total / 1e6, 6))
