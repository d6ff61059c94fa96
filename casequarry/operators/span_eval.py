"""Evaluation of extracted spans: one row per (method, gold_id), summaries, comparisons and the gate.

Rows have the columns of the ``doc_eval`` schema.  Means and rates are rounded to four
places and null where they have no basis.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.functions import metrics as M
from casequarry.operators.quantiles import median

PLACES = 4
#: How far a measure may fall below the baseline before the gate fails.
THRESHOLDS = {
    "iou_mean": 0.02,
    "citation_fidelity_mean": 0.01,
    "citation_support_mean": 0.01,
    "span_found_rate": 0.0,
}
WIN = 0.01


def effective_span(gold: DataFrame) -> DataFrame:
    """Adds reference_span and is_gold: the corrected span, none if there are no facts, else the rules' span."""
    label = F.col("label")
    labelled = F.when(label["gold_span"].isNotNull(), label["gold_span"]).when(label["has_facts"] == F.lit(False), F.lit(None)).otherwise(F.col("rules_span"))
    done = F.col("status") == "labeled"
    return gold.withColumn("reference_span", F.when(done, labelled).otherwise(F.col("rules_span"))).withColumn("is_gold", F.coalesce(done, F.lit(False)))


def select_records(gold: DataFrame, subset: str = "labeled", labeled_by: str = "any", limit: int | None = None, smoke: int = 5) -> DataFrame:
    """Gold records by label status and labeller, in order of gold_id; smoke takes a few of the labelled or else of all."""
    judged = F.coalesce(F.col("label.labeler"), F.lit("")).startswith("judge:")
    labelled = gold.where(F.col("status") == "labeled")
    if labeled_by != "any":
        labelled = labelled.where(judged if labeled_by == "judge" else ~judged)
    chosen = labelled if subset == "labeled" else gold
    if subset == "smoke":
        chosen, limit = (gold if labelled.isEmpty() else labelled), limit or smoke
    return chosen if limit is None else chosen.orderBy("gold_id").limit(limit)


def _pair(span: Column) -> tuple[Column, Column]:
    return F.get(span, F.lit(0)), F.get(span, F.lit(1))


def evaluate_documents(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Adds iou, auto_rating and span_found to predictions (method, gold_id, pred_span, error, ...) of gold records.

    A failed extraction scores 0 where a reference exists and nothing where none does.
    """
    joined = effective_span(gold).join(predictions, "gold_id")
    iou = M.span_iou(*_pair(F.col("reference_span")), *_pair(F.col("pred_span")))
    failed = F.col("error").isNotNull()
    scored = joined.withColumn("iou", F.when(failed & F.col("reference_span").isNotNull(), 0.0).when(~failed, iou))
    return scored.withColumn("auto_rating", M.auto_rating(F.col("iou"))).withColumn("span_found", F.col("pred_span").isNotNull() & ~failed)


def _mean(value: Column) -> Column:
    return F.round(F.avg(value), PLACES)


def _rate(hit: Column, base: Column | None = None) -> Column:
    """Share of ``base`` rows with ``hit``; unknown hits count as misses, no base rows as null."""
    base = F.lit(True) if base is None else F.coalesce(base, F.lit(False))
    return F.round(F.try_divide(F.count_if(base & F.coalesce(hit, F.lit(False))), F.count_if(base)), PLACES)


def _has_flag(prefix: str) -> Column:
    return F.exists("flags", lambda f: f.startswith(prefix))


def summary_columns() -> dict[str, Column]:
    gold = F.col("is_gold")
    gold_iou = F.when(gold, F.col("iou"))
    failure = gold & (F.col("source") == "no_facts_span")
    lost = failure & F.col("gold_has_facts") & F.col("reference_span").isNotNull()
    empty = failure & (F.col("gold_has_facts") == F.lit(False))
    rated = gold & F.col("human_rating").isNotNull() & F.col("auto_rating").isNotNull()
    unsupported = F.size(F.filter("flags", lambda f: f.startswith("unsupported_citation")))
    return {
        "n_docs": F.count("*"),
        "n_gold": F.count_if(gold),
        "n_errors": F.count_if(F.col("error").isNotNull()),
        "iou_mean": _mean(gold_iou),
        "iou_ge_0_9": _rate(gold_iou >= M.CORRECT, gold_iou.isNotNull()),
        "iou_ge_0_5": _rate(gold_iou >= M.PARTIAL, gold_iou.isNotNull()),
        "span_found_rate": _rate(F.col("span_found")),
        "validation_pass_rate": _rate(F.col("validation_ok")),
        "empty_facts_rate": _rate(F.array_contains("flags", "empty_facts")),
        "citation_fidelity_mean": _mean(F.col("citation_fidelity")),
        "citation_support_mean": _mean(F.when(F.col("citation_fidelity").isNotNull(), F.col("citation_support"))),
        "docs_with_unsupported_cites": F.count_if(_has_flag("unsupported_citation")),
        "n_docs_with_cites": F.count("citation_fidelity"),
        "n_cites_emitted": F.coalesce(F.sum("n_citations"), F.lit(0)),
        "n_cites_nonverbatim": F.coalesce(F.sum("n_nonverbatim_citations"), F.lit(0)),
        "n_cites_unsupported": F.coalesce(F.sum(unsupported), F.lit(0)),
        "recovered_span_rate": _rate(F.coalesce(F.col("iou"), F.lit(0.0)) >= M.PARTIAL, lost),
        "failure_stratum_n": F.count_if(failure),
        "failure_correct_no_facts_rate": _rate(~F.col("span_found"), empty),
        "auto_vs_human_n": F.count_if(rated),
        "auto_vs_human_agreement": _rate(F.col("human_rating") == F.col("auto_rating"), rated),
        "parties_nonempty_rate": _rate(F.col("n_parties") > 0),
        "posture_rate": _rate(F.col("has_posture")),
        "key_events_mean": _mean(F.col("n_key_events")),
        "record_cites_mean": _mean(F.col("n_record_cites")),
        "case_cites_mean": _mean(F.col("n_case_cites")),
        "cost_usd_per_doc": _mean(F.col("cost_usd")),
        "cost_usd_total": F.round(F.sum("cost_usd"), PLACES),
        "latency_s_mean": _mean(F.col("latency_s")),
    }


#: Medians of a summary: where they stand, of which value and rows.
MEDIANS = {"iou_median": ("iou_mean", "iou", "is_gold"), "latency_s_median": ("latency_s_mean", "latency_s", "true")}


def summarize(evals: DataFrame, *keys: str, only: tuple[str, ...] | None = None) -> DataFrame:
    """The summary of each group of documents; measures of spans use gold documents only.

    Medians come from counted ranks, so no group is gathered.
    """
    columns = {n: c for n, c in summary_columns().items() if only is None or n in only}
    out = evals.groupBy(*keys).agg(*(c.alias(n) for n, c in columns.items()))
    names = list(columns)
    wanted = {n: m for n, m in MEDIANS.items() if only is None or n in only}
    if wanted:
        # All medians from one count of values, told apart by their name.
        each = F.explode(F.array(*(F.struct(F.lit(n).alias("_of"), F.when(F.expr(rows), F.col(value)).cast("double").alias("_value")) for n, (_, value, rows) in wanted.items())))
        values = evals.select(*keys, each.alias("_m")).select(*keys, "_m.*")
        middle = median(values, [*keys, "_of"], "_value", "_median")
        found = middle.groupBy(*(F.col(k).alias(f"_key_{k}") for k in keys)).agg(*(F.round(F.max(F.when(F.col("_of") == n, F.col("_median"))), PLACES).alias(n) for n in wanted))
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))
        out = out.join(found, same, "left").drop(*(f"_key_{k}" for k in keys))
    for name, (after, _, _) in wanted.items():
        names.insert(names.index(after) + 1 if after in names else len(names), name)
    return out.select(*keys, *names)


def stratify(evals: DataFrame, key: str) -> DataFrame:
    """Summaries per method and source, or per method and value of a stratum, ``unknown`` where it is missing."""
    value = F.col("source") if key == "source" else F.coalesce(F.try_element_at("stratum", F.lit(key)), F.lit("unknown"))
    return summarize(evals.withColumn("value", value), "method", "value")


def confusion(evals: DataFrame) -> DataFrame:
    rated = F.col("is_gold") & F.col("human_rating").isNotNull() & F.col("auto_rating").isNotNull()
    return evals.where(rated).groupBy("method", "human_rating", "auto_rating").agg(F.count("*").alias("n"))


def flag_counts(evals: DataFrame) -> DataFrame:
    return evals.select("method", F.explode("flags").alias("f")).groupBy("method", F.split_part("f", F.lit(":"), F.lit(1)).alias("flag")).agg(F.count("*").alias("n"))


def note_counts(evals: DataFrame, n: int = 15, longest: int = 40) -> DataFrame:
    """The most frequent short notes of each method, ties by name."""
    from pyspark.sql import Window as W

    counts = evals.select("method", F.explode("extractor_notes").alias("note")).where(F.length("note") <= longest).groupBy("method", "note").agg(F.count("*").alias("n"))
    place = F.row_number().over(W.partitionBy("method").orderBy(F.desc("n"), "note"))
    return counts.withColumn("place", place).where(F.col("place") <= n).drop("place")


def _paired(evals: DataFrame, a: str, b: str) -> DataFrame:
    keep = ["gold_id", "pred_span", "iou", "is_gold"]
    left = evals.where(F.col("method") == a).select("gold_id", *(F.col(c).alias(f"a_{c}") for c in keep[1:]))
    right = evals.where(F.col("method") == b).select("gold_id", *(F.col(c).alias(f"b_{c}") for c in keep[1:]))
    return left.join(right, "gold_id")


def agreement(evals: DataFrame, a: str, b: str) -> DataFrame:
    """Overlap of two methods' spans over all documents both have."""
    pairs = _paired(evals, a, b).select(M.span_iou(*_pair(F.col("a_pred_span")), *_pair(F.col("b_pred_span"))).alias("iou"), F.lit("all").alias("g"))
    middle = median(pairs, ["g"], "iou", "_median")
    measured = pairs.groupBy("g").agg(F.count("*").alias("n"), _mean(F.col("iou")).alias("iou_mean"), _rate(F.col("iou") >= M.CORRECT).alias("iou_ge_0_9"))
    return measured.join(middle, "g", "left").select(
        F.lit(a).alias("a"), F.lit(b).alias("b"), "n", "iou_mean", F.round("_median", PLACES).alias("iou_median"), "iou_ge_0_9"
    )


def compare(evals: DataFrame, a: str, b: str) -> DataFrame:
    """Wins, ties and losses of b over a on gold documents that both have a score for."""
    both = F.col("a_is_gold") & F.col("b_is_gold") & F.col("a_iou").isNotNull() & F.col("b_iou").isNotNull()
    pairs = _paired(evals, a, b).where(both).withColumn("delta", F.col("b_iou") - F.col("a_iou"))
    return pairs.agg(
        F.lit(a).alias("a"),
        F.lit(b).alias("b"),
        F.count("*").alias("n_pairs"),
        _mean(F.col("delta")).alias("iou_delta_mean"),
        F.count_if(F.col("delta") > WIN).alias("wins"),
        F.count_if(F.abs("delta") <= WIN).alias("ties"),
        F.count_if(F.col("delta") < -WIN).alias("losses"),
    )


def worst(evals: DataFrame, method: str, n: int = 10) -> DataFrame:
    """The gold documents with the least overlap."""
    rows = evals.where((F.col("method") == method) & F.col("is_gold") & F.col("iou").isNotNull())
    notes = F.substring(F.array_join("extractor_notes", ";"), 1, 80).alias("notes")
    order = ["iou", "gold_id", "source", "pred_confidence", "notes"]
    return rows.select("iou", "gold_id", "source", "pred_confidence", notes).orderBy(*order).limit(n).withColumn("iou", F.round("iou", 3))


def gate(current: DataFrame, baseline: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Checks (method, metric, baseline, current, drop, ok, note) of summaries against a baseline's.

    ``n_errors`` must be 0; other metrics may fall by their threshold.  What either side
    lacks passes with a note.
    """
    limits = THRESHOLDS if thresholds is None else thresholds
    now = current.select("method", F.col("n_errors").cast("double").alias("errors"), *(F.col(m).alias(f"now_{m}") for m in limits))
    then = baseline.select(F.col("method").alias("m"), *(F.col(m).alias(f"then_{m}") for m in limits))
    joined = now.join(then, F.col("method") == F.col("m"), "left")

    def row(metric: str, base: Column, value: Column, drop: float, ok: Column, note: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            base.cast("double").alias("baseline"),
            value.cast("double").alias("current"),
            F.lit(float(drop)).alias("max_drop"),
            ok.alias("ok"),
            note.alias("note"),
        )

    clean = F.coalesce(F.col("errors"), F.lit(0.0)) == 0
    rows = [row("n_errors", F.lit(0.0), F.coalesce(F.col("errors"), F.lit(0.0)), 0.0, clean, F.when(clean, "").otherwise("extractor errors"))]
    for metric, drop in limits.items():
        value, base = F.col(f"now_{metric}"), F.col(f"then_{metric}")
        absent = value.isNull() | base.isNull()
        ok = absent | (value >= base - drop - 1e-9)
        note = F.when(base.isNull(), "no baseline").when(value.isNull(), "n/a").when(ok, "").otherwise("REGRESSION")
        rows.append(row(metric, base, value, drop, ok, note))
    return joined.select("method", F.explode(F.array(*rows)).alias("c")).select("method", "c.*")


def baseline_from(current: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """What a later gate compares with."""
    limits = THRESHOLDS if thresholds is None else thresholds
    return current.select("method", *limits, "n_errors", "validation_pass_rate")
