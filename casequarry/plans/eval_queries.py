"""Queries of span evaluation, the gate, request logs, gold sets, routing and replay, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry.functions import metrics as M
from casequarry.operators import downstream as Down
from casequarry.operators import extraction as X
from casequarry.operators import gold as Gold
from casequarry.operators import judge as J
from casequarry.operators import observability as Obs
from casequarry.operators import routing as Route
from casequarry.operators import run_eval as Run
from casequarry.operators import span_eval as Ev
from casequarry.plans.views import view, view_sql
from casequarry.schemas import schema
from casequarry.tables import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLE_SQL[function.__name__] = oracle
        return function

    return add


def _strings(*columns: str):
    """Non-empty strings of some columns as an array."""
    return F.filter(F.array(*columns), lambda x: x != "")


def _evals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``evals`` view as evaluation rows."""
    v = view(spark, sf_dir, "evals")
    span = lambda side: F.when(F.col(f"{side}_start").isNotNull(), F.array(f"{side}_start", f"{side}_end"))
    failed = F.col("error").isNotNull()
    iou = M.span_iou(F.col("r_start"), F.col("r_end"), F.col("p_start"), F.col("p_end"))
    score = F.when(failed & F.col("r_start").isNotNull(), 0.0).when(~failed, iou)
    return v.select(
        "*",
        F.create_map(F.lit("lang"), F.col("stratum_lang")).alias("stratum"),
        span("r").alias("reference_span"),
        span("p").alias("pred_span"),
        score.alias("iou"),
        M.auto_rating(score).alias("auto_rating"),
        (F.col("p_start").isNotNull() & ~failed).alias("span_found"),
        _strings("flag_1", "flag_2").alias("flags"),
        _strings("note_1").alias("extractor_notes"),
    )


_IOU = """CASE WHEN {a}_start IS NULL AND {b}_start IS NULL THEN 1.0 WHEN {a}_start IS NULL OR {b}_start IS NULL THEN 0.0
  WHEN greatest({a}_end, {b}_end) > least({a}_start, {b}_start)
  THEN greatest(0, least({a}_end, {b}_end) - greatest({a}_start, {b}_start)) / (greatest({a}_end, {b}_end) - least({a}_start, {b}_start))::DOUBLE ELSE 0.0 END"""
_EVALS = f"""
WITH evals AS ({view_sql("evals")}), scored AS (
  SELECT *, CASE WHEN error IS NOT NULL AND r_start IS NOT NULL THEN 0.0 WHEN error IS NULL THEN {_IOU.format(a="r", b="p")} END AS iou,
         p_start IS NOT NULL AND error IS NULL AS span_found FROM evals
), rated AS (SELECT *, CASE WHEN iou >= 0.9 THEN 'correct' WHEN iou >= 0.5 THEN 'partially_correct' WHEN iou IS NOT NULL THEN 'incorrect' END AS auto_rating FROM scored)"""


@query(f"{_EVALS} SELECT gold_id, method, round(iou, 6) AS iou, auto_rating FROM rated")
def span_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evals(spark, sf_dir).select("gold_id", "method", F.round("iou", 6).alias("iou"), "auto_rating")


def _rate_sql(hit: str, base: str = "true") -> str:
    return f"round(count(*) FILTER (WHERE ({base}) AND ({hit})) / nullif(count(*) FILTER (WHERE {base}), 0), 4)"


_SUMMARY = ",\n".join(
    f"{sql_} AS {name}"
    for name, sql_ in {
        "n_docs": "count(*)",
        "n_gold": "count(*) FILTER (WHERE is_gold)",
        "n_errors": "count(error)",
        "iou_mean": "round(avg(iou) FILTER (WHERE is_gold), 4)",
        "iou_median": "round(median(iou) FILTER (WHERE is_gold), 4)",
        "iou_ge_0_9": _rate_sql("iou >= 0.9", "is_gold AND iou IS NOT NULL"),
        "iou_ge_0_5": _rate_sql("iou >= 0.5", "is_gold AND iou IS NOT NULL"),
        "span_found_rate": _rate_sql("span_found"),
        "validation_pass_rate": _rate_sql("validation_ok"),
        "empty_facts_rate": _rate_sql("flag_1 = 'empty_facts'"),
        "citation_fidelity_mean": "round(avg(citation_fidelity), 4)",
        "citation_support_mean": "round(avg(citation_support) FILTER (WHERE citation_fidelity IS NOT NULL), 4)",
        "docs_with_unsupported_cites": "count(*) FILTER (WHERE flag_2 <> '')",
        "n_docs_with_cites": "count(citation_fidelity)",
        "n_cites_emitted": "sum(n_citations)::BIGINT",
        "n_cites_nonverbatim": "sum(n_nonverbatim_citations)::BIGINT",
        "n_cites_unsupported": "count(*) FILTER (WHERE flag_2 <> '')",
        "recovered_span_rate": _rate_sql("coalesce(iou, 0) >= 0.5", "is_gold AND source = 'no_facts_span' AND gold_has_facts AND r_start IS NOT NULL"),
        "failure_stratum_n": "count(*) FILTER (WHERE is_gold AND source = 'no_facts_span')",
        "failure_correct_no_facts_rate": _rate_sql("NOT span_found", "is_gold AND source = 'no_facts_span' AND NOT gold_has_facts"),
        "auto_vs_human_n": "count(*) FILTER (WHERE is_gold AND human_rating IS NOT NULL AND auto_rating IS NOT NULL)",
        "auto_vs_human_agreement": _rate_sql("human_rating = auto_rating", "is_gold AND human_rating IS NOT NULL AND auto_rating IS NOT NULL"),
        "parties_nonempty_rate": _rate_sql("n_parties > 0"),
        "posture_rate": _rate_sql("has_posture"),
        "key_events_mean": "round(avg(n_key_events), 4)",
        "record_cites_mean": "round(avg(n_record_cites), 4)",
        "case_cites_mean": "round(avg(n_case_cites), 4)",
        "cost_usd_per_doc": "round(avg(cost_usd), 4)",
        "cost_usd_total": "round(sum(cost_usd), 4)",
        "latency_s_mean": "round(avg(latency_s), 4)",
        "latency_s_median": "round(median(latency_s), 4)",
    }.items()
)


@query(f"{_EVALS} SELECT method, {_SUMMARY} FROM rated GROUP BY method")
def method_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Ev.summarize(_evals(spark, sf_dir), "method")


@query(f"{_EVALS} SELECT method, source AS value, {_SUMMARY} FROM rated GROUP BY ALL")
def method_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Ev.stratify(_evals(spark, sf_dir), "source")


@query(f"{_EVALS} SELECT method, stratum_lang AS value, {_SUMMARY} FROM rated GROUP BY ALL")
def method_by_stratum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Ev.stratify(_evals(spark, sf_dir), "lang")


@query(f"""{_EVALS}, paired AS (
  SELECT {_IOU.format(a="a.p", b="b.p")} AS iou FROM rated a JOIN rated b USING (gold_id) WHERE a.method = 'rules_v2' AND b.method = 'llm-a'
)
SELECT 'rules_v2' AS a, 'llm-a' AS b, count(*) AS n, round(avg(iou), 4) AS iou_mean, round(median(iou), 4) AS iou_median, {_rate_sql("iou >= 0.9")} AS iou_ge_0_9 FROM paired""")
def method_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Ev.agreement(_evals(spark, sf_dir), "rules_v2", "llm-a")


@query(f"""{_EVALS}, paired AS (
  SELECT b.iou - a.iou AS d FROM rated a JOIN rated b USING (gold_id) WHERE a.method = 'rules_v2' AND b.method = 'llm-a' AND a.is_gold AND b.is_gold AND a.iou IS NOT NULL AND b.iou IS NOT NULL
)
SELECT 'rules_v2' AS a, 'llm-a' AS b, count(*) AS n_pairs, round(avg(d), 4) AS iou_delta_mean, count(*) FILTER (WHERE d > 0.01) AS wins,
       count(*) FILTER (WHERE abs(d) <= 0.01) AS ties, count(*) FILTER (WHERE d < -0.01) AS losses FROM paired""")
def method_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Ev.compare(_evals(spark, sf_dir), "rules_v2", "llm-a")


@query(f"""{_EVALS}
SELECT method, human_rating, auto_rating, count(*) AS n FROM rated WHERE is_gold AND human_rating IS NOT NULL AND auto_rating IS NOT NULL GROUP BY ALL""")
def rating_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Ev.confusion(_evals(spark, sf_dir))


@query(f"""{_EVALS}
SELECT method, string_split(f, ':')[1] AS flag, count(*) AS n FROM (SELECT method, unnest([flag_1, flag_2]) AS f FROM rated) WHERE f <> '' GROUP BY ALL""")
def flag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Ev.flag_counts(_evals(spark, sf_dir))


@query(f"""{_EVALS}
SELECT round(iou, 3) AS iou, gold_id, source, pred_confidence, note_1 AS notes FROM rated WHERE method = 'llm-a' AND is_gold AND iou IS NOT NULL
ORDER BY rated.iou, gold_id LIMIT 10""")
def worst_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Ev.worst(_evals(spark, sf_dir), "llm-a")


@query(f"""{_EVALS}, now AS (SELECT method, {_SUMMARY} FROM rated GROUP BY method),
checks AS (
  SELECT method, 'n_errors' AS metric, 0.0::DOUBLE AS baseline, n_errors::DOUBLE AS current, 0.0::DOUBLE AS max_drop, n_errors = 0 AS ok, CASE WHEN n_errors = 0 THEN '' ELSE 'extractor errors' END AS note FROM now
  UNION ALL SELECT method, m, CASE WHEN method = 'rules_v2' THEN v + 0.015 END, v, d, method <> 'rules_v2' OR v >= v + 0.015 - d - 1e-9,
    CASE WHEN method <> 'rules_v2' THEN 'no baseline' WHEN v >= v + 0.015 - d - 1e-9 THEN '' ELSE 'REGRESSION' END
  FROM (SELECT method, unnest([{{'m': 'iou_mean', 'v': iou_mean, 'd': 0.02::DOUBLE}}, {{'m': 'citation_fidelity_mean', 'v': citation_fidelity_mean, 'd': 0.01::DOUBLE}},
    {{'m': 'citation_support_mean', 'v': citation_support_mean, 'd': 0.01::DOUBLE}}, {{'m': 'span_found_rate', 'v': span_found_rate, 'd': 0.0::DOUBLE}}], recursive := true) FROM now)
)
SELECT method, metric, round(baseline, 6) AS baseline, round(current, 6) AS current, max_drop, ok, note FROM checks""")
def gate_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = Ev.summarize(_evals(spark, sf_dir), "method", only=("n_errors", "validation_pass_rate", *Ev.THRESHOLDS))
    then = Ev.baseline_from(now.where("method = 'rules_v2'")).withColumns({m: F.col(m) + 0.015 for m in Ev.THRESHOLDS})
    return Ev.gate(now, then).withColumns({"baseline": F.round("baseline", 6), "current": F.round("current", 6)})


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "request_log").withColumn("flags", _strings("flag_1", "flag_2"))


_LOG = f"WITH log AS (SELECT *, substr(ts, 1, 10) AS day FROM ({view_sql('request_log')}) r)"
_PICK = "list_sort(list(latency_s))[1 + round_even({q} * (count(latency_s) - 1), 0)::BIGINT]"


@query(f"""{_LOG}
SELECT CASE WHEN grouping(method) = 0 THEN 'method' WHEN grouping(day) = 0 THEN 'day' ELSE 'all' END AS grouping, CASE WHEN grouping(method) = 0 THEN method WHEN grouping(day) = 0 THEN day ELSE 'all' END AS value,
  count(*) AS n, count(error) AS n_errors, round(count(error) / count(*), 6) AS error_rate, round(count(*) FILTER (WHERE error IS NULL AND span_found) / count(*) FILTER (WHERE error IS NULL), 6) AS span_found_rate,
  round(count(*) FILTER (WHERE error IS NULL AND validation_ok) / count(*) FILTER (WHERE error IS NULL), 6) AS validation_pass_rate,
  round(coalesce(sum(cost_usd) FILTER (WHERE error IS NULL), 0), 3) AS cost_usd_total, round(avg(cost_usd) FILTER (WHERE error IS NULL), 4) AS cost_usd_per_doc,
  round(count(*) FILTER (WHERE error IS NULL AND escalated) / nullif(count(*) FILTER (WHERE error IS NULL AND escalated IS NOT NULL), 0), 6) AS escalation_rate,
  {_PICK.format(q=0.5)} AS latency_p50, {_PICK.format(q=0.95)} AS latency_p95
FROM log GROUP BY GROUPING SETS ((), (method), (day))""")
def requests_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = ("error_rate", "span_found_rate", "validation_pass_rate", "escalation_rate")
    return Obs.summarize_requests(_log(spark, sf_dir)).withColumns({r: F.round(r, 6) for r in rates}).withColumn("cost_usd_total", F.round("cost_usd_total", 3))


@query(f"""{_LOG}
SELECT method, item, n FROM (
  SELECT method, string_split(f, ':')[1] AS item, count(*) AS n FROM (SELECT method, unnest([flag_1, flag_2]) AS f FROM log WHERE error IS NULL) WHERE f <> '' GROUP BY ALL
) QUALIFY row_number() OVER (PARTITION BY method ORDER BY n DESC, item) <= 5""")
def top_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Obs.top_values(_log(spark, sf_dir))


@query(f"""{_LOG}
SELECT method, item, n FROM (SELECT method, error AS item, count(*) AS n FROM log WHERE error IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY method ORDER BY n DESC, item) <= 5""")
def top_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Obs.top_values(_log(spark, sf_dir), "errors")


@query(f"{_LOG} SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM log")
def log_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Obs.time_range(_log(spark, sf_dir))


@query(f"""{_EVALS}
SELECT 'run-' || method AS run_id, '2026-01-0' || CASE WHEN method = 'llm-a' THEN 2 ELSE 1 END || 'T00:00:00' AS timestamp, 'all' AS subset, count(*) AS n_docs, count(*) FILTER (WHERE is_gold) AS n_gold, method,
  round(avg(iou) FILTER (WHERE is_gold), 4) AS iou_mean, {_rate_sql("iou >= 0.9", "is_gold AND iou IS NOT NULL")} AS iou_ge_0_9, round(avg(citation_support) FILTER (WHERE citation_fidelity IS NOT NULL), 4) AS citation_support_mean,
  round(avg(cost_usd), 4) AS cost_usd_per_doc, round(avg(latency_s), 4) AS latency_s_mean
FROM rated GROUP BY method""")
def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Ev.summarize(_evals(spark, sf_dir), "method")
    stamp = F.concat(F.lit("2026-01-0"), F.when(F.col("method") == "llm-a", "2").otherwise("1"), F.lit("T00:00:00+00:00"))
    meta = F.struct(F.concat(F.lit("run-"), F.col("method")).alias("run_id"), stamp.alias("timestamp"), F.lit("all").alias("subset"), "n_docs", "n_gold")
    kept = F.struct("iou_mean", "iou_ge_0_9", "citation_support_mean", "cost_usd_per_doc", "latency_s_mean")
    return Obs.run_history(s.select(meta.alias("meta"), F.create_map("method", kept).alias("summaries")))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold records on documents: every third labelled, by a person or a judge, the rest with suggestions of all kinds."""
    d = F.col("doc_id")
    span = lambda a, b: F.array(F.lit(a), F.col("n_chars").cast("int") + b)
    label = F.struct(
        F.when(d % 3 == 0, F.when(d % 2 == 0, "correct").otherwise("incorrect")).alias("rating"),
        F.when(d % 3 == 0, d % 9 != 0).alias("has_facts"),
        F.when((d % 3 == 0) & (d % 4 == 0), span(0, -1)).alias("gold_span"),
        F.lit("").alias("notes"),
        F.lit(None).cast("string").alias("labeled_at"),
        F.when(d % 3 == 0, F.when(d % 6 == 0, "judge:m").otherwise("ann")).alias("labeler"),
    )
    suggestion = F.struct(
        F.lit("m").alias("judge_model"),
        F.lit("1").alias("judge_version"),
        F.lit("run").alias("judge_run"),
        F.lit("merits_brief").alias("document_kind"),
        (d % 5 != 0).alias("has_facts"),
        F.when(d % 7 == 0, "low").otherwise("high").alias("confidence"),
        F.lit("ok").alias("summary"),
        F.lit("correct").alias("rules_rating"),
        F.when(d % 5 != 0, span(1, -2)).alias("suggested_span"),
        F.when(d % 5 == 1, "rules_span").when(d % 5 == 2, "llm-a_span").when(d % 5 == 3, "judge_corrected").otherwise("none").alias("span_basis"),
    )
    rows = view(spark, sf_dir, "documents").select(
        d.cast("string").alias("gold_id"),
        d.alias("search_result_id"),
        F.when(d % 5 == 0, "no_facts_span").otherwise("audit_set").alias("source"),
        F.create_map(F.lit("confidence"), F.when(d % 2 == 0, "low").otherwise("high")).alias("stratum"),
        F.when(d % 10 != 0, span(0, -1)).alias("rules_span"),
        label.alias("label"),
        F.when(d % 3 == 0, "labeled").otherwise("pending").alias("status"),
        F.when(d % 3 == 1, suggestion).alias("suggestion"),
    )
    full = schema("gold")
    have = {f.name for f in rows.schema}
    return rows.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in full))


_GOLD = """
WITH gold AS (
  SELECT * EXCLUDE (source), CASE WHEN doc_id % 3 = 0 THEN 'labeled' ELSE 'pending' END AS status, CASE WHEN doc_id % 5 = 0 THEN 'no_facts_span' ELSE 'audit_set' END AS source, doc_id % 3 = 0 AND doc_id % 4 = 0 AS spanned FROM documents
)"""


@query(f"""{_GOLD}
SELECT 'total' AS measure, 'all' AS value, count(*) AS n FROM gold
UNION ALL SELECT 'status', status, count(*) FROM gold GROUP BY 2
UNION ALL SELECT 'source/status', source || '/' || status, count(*) FROM gold GROUP BY 2
UNION ALL SELECT 'rating', CASE WHEN doc_id % 2 = 0 THEN 'correct' ELSE 'incorrect' END, count(*) FROM gold WHERE status = 'labeled' GROUP BY 2
UNION ALL SELECT 'labeler', CASE WHEN doc_id % 6 = 0 THEN 'judge' ELSE 'human' END, count(*) FROM gold WHERE status = 'labeled' GROUP BY 2
UNION ALL SELECT 'with_suggestion', 'all', count(*) FROM gold WHERE doc_id % 3 = 1
UNION ALL SELECT 'with_gold_span', 'all', count(*) FROM gold WHERE spanned
UNION ALL SELECT 'boundary_corrected', 'all', count(*) FROM gold WHERE spanned AND doc_id % 10 = 0
UNION ALL SELECT 'boundary_corrected_low_medium', 'all', count(*) FROM gold WHERE spanned AND doc_id % 10 = 0 AND doc_id % 2 = 0""")
def gold_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Gold.stats(_gold(spark, sf_dir))


@query(f"""{_GOLD}
SELECT policy, count(*) AS n FROM (
  SELECT CASE WHEN doc_id % 3 <> 1 OR doc_id % 7 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN 'nonbrief' WHEN doc_id % 5 = 1 THEN 'rules_correct' WHEN doc_id % 5 = 2 THEN 'llm_correct' WHEN doc_id % 5 = 3 THEN 'corrected' END AS policy FROM gold
) GROUP BY policy""")
def gold_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir).groupBy(Gold.accept_policy().alias("policy")).agg(F.count("*").alias("n"))


@query(f"""{_GOLD}, taken AS (SELECT *, doc_id % 3 = 1 AND doc_id % 7 <> 0 AND doc_id % 5 <> 4 AS accepted FROM gold)
SELECT doc_id::VARCHAR AS gold_id, CASE WHEN accepted THEN 'labeled' ELSE status END AS status, CASE WHEN accepted THEN 'judge:m' WHEN status = 'labeled' THEN CASE WHEN doc_id % 6 = 0 THEN 'judge:m' ELSE 'ann' END END AS labeler,
  CASE WHEN accepted AND doc_id % 5 = 0 THEN NULL WHEN accepted THEN CASE WHEN doc_id % 10 <> 0 THEN 'correct' END WHEN status = 'labeled' THEN CASE WHEN doc_id % 2 = 0 THEN 'correct' ELSE 'incorrect' END END AS rating
FROM taken""")
def gold_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = Gold.accept(_gold(spark, sf_dir), at="2026-01-01T00:00:00+00:00")
    return done.select("gold_id", "status", "label.labeler", "label.rating")


@query(f"""{_GOLD}
SELECT gold_id, is_gold, ref_start, ref_end FROM (
  SELECT doc_id::VARCHAR AS gold_id, status = 'labeled' AS is_gold,
    CASE WHEN status = 'labeled' AND doc_id % 4 = 0 THEN 0 WHEN status = 'labeled' AND doc_id % 9 = 0 THEN NULL WHEN doc_id % 10 <> 0 THEN 0 END AS ref_start,
    CASE WHEN status = 'labeled' AND doc_id % 4 = 0 THEN n_chars - 1 WHEN status = 'labeled' AND doc_id % 9 = 0 THEN NULL WHEN doc_id % 10 <> 0 THEN n_chars - 1 END::INT AS ref_end FROM gold
) g""")
def effective_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Ev.effective_span(_gold(spark, sf_dir))
    return rows.select("gold_id", "is_gold", F.get("reference_span", F.lit(0)).alias("ref_start"), F.get("reference_span", F.lit(1)).alias("ref_end"))


@query("""
SELECT doc_id AS search_id FROM documents WHERE doc_id % 3 <> 0 AND doc_id NOT IN (SELECT doc_id FROM labels)
ORDER BY md5('42|' || doc_id), doc_id LIMIT 20""")
def failure_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = view(spark, sf_dir, "documents").select(F.col("doc_id").alias("search_id"), F.when(F.col("doc_id") % 3 == 0, "needs_ocr").otherwise("no_facts_span").alias("reason"))
    return Gold.failure_sample(failures, view(spark, sf_dir, "labels").select(F.col("doc_id").alias("search_result_id"))).select("search_id")


_RATED = "['correct', 'partially_correct', 'incorrect']"


@query(f"""
WITH v AS (SELECT * EXCLUDE (source), CASE WHEN doc_id % 5 = 0 THEN 'no_facts_span' ELSE 'audit_set' END AS source, {_RATED}[doc_id % 3 + 1] AS rating_a, {_RATED}[doc_id % 2 + 1] AS rating_b, doc_id % 4 <> 0 AS facts FROM documents WHERE doc_id % 13 <> 0)
SELECT 'ok' AS measure, 'all' AS source, 'all' AS value, count(*) AS n FROM v
UNION ALL SELECT 'error', 'all', 'all', count(*) FROM documents WHERE doc_id % 13 = 0
UNION ALL SELECT 'document_kind', 'all', 'merits_brief', count(*) FROM v
UNION ALL SELECT 'is_brief_with_facts', 'all', facts::VARCHAR, count(*) FROM v GROUP BY 3
UNION ALL SELECT 'rating_a', source, rating_a, count(*) FROM v GROUP BY 2, 3
UNION ALL SELECT 'rating_b', source, rating_b, count(*) FROM v GROUP BY 2, 3
UNION ALL SELECT 'issues_a', 'all', 'fine', count(*) FROM v
UNION ALL SELECT 'issues_a', 'all', 'starts_late', count(*) FROM v WHERE doc_id % 2 = 0
UNION ALL SELECT 'preferred', 'all', 'A', count(*) FROM v
UNION ALL SELECT 'confidence', 'all', 'high', count(*) FROM v
UNION ALL SELECT 'corrected_spans', 'all', 'all', count(*) FROM v WHERE doc_id % 7 = 0
UNION ALL SELECT 'glaring', 'all', 'all', count(*) FROM v WHERE rating_a = 'incorrect' OR NOT facts""")
def verdict_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Gold.verdict_summary(_verdicts(spark, sf_dir))


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    rated = F.array(F.lit("correct"), F.lit("partially_correct"), F.lit("incorrect"))
    pick = lambda n: F.element_at(rated, (d % n + 1).cast("int"))
    span = F.array(F.lit(0), F.col("n_chars").cast("int"))
    return view(spark, sf_dir, "documents").select(
        d.cast("string").alias("gold_id"),
        F.when(d % 5 == 0, "no_facts_span").otherwise("audit_set").alias("source"),
        F.lit("rules_v2").alias("method_a"),
        F.lit("llm-a").alias("method_b"),
        span.alias("span_a"),
        F.when(d % 6 != 0, span).alias("span_b"),
        F.lit("merits_brief").alias("document_kind"),
        (d % 4 != 0).alias("is_brief_with_facts"),
        pick(3).alias("rating_a"),
        pick(2).alias("rating_b"),
        F.when(d % 2 == 0, F.array(F.lit("fine"), F.lit("starts_late"))).otherwise(F.array(F.lit("fine"))).alias("issues_a"),
        F.array().cast("array<string>").alias("issues_b"),
        F.lit("A").alias("preferred"),
        F.lit("high").alias("confidence"),
        F.lit("s").alias("summary"),
        F.lit("m").alias("judge_model"),
        F.lit("1").alias("judge_version"),
        F.when(d % 7 == 0, span).alias("corrected_span"),
        F.when(d % 13 == 0, "failed").alias("error"),
        d.alias("line"),
    )


@query("""
SELECT doc_id::VARCHAR AS gold_id, doc_id % 4 <> 0 AS has_facts,
  CASE WHEN doc_id % 4 = 0 THEN 'none' WHEN doc_id % 7 = 0 THEN 'judge_corrected' WHEN doc_id % 3 = 0 THEN 'rules_span' WHEN doc_id % 2 = 0 AND doc_id % 6 <> 0 THEN 'llm-a_span' ELSE 'none' END AS span_basis
FROM documents WHERE doc_id % 13 <> 0""")
def judge_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Gold.suggestions(_verdicts(spark, sf_dir), "run")
    return found.select("gold_id", "new_suggestion.has_facts", "new_suggestion.span_basis")


@query("""
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'error' WHEN 1 THEN 'anchor_not_found' WHEN 2 THEN NULL WHEN 3 THEN 'span_text_mismatch' WHEN 4 THEN NULL ELSE 'span_out_of_bounds' END AS trigger,
  CASE doc_id % 6 WHEN 2 THEN 'cheap' WHEN 4 THEN 'cheap' ELSE CASE WHEN doc_id % 5 <> 0 THEN 'strong' WHEN doc_id % 6 <> 0 THEN 'cheap' END END AS tier,
  CASE WHEN doc_id % 6 IN (2, 4) THEN 0.25::DOUBLE WHEN doc_id % 5 <> 0 THEN CASE WHEN doc_id % 6 = 0 THEN 1.5::DOUBLE ELSE 1.75::DOUBLE END WHEN doc_id % 6 <> 0 THEN 0.25::DOUBLE END AS cost_usd
FROM documents""")
def routing_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, d = F.col("doc_id") % 6, F.col("doc_id")
    span = F.struct(F.lit(0).alias("start"), F.lit(5).alias("end"), F.lit("hello").alias("text"))
    notes = F.when(kind == 2, F.array(F.lit("llm_no_facts"))).when(kind == 1, F.array(F.lit("end_anchor_not_found"))).otherwise(F.array().cast("array<string>"))
    cheap = F.when(kind != 0, F.struct(F.when(~kind.isin(1, 2), span).alias("facts_span"), notes.alias("notes")))
    flags = F.when(kind == 3, F.array(F.lit("span_text_mismatch"))).when(kind == 5, F.array(F.lit("empty_facts"), F.lit("span_out_of_bounds"))).otherwise(F.array(F.lit("unsupported_citation:x")))
    reason = Route.trigger(cheap, flags, kind == 1, Route.TRIGGERS)
    tier = lambda ok, cost: F.struct(span.alias("span"), F.array(F.lit("n")).alias("notes"), F.when(ok, cost).alias("cost_usd"), F.lit(1.0).alias("latency_s"), F.when(~ok, "failed").alias("error"))
    rows = view(spark, sf_dir, "documents").select("doc_id", reason.alias("trigger"), tier(kind != 0, F.lit(0.25)).alias("cheap"), tier(d % 5 != 0, F.lit(1.5)).alias("strong"))
    routed = rows.select("doc_id", "trigger", Route.routed(F.col("trigger"), F.col("cheap"), F.col("strong")).alias("r"))
    return routed.select("doc_id", "trigger", "r.tier", "r.cost_usd")


@query("""
WITH r AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations WHERE role = 'assistant')
SELECT d.doc_id, r.text AS reply, r.text IS NULL AS missed FROM documents d LEFT JOIN (SELECT * FROM r WHERE back = 1) r ON r.conv_id = d.doc_id""")
def replayed_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests answered from recordings, the last of each key."""
    key = lambda c: X.request_key(F.lit("m"), F.lit("system"), c.cast("string"))
    recorded = view(spark, sf_dir, "conversations").where("role = 'assistant'").select(key(F.col("conv_id")).alias("key"), "text", F.col("turn").alias("line"))
    asked = view(spark, sf_dir, "documents").select("doc_id", key(F.col("doc_id")).alias("key"))
    return X.replay(asked, recorded).select("doc_id", "reply", F.col("error").isNotNull().alias("missed"))


@query("""
WITH p AS (SELECT doc_id, lang || ' posture' AS posture, 'event of ' || source AS event, text FROM documents), f AS (SELECT *, posture || ' ' || event || ' A B' AS fields FROM p)
SELECT doc_id AS row_id, b AS builder, md5(CASE WHEN doc_id % 5 = 0 AND b <> 'narrative' THEN '' ELSE CASE b WHEN 'narrative' THEN text WHEN 'fields' THEN fields WHEN 'fields3' THEN fields || ' ' || fields || ' ' || fields
  WHEN 'fields5' THEN fields || ' ' || fields || ' ' || fields || ' ' || fields || ' ' || fields WHEN 'fields+narrative' THEN fields || ' ' || text WHEN 'fields3+narrative' THEN fields || ' ' || fields || ' ' || fields || ' ' || text ELSE event END END) AS text_md5
FROM f CROSS JOIN (SELECT unnest(['narrative', 'fields', 'fields3', 'fields5', 'fields+narrative', 'fields3+narrative', 'events']) AS b) builders""")
def query_builders(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = F.array(F.struct(F.lit(None).cast("string").alias("date"), F.concat(F.lit("event of "), "source").alias("text")))
    made = F.struct(F.concat("lang", F.lit(" posture")).alias("procedural_posture"), events.alias("key_events"), F.array(F.lit("A"), F.lit("B")).alias("parties"))
    rows = view(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.col("text").alias("narrative"), F.when(F.col("doc_id") % 5 != 0, made).alias("extraction"))
    return Down.queries(rows).select("row_id", "builder", F.md5("text").alias("text_md5"))


@query("""
WITH mine AS (SELECT l_orderkey AS o, l_partkey % 40 AS t, l_linenumber AS n FROM lineitem), gold AS (SELECT DISTINCT o, t FROM mine WHERE n <= 3), found AS (SELECT DISTINCT o, t FROM mine WHERE n % 2 = 1),
docs AS (SELECT DISTINCT o FROM mine), pairs AS (SELECT coalesce(f.o, g.o) AS o, f.t IS NOT NULL AS found, g.t IS NOT NULL AS gold FROM found f FULL JOIN gold g ON f.o = g.o AND f.t = g.t)
SELECT 'odd' AS method, (SELECT count(*) FROM docs) AS n_docs, (SELECT count(DISTINCT o) FROM found) AS docs_resolved_ge1,
  round(count(*) FILTER (WHERE found AND gold) / count(*) FILTER (WHERE found), 6) AS target_precision, round(count(*) FILTER (WHERE found AND gold) / count(*) FILTER (WHERE gold), 6) AS target_recall,
  (SELECT count(DISTINCT o) FROM found WHERE o % 4 = 0) AS spurious_target_docs, (SELECT count(*) FROM found WHERE o % 4 = 0) AS spurious_targets FROM pairs""")
def targets_precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("row_id"), (F.col("l_partkey") % 40).cast("string").alias("t"), F.col("l_linenumber").alias("n"))
    grouped = rows.groupBy("row_id").agg(F.collect_set(F.when(F.col("n") % 2 == 1, F.col("t"))).alias("targets"), F.collect_set(F.when(F.col("n") <= 3, F.col("t"))).alias("gold_targets"))
    found = grouped.select(F.lit("odd").alias("method"), "row_id", "targets")
    return Down.target_scores(found, grouped.select("row_id", "gold_targets"), grouped.select("row_id", (F.col("row_id") % 4 != 0).alias("has_facts")))


_NAMES = ("rules_v2", "llm-a")
_JUDGE = J.Judge()
_JUDGED = """
SELECT CAST(doc_id AS STRING) AS gold_id, doc_id, text, 'DISTRICT_COURT' AS doc_type_id, length(text) AS n,
       CAST(floor(length(text) / 3.0) AS INT) AS third, CAST(floor(length(text) / 4.0) AS INT) AS quarter
FROM (SELECT doc_id, doc_id || ' ' || text AS text FROM {documents} WHERE length(text) >= 40) numbered"""
_JUDGED_SQL = _JUDGED.replace("{documents}", "documents")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(_JUDGED, documents=view(spark, sf_dir, "documents", wide=True))
    first = F.when(F.col("doc_id") % 5 != 0, F.array(F.lit(0), F.col("third")))
    return rows.select("gold_id", "doc_id", "text", "doc_type_id", first.alias("span_a"), F.array("quarter", "n").alias("span_b"))


@query(f"""
WITH j AS ({_JUDGED_SQL}), told AS (
  SELECT *, CASE WHEN doc_id % 5 = 0 THEN 'no span' ELSE 'characters 0 to ' || third || ', ' || third || ' long' END AS a,
         'characters ' || quarter || ' to ' || n || ', ' || (n - quarter) || ' long' AS b,
         CASE WHEN doc_id % 5 = 0 THEN substr(text, 1, quarter) || chr(10) || '⟦B⟧ ' || substr(text, quarter + 1)
              ELSE chr(10) || '⟦A⟧ ' || substr(text, 1, quarter) || chr(10) || '⟦B⟧ ' || substr(text, quarter + 1, third - quarter) || ' ⟦/A⟧' || chr(10) || substr(text, third + 1) END
         || ' ⟦/B⟧' || chr(10) AS marked FROM j
)
SELECT gold_id, false AS truncated, md5('Document type: DISTRICT_COURT. Characters: ' || n || '.' || chr(10) || 'Candidate A (rules_v2): ' || a || '. Candidate B (llm-a): ' || b || '.' || chr(10)
  || 'Rate each candidate, say which is better, and give anchors of a corrected span if neither is right.' || chr(10) || chr(10) || marked) AS prompt_md5
FROM told""")
def judge_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = J.requests(_judged(spark, sf_dir), _JUDGE, _NAMES)
    return made.select("gold_id", "truncated", F.md5("prompt").alias("prompt_md5"))


def _empty_verdict(**values: str) -> list[Column]:
    fields = (f for f in schema("verdict").fields if f.name not in ("gold_id", "span_a", "span_b"))
    return [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in fields]


@query(f"""
WITH j AS ({_JUDGED_SQL}), placed AS (
  SELECT *, doc_id % 7 = 0 AS cached, trim(substr(text, 1, 15), ' ' || chr(10)) AS first, trim(substr(text, 20, 15), ' ' || chr(10)) AS last FROM j
), found AS (SELECT *, strpos(text, first) - 1 AS begin FROM placed)
SELECT gold_id, CASE WHEN cached THEN 'incorrect' WHEN doc_id % 4 >= 2 THEN 'correct' END AS rating_a,
       CASE WHEN cached THEN 'tie' WHEN doc_id % 4 = 2 THEN 'A' WHEN doc_id % 4 = 3 THEN 'B' END AS preferred,
       CASE WHEN NOT cached AND doc_id % 4 = 3 THEN begin END AS start,
       CASE WHEN NOT cached AND doc_id % 4 = 3 THEN begin + strpos(substr(text, begin + 1), last) - 1 + length(last) END AS stop,
       cached, CASE WHEN cached OR doc_id % 4 >= 2 THEN '' WHEN doc_id % 4 = 1 THEN 'schema' ELSE 'no recorded response' END AS failed
FROM found""")
def judge_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded replies: missing, malformed, preferring A, and preferring B with corrected anchors; every seventh verdict is cached."""
    rows = _judged(spark, sf_dir)
    asked = J.requests(rows, _JUDGE, _NAMES)
    kind = F.col("doc_id") % 4
    candidate = F.struct(F.lit("correct").alias("rating"), F.array(F.lit("boundary")).alias("issues"), F.lit("").alias("comment"))
    whole = F.struct(
        F.lit("brief").alias("document_kind"),
        F.lit(True).alias("is_brief_with_facts"),
        candidate.alias("candidate_a"),
        candidate.alias("candidate_b"),
        F.when(kind == 2, "A").otherwise("B").alias("preferred"),
        F.when(kind == 3, F.trim(F.substring("text", 1, 15))).alias("corrected_start_anchor"),
        F.when(kind == 3, F.trim(F.substring("text", 20, 15))).alias("corrected_end_anchor"),
        F.lit("high").alias("confidence"),
        F.lit("").alias("summary"),
    )
    reply = F.when(kind >= 2, F.to_json(whole)).otherwise('{"document_kind": "brief"}')
    recorded = asked.where(kind != 0).select("key", reply.alias("text"), F.lit(1).alias("line"))
    cache = asked.where("doc_id % 7 = 0").select("cache_key", "gold_id", "span_a", "span_b", *_empty_verdict(rating_a="incorrect", preferred="tie"))
    every, _ = J.run(rows, _JUDGE, _NAMES, recorded, cache)
    span = F.col("corrected_span")
    failed = F.coalesce(F.regexp_extract("error", "^(schema|no recorded response)", 1), F.lit(""))
    return every.select("gold_id", "rating_a", "preferred", F.get(span, 0).alias("start"), F.get(span, 1).alias("stop"), "cached", failed.alias("failed"))


_FORM_GOLD = """
SELECT CAST(doc_id AS STRING) AS gold_id, form, doc_type_id, text, 47 * (40 + doc_id % 11) - 1 AS n,
       CASE form WHEN 1 THEN length('FACTS OF THIS DISPUTE') + 1 WHEN 3 THEN 13 ELSE 0 END AS s
FROM {forms}"""


@query(f"""
WITH f AS ({_FORM_GOLD.replace("FROM {forms}", "FROM (" + view_sql("forms") + ") forms_view")}), e AS (
  SELECT *, form < 6 AS found, CASE WHEN form IN (1, 3) THEN 1.0 WHEN form IN (6, 7) THEN 0.0 END AS iou FROM f WHERE form IN (1, 3, 6, 7)
)
SELECT 'rules_v2' AS method, count(*) AS n_docs, count(*) AS n_gold, 0 AS n_errors, round(avg(iou), 4) AS iou_mean, round(count(*) FILTER (WHERE found) / count(*), 4) AS span_found_rate FROM e""")
def method_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules over documents of known spans; half of them are taken from a cache of an earlier run."""
    rows = spark.sql(_FORM_GOLD, forms=view(spark, sf_dir, "forms", wide=True)).where("form in (1, 3, 6, 7)")
    span = F.array("s", F.col("s") + F.col("n").cast("int"))
    values = {"gold_id": F.col("gold_id"), "source": F.lit("audit_set"), "doc_type_id": F.col("doc_type_id"), "rules_span": span, "status": F.lit("labeled")}
    values["label"] = F.struct(F.lit("correct").alias("rating"), F.lit(True).alias("has_facts"), span.alias("gold_span"), F.lit("").alias("notes"), F.lit("").alias("labeled_at"), F.lit("human").alias("labeler"))
    gold = rows.select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema("gold").fields))
    texts = rows.select("gold_id", "text")
    _, fresh = Run.run_method(rows.where("form in (1, 6)").select("gold_id", "text", "doc_type_id"), "rules_v2")
    run, _ = Run.run_eval(gold, texts, ("rules_v2",), cache=fresh.dropDuplicates(["doc_sha1"]))
    return run.summaries.select("method", "n_docs", "n_gold", F.col("n_errors").cast("int").alias("n_errors"), "iou_mean", "span_found_rate")


@query("""
WITH g AS (SELECT CAST(doc_id AS STRING) AS gold_id, doc_id % 3 <> 0 AS done, doc_id % 2 = 0 AS judged FROM documents)
SELECT 'labeled/any' AS subset, gold_id FROM g WHERE done UNION ALL SELECT 'labeled/human', gold_id FROM g WHERE done AND NOT judged
UNION ALL SELECT 'labeled/judge', gold_id FROM g WHERE done AND judged UNION ALL SELECT 'all/any', gold_id FROM g
UNION ALL SELECT 'smoke/any', gold_id FROM (SELECT gold_id FROM g WHERE done ORDER BY gold_id LIMIT 5) s""")
def selected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = view(spark, sf_dir, "documents")
    done, judged = F.col("doc_id") % 3 != 0, F.col("doc_id") % 2 == 0
    label = F.struct(F.when(judged, "judge:m").otherwise("someone").alias("labeler"))
    gold = docs.select(F.col("doc_id").cast("string").alias("gold_id"), F.when(done, "labeled").otherwise("pending").alias("status"), F.when(done, label).alias("label"))
    out = None
    for subset, who in (("labeled", "any"), ("labeled", "human"), ("labeled", "judge"), ("all", "any"), ("smoke", "any")):
        one = Ev.select_records(gold, subset, who).select(F.lit(f"{subset}/{who}").alias("subset"), "gold_id")
        out = one if out is None else out.unionByName(one)
    return out


_METHODS = ("rules_v2", "llm-1", "routed-1")
#: What recordings say of a brief: by doc_id % 5 a span, a lost anchor, no facts, nothing, a reply cut off; the strong model lacks every seventh.
_REPLAYED = f"""
WITH b AS ({view_sql('dockets')}), cheap AS (
  SELECT doc_id, s, e, doc_id % 5 AS kind, doc_id % 7 <> 0 AS strong,
         CASE doc_id % 5 WHEN 0 THEN 'span' WHEN 1 THEN 'lost' WHEN 2 THEN 'none' ELSE 'error' END AS got,
         CASE doc_id % 5 WHEN 1 THEN 'anchor_not_found' WHEN 3 THEN 'error' WHEN 4 THEN 'error' END AS trigger FROM b
), done AS (
  SELECT doc_id, 'rules_v2' AS method, 'span' AS got, NULL AS tier, NULL AS trigger, NULL::DOUBLE AS cost_usd, s, e FROM cheap
  UNION ALL SELECT doc_id, 'llm-1', got, NULL, NULL, CASE WHEN got <> 'error' THEN 0.25 END, s, e FROM cheap
  UNION ALL SELECT doc_id, 'routed-1', CASE WHEN trigger IS NULL OR NOT strong THEN got ELSE 'span' END,
    CASE WHEN trigger IS NOT NULL AND strong THEN 'strong' WHEN got <> 'error' THEN 'cheap' END, trigger,
    CASE WHEN trigger IS NOT NULL AND strong THEN CASE WHEN got = 'error' THEN 1.5 ELSE 1.75 END WHEN got <> 'error' THEN 0.25 END, s, e FROM cheap
)"""


def _brief_gold(briefs: DataFrame) -> DataFrame:
    span = F.array("s", "e")
    values = {"gold_id": F.col("doc_id"), "source": F.lit("audit_set"), "doc_type_id": F.lit("FEDERAL_APPELLATE"), "rules_span": span, "status": F.lit("labeled")}
    values["label"] = F.struct(F.lit("correct").alias("rating"), F.lit(True).alias("has_facts"), span.alias("gold_span"), F.lit("").alias("notes"), F.lit("").alias("labeled_at"), F.lit("human").alias("labeler"))
    return briefs.select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema("gold").fields))


def _brief_recordings(briefs: DataFrame) -> DataFrame:
    """Recorded replies of both models to the requests about the briefs."""
    kind = F.col("doc_id") % 5
    prompt = X.PROMPTS["llm-1"]
    # Both models' requests read the prepared texts, and every method reads the recordings: each is written once.
    prepared = X.prepared(briefs.select("doc_id", "text", F.lit("FEDERAL_APPELLATE").alias("doc_type_id")))
    documents = written(prepared.select("doc_id", F.col("doc_text").alias("text"), "doc_type_id"))

    def reply(facts, last):
        none = F.array().cast("array<string>")
        said = {
            "has_facts": facts,
            "facts_start_anchor": F.concat(F.lit("The parties of case "), F.col("doc_id").cast("string"), F.lit(" met in March.")),
            "facts_end_anchor": last,
            "parties": F.array(F.lit("A. Party")),
            "procedural_posture": F.lit("On appeal."),
            "key_events": F.array(F.struct(F.lit(None).cast("string").alias("date"), F.lit("They met.").alias("text"))),
            "record_citations": none,
            "case_citations": none,
            "confidence": F.lit("high"),
            "notes": none,
        }
        return F.to_json(F.struct(*(v.alias(k) for k, v in said.items())))

    def recorded(model, where, text, stopped, cost):
        values = {"key": F.col("key"), "model": F.lit(model), "stop_reason": stopped, "text": text, "cli_cost_usd": F.lit(cost)}
        asked = X.model_requests(documents, prompt, model).where(where)
        return asked.select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema("response").fields), F.lit(0).alias("line"))

    end = F.lit("They parted in June.")
    small = reply(kind != 2, F.when(kind == 1, "and these words stand nowhere at all").otherwise(end))
    cut = F.when(kind == 4, "max_tokens").otherwise("end_turn")
    large = recorded("large", F.col("doc_id") % 7 != 0, reply(F.lit(True), end), F.lit("end_turn"), 1.5)
    return written(recorded("small", kind != 3, small, cut, 0.25).unionByName(large))


@query(f"""{_REPLAYED}
SELECT CAST(doc_id AS VARCHAR) AS gold_id, method, CASE WHEN got = 'span' THEN s END AS span_start, CASE WHEN got = 'span' THEN e END AS span_end,
       tier, trigger, cost_usd, got = 'error' AS failed, CASE got WHEN 'span' THEN 1.0 ELSE 0.0 END::DOUBLE AS iou FROM done""")
def replayed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, a replayed model and a route over briefs; the route takes the cheap tier's results from what the model's run cached."""
    briefs = view(spark, sf_dir, "dockets", wide=True)
    run, _ = Run.run_eval(_brief_gold(briefs), briefs.select(F.col("doc_id").cast("string").alias("gold_id"), "text"), _METHODS, responses=_brief_recordings(briefs))
    span = lambda n: F.get("pred_span", F.lit(n))
    return run.per_doc.select(
        "gold_id", "method", span(0).alias("span_start"), span(1).alias("span_end"), "tier", "trigger", "cost_usd", F.col("error").isNotNull().alias("failed"), "iou"
    )


@query(f"""{_REPLAYED}, now AS (
  SELECT method, count(*) FILTER (WHERE got = 'error')::DOUBLE AS n_errors, round(avg(CASE got WHEN 'span' THEN 1.0 ELSE 0.0 END), 4) AS iou_mean,
         round(count(*) FILTER (WHERE got = 'span') / count(*), 4) AS span_found_rate FROM done GROUP BY method
), checks AS (
  SELECT method, 'n_errors' AS metric, 0.0 AS baseline, n_errors AS current, n_errors = 0 AS ok, CASE WHEN n_errors = 0 THEN '' ELSE 'extractor errors' END AS note FROM now
  UNION ALL SELECT method, 'iou_mean', CASE WHEN method <> 'llm-1' THEN 1.0 END, iou_mean, method = 'llm-1' OR iou_mean >= 0.98, CASE WHEN method = 'llm-1' THEN 'no baseline' WHEN iou_mean >= 0.98 THEN '' ELSE 'REGRESSION' END FROM now
  UNION ALL SELECT method, 'span_found_rate', CASE WHEN method <> 'llm-1' THEN 0.5 END, span_found_rate, method = 'llm-1' OR span_found_rate >= 0.5,
    CASE WHEN method = 'llm-1' THEN 'no baseline' WHEN span_found_rate >= 0.5 THEN '' ELSE 'REGRESSION' END FROM now
) SELECT * FROM checks""")
def replayed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over a replayed run: a method without a baseline passes, failed documents do not."""
    briefs = view(spark, sf_dir, "dockets", wide=True)
    texts = briefs.select(F.col("doc_id").cast("string").alias("gold_id"), "text")
    baseline = spark.createDataFrame([("rules_v2", 1.0, 0.5), ("routed-1", 1.0, 0.5)], "method string, iou_mean double, span_found_rate double")
    _, checks = Run.smoke_gate(_brief_gold(briefs), texts, _brief_recordings(briefs), _METHODS, baseline, {"iou_mean": 0.02, "span_found_rate": 0.0})
    return checks.select("method", "metric", "baseline", "current", "ok", "note")
