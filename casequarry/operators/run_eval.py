"""Evaluation runs: methods over gold documents with a cache, scored rows, summaries, comparisons and their files."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import combinations
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.functions import guard as G
from casequarry.operators import extraction as X
from casequarry.operators import methods as Methods
from casequarry.operators import span_eval as Ev
from casequarry.plans import reports
from casequarry.sources import files
from casequarry.tables import dealt, written

STRATA = ("source", "confidence", "len_bin")


def predictions(made: DataFrame, method: str) -> DataFrame:
    """Rows of the chain (``extract_documents``) as predictions of gold documents."""
    e = F.col("extraction")
    size = lambda name: F.greatest(F.size(F.coalesce(e[name], F.array())), F.lit(0))
    span = e["facts_span"]
    return made.select(
        F.col("doc_id").alias("gold_id"),
        F.lit(method).alias("method"),
        F.when(span.isNotNull(), F.array(span["start"], span["end"])).alias("pred_span"),
        e["confidence"].alias("pred_confidence"),
        e["extractor_version"].alias("extractor_version"),
        "validation_ok",
        F.coalesce("flags", F.array().cast("array<string>")).alias("flags"),
        "citation_fidelity",
        "citation_support",
        "n_nonverbatim_citations",
        (size("case_citations") + size("record_citations")).alias("n_citations"),
        size("parties").alias("n_parties"),
        size("key_events").alias("n_key_events"),
        size("record_citations").alias("n_record_cites"),
        size("case_citations").alias("n_case_cites"),
        (F.coalesce(e["procedural_posture"], F.lit("")) != "").alias("has_posture"),
        F.coalesce(e["notes"], F.array().cast("array<string>")).alias("extractor_notes"),
        "error",
        *(c for c in X.CARRIED if c in made.columns and c != "doc_sha1"),
    )


def prepared(documents: DataFrame) -> DataFrame:
    """What methods read of documents (gold_id, text, doc_type_id), written once: it costs far more than it takes to read again.

    Of ``clean`` only the first character stays, which tells whether there is a text.
    """
    keyed = X.prepared(documents.withColumnRenamed("gold_id", "doc_id")).withColumn("doc_sha1", Methods.text_key(F.col("text"))).drop("text")
    return written(keyed.withColumns({"suspected": G.suspected(F.col("doc_text")), "clean": F.substring("clean", 1, 1)}))


def run_method(documents: DataFrame, method: str, cache: DataFrame | None = None, responses: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Predictions of one method for documents (gold_id, text, doc_type_id), and the results to add to the cache.

    Cached results are ``methods.RESULT``; one of another text or configuration is not taken, and a route takes its
    cheap tier's.  They are validated again, so that a changed check shows.  Failed documents are not cached.
    Recorded ``responses`` answer for models; without any, a model's uncached documents fail.
    """
    return run_prepared(prepared(documents), method, cache, responses)


def run_prepared(keyed: DataFrame, method: str, cache: DataFrame | None = None, responses: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``run_method`` over ``prepared`` documents."""
    # The results are read for predictions and for the cache, and by later methods: written once.
    made = written(dealt(Methods.results(keyed, method, responses, cache), "doc_id"))
    fresh = made.where(X.readable()).where("error is null and extraction is not null and not cached").dropDuplicates(["doc_sha1"])
    return predictions(X.checked_extractions(made), method), fresh.withColumn("config_sha", F.lit(Methods.config_sha(method))).select(*Methods.RESULT)


@dataclass
class Run:
    """Scored rows of a run; its tables are made when they are asked for, since medians take jobs of their own."""

    per_doc: DataFrame
    methods: tuple[str, ...]
    by: tuple[str, ...] = STRATA

    @cached_property
    def summaries(self) -> DataFrame:
        return Ev.summarize(self.per_doc, "method")

    @cached_property
    def strata(self) -> dict[str, DataFrame]:
        return {k: Ev.stratify(self.per_doc, k) for k in self.by}

    @cached_property
    def agreements(self) -> DataFrame | None:
        """Of all pairs of methods."""
        return _union([Ev.agreement(self.per_doc, a, b) for a, b in combinations(self.methods, 2)])

    @cached_property
    def comparisons(self) -> DataFrame | None:
        """With the first method."""
        return _union([Ev.compare(self.per_doc, self.methods[0], m) for m in self.methods[1:]])


def _union(frames: list[DataFrame]) -> DataFrame | None:
    return reduce(DataFrame.unionByName, frames) if frames else None


def evaluate(gold: DataFrame, found: DataFrame, methods: tuple[str, ...], strata: tuple[str, ...] = STRATA) -> Run:
    """Scores of all methods' predictions."""
    absent = {"human_rating": "string", "gold_has_facts": "boolean", "n_nonverbatim_citations": "int", "cost_usd": "double", "latency_s": "double"}
    columns: dict[str, Column] = {n: F.lit(None).cast(k) for n, k in absent.items() if n not in found.columns and n not in gold.columns}
    label = {"human_rating": F.col("label.rating"), "gold_has_facts": F.col("label.has_facts")}
    # Summaries, strata and pairs all read the scored rows, so these are written once.
    scored = written(Ev.evaluate_documents(gold, found).withColumns(columns | label))
    return Run(scored, methods, strata)


def run_eval(
    gold: DataFrame,
    texts: DataFrame,
    methods: tuple[str, ...],
    subset: str = "labeled",
    labeled_by: str = "any",
    limit: int | None = None,
    cache: DataFrame | None = None,
    responses: DataFrame | None = None,
) -> tuple[Run, DataFrame]:
    """Methods over the selected gold records with texts (gold_id, text): the scored run, and new cache rows.

    What a method adds to the cache is there for the methods after it, as the cheap tier of a route.
    """
    chosen = Ev.select_records(gold, subset, labeled_by, limit)
    documents = prepared(dealt(chosen.select("gold_id", "doc_type_id"), "gold_id").join(dealt(texts.select("gold_id", "text"), "gold_id"), "gold_id"))
    found, fresh = [], []
    for method in methods:
        known = [f for f in (cache, *fresh) if f is not None]
        made, new = run_prepared(documents, method, reduce(DataFrame.unionByName, known) if known else None, responses)
        found.append(made)
        fresh.append(new)
    return evaluate(chosen, reduce(DataFrame.unionByName, found), methods), reduce(DataFrame.unionByName, fresh)


def smoke_gate(
    gold: DataFrame, texts: DataFrame, responses: DataFrame, methods: tuple[str, ...], baseline: DataFrame | None, thresholds: dict[str, float] | None = None, cache: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Summaries of methods replayed from recorded responses over all gold records, and their checks against a baseline.

    All that comes after the model runs again: anchors, reply forms, validation, routing, overlap.
    """
    run, _ = run_eval(gold, texts, methods, subset="all", cache=cache, responses=responses)
    now = written(run.summaries)
    then = baseline if baseline is not None else Ev.baseline_from(now, thresholds).limit(0)
    return now, Ev.gate(now, then, thresholds)


def save(run: Run, folder: str, meta: dict[str, Any]) -> None:
    """per_doc lines, summary.json, report.md and manifest.json of a run in ``folder``; its tables are aggregates but for per_doc."""
    spark = run.per_doc.sparkSession
    kept = ["gold_id", "method", "source", "reference_span", "is_gold", "pred_span", "iou", "auto_rating", "span_found", "pred_confidence", "validation_ok", "flags", "extractor_notes", "cost_usd", "latency_s", "error"]
    files.write_lines(run.per_doc.select(*kept), f"{folder}/per_doc")
    tables = {"summaries": run.summaries, **{f"strata_{k}": v for k, v in run.strata.items()}, "agreements": run.agreements, "comparisons": run.comparisons}
    rows = {name: reports.collected(df) for name, df in tables.items() if df is not None}
    summaries = {r["method"]: {k: v for k, v in r.items() if k != "method"} for r in rows.pop("summaries")}
    files.write_json(spark, {"meta": meta, "summaries": summaries, **rows}, f"{folder}/summary.json")
    files.write_text(spark, reports.extraction_report(run.summaries, run.strata, run.agreements, run.comparisons), f"{folder}/report.md")
    record = files.manifest_here({k: v for k, v in meta.items() if k != "timestamp"}, str(meta.get("timestamp", "")))
    files.write_json(spark, files.finished(record, str(meta.get("timestamp", "")), {"methods": summaries}), f"{folder}/manifest.json")
