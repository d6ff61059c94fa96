"""The dataset build: from search hits with texts to pipeline rows and failures, in one pass.

Every hit becomes exactly one row or one failure: the first reason that applies wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casequarry.functions import citations as Cites
from casequarry.functions import ocr as O
from casequarry.functions import scope as Scope
from casequarry.functions import spans as S
from casequarry.functions import text as T
from casequarry.operators import resolve as Res

REASONS = ("no_pdf_url", "out_of_scope", "pdf_download_failed", "needs_ocr", "no_facts_span")


def classify(hits: DataFrame, texts: DataFrame, site: str, storage: str, scope_filter: bool = True) -> DataFrame:
    """Hits joined with texts (id, text, page_count) and everything known about them; ``reason`` is null for rows."""
    fields = {n: F.col(n) for n in ("filepath_local", *Scope.URL_FIELDS, *Scope.PAGE_FIELDS) if n in hits.columns}
    known = hits.withColumn("link", Scope.file_url(fields, F.lit(None).cast("string"), site, storage))
    known = known.withColumn("in_scope", Scope.in_scope(F.col("short_description"), F.col("description")) if scope_filter else F.lit(True))
    known = known.withColumn("doc_type_id", Scope.document_type(F.col("court"), F.col("court_id"), F.col("short_description"), F.col("description")))
    read = known.join(texts, "id", "left").withColumn("clean", T.normalize(F.coalesce("text", F.lit(""))))
    early = (
        F.when(F.col("link.url").isNull(), "no_pdf_url")
        .when(~F.col("in_scope"), "out_of_scope")
        .when(F.col("text").isNull(), "pdf_download_failed")
        .when(O.needs_ocr(F.col("clean"), F.col("page_count")), "needs_ocr")
    )
    judged = read.withColumn("early", early)
    found = judged.withColumn("span", S.facts_span(F.when(F.col("early").isNull(), F.col("clean")), F.col("doc_type_id")))
    return found.withColumn("reason", F.coalesce("early", F.when(F.col("span.start").isNull(), "no_facts_span"))).drop("early", "clean", "text")


def failures(classified: DataFrame) -> DataFrame:
    return classified.where("reason is not null").select(F.col("id").alias("search_id"), "reason", F.col("link.url").alias("pdf_url"), F.col("span.notes").alias("notes"))


def rows(classified: DataFrame, cache: DataFrame, build_id: str) -> DataFrame:
    """Pipeline rows with masked facts, citation counts and targets resolved through the cache."""
    kept = classified.where("reason is null").withColumn("cites", Cites.extract("span.text"))
    cites = kept.select(F.col("id").alias("row_id"), F.posexplode(Cites.of_kind(F.col("cites"), "case")).alias("pos", "c")).select("row_id", "pos", "c.normalized")
    targets = Res.targets(Res.cache_state(cites, cache)).withColumnRenamed("row_id", "id")
    joined = kept.join(targets, "id", "left").withColumn("flags", S.quality_flags(F.col("span.text"))).withColumn("said", Cites.summary(F.col("cites")))
    return joined.select(
        F.col("id").alias("search_result_id"),
        F.lit(build_id).alias("build_id"),
        "short_description",
        "document_type",
        "doc_type_id",
        F.col("link.url").alias("pdf_url"),
        F.col("link.strategy").alias("pdf_url_strategy"),
        F.col("span.start").cast("bigint").alias("facts_start"),
        F.col("span.end").cast("bigint").alias("facts_end"),
        F.col("span.text").alias("facts_text"),
        Cites.masked("span.text").alias("facts_text_masked"),
        F.lit(S.RULES_VERSION).alias("extractor_method"),
        F.col("span.notes").alias("extractor_notes"),
        F.col("span.confidence").alias("extractor_confidence"),
        F.to_json(F.coalesce("targets", F.array().cast("array<string>"))).alias("targets_case_ids"),
        F.coalesce("resolved_citation_count", F.lit(0)).cast("bigint").alias("resolved_citation_count"),
        "flags.*",
        "said.*",
    )
