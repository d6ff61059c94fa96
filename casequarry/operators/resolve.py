"""Resolving citations: cache lookups, match rules, budgets and target lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.operators.running import running
from casequarry.schemas import schema
from casequarry.tables import new_path, parted, parts, written

VERSION = "resolver-1"
LEAST_CONFIDENCE, FUZZY = 0.90, 0.85
BATCH, PER_BUILD, PER_HOUR, PER_DAY = 50, 10_000, 5_000, 25_000


def cache_state(citations: DataFrame, cache: DataFrame, version: str = VERSION) -> DataFrame:
    """Citations (row_id, pos, normalized, ...) with resolved_id and state: resolved, cached_unresolved or uncached.

    Entries of another resolver version count as absent.  The cache is keyed by the
    normal form; it is joined by size, not broadcast by decree.  Both tables are written: finding citations may be
    costly, and the join is cut into as many parts as their number needs.
    """
    spark, citations = citations.sparkSession, written(citations)
    entries = cache.where(F.col("resolver_version") == version).select("normalized", "resolved_id", "resolution_status", "confidence", F.lit(True).alias("known"))
    joined = citations.join(entries, "normalized", "left")
    hit = (F.col("resolution_status") == "resolved") & (F.coalesce(F.col("resolved_id"), F.lit("")) != "")
    state = F.when(hit, "resolved").when(F.col("known"), "cached_unresolved").otherwise("uncached")
    with parted(spark, citations.count()):
        return written(joined.withColumn("state", state).withColumn("resolved_id", F.when(hit, F.col("resolved_id"))).drop("known", "resolution_status"))


def targets(resolved: DataFrame) -> DataFrame:
    """(row_id, targets, resolved_citation_count): distinct ids by first occurrence, and all resolved occurrences."""
    first = resolved.where("state = 'resolved'").groupBy("row_id", "resolved_id").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    return first.groupBy("row_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("first", "resolved_id"))), lambda x: x["resolved_id"]).alias("targets"),
        F.sum("n").alias("resolved_citation_count"),
    )


def cite_stats(resolved: DataFrame) -> DataFrame:
    """Per row: case citations, distinct ones, and how many of these are resolved, known unresolved and unknown.

    ``resolved`` is counted first; it is dealt once by its rows, into parts whose size does not grow with the table.
    """
    dealt = resolved.repartition(parts(resolved.sparkSession, resolved.count()), "row_id")
    distinct = dealt.groupBy("row_id", "normalized").agg(F.count("*").alias("n"), F.first("state").alias("state"), F.first("resolved_id").alias("resolved_id"))
    return distinct.groupBy("row_id").agg(
        F.sum("n").alias("n_case_cites"),
        F.count("*").alias("n_unique"),
        F.count_if(F.col("state") == "resolved").alias("n_resolved"),
        F.count_if(F.col("state") == "cached_unresolved").alias("n_cached_unresolved"),
        F.count_if(F.col("state") == "uncached").alias("n_uncached"),
        F.count_distinct("resolved_id").alias("n_targets"),
    )


def _squashed(cite: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(cite, r"(?U)\s+", " "), r"\A | \z", "")


def _components(cite: Column) -> Column:
    """Volume and page of a citation as one string; null if it has no such form."""
    return F.when(_squashed(cite).rlike(r"\A\d+ .+ \d+\z"), F.regexp_replace(_squashed(cite), r"\A(\d+) .+ (\d+)\z", "$1|$2"))


def match(candidates: DataFrame, least: float = LEAST_CONFIDENCE) -> DataFrame:
    """Decisions (normalized, resolved_id, confidence, excluded_reason) from (normalized, results).

    A result matches exactly (1.0) or by volume and page (0.85); a citation is resolved if
    all results at or above ``least`` are one cluster.
    """
    rows = candidates.select("normalized", F.explode_outer("results").alias("r"))

    def confidence(cites: Column) -> Column:
        exact = F.exists(cites, lambda c: _squashed(c) == _squashed(F.col("normalized")))
        loose = F.exists(cites, lambda c: _components(c) == _components(F.col("normalized")))
        return F.when(F.coalesce(exact, F.lit(False)), 1.0).when(F.coalesce(loose, F.lit(False)), FUZZY).otherwise(0.0)

    scored = rows.withColumn("conf", F.when(F.col("r.cluster_id").isNotNull(), confidence(F.col("r.citation"))).otherwise(0.0))
    good = (F.col("conf") >= least) & (F.col("conf") > 0)
    cluster = F.when(good, F.col("r.cluster_id"))
    summed = scored.groupBy("normalized").agg(
        F.count("r").alias("n"), F.count_distinct(cluster).alias("clusters"), F.max(cluster).alias("id"), F.max(F.when(good, F.col("conf"))).alias("best")
    )
    one = F.col("clusters") == 1
    return summed.select(
        "normalized",
        F.when(one, F.col("id").cast("string")).alias("resolved_id"),
        F.when(one, F.col("best")).alias("confidence"),
        F.when(one, F.lit(None)).when(F.col("n") == 0, "no_match").otherwise("low_confidence_or_ambiguous").alias("excluded_reason"),
    )


def within_budget(requests: DataFrame, order: list[str], batch: int = BATCH, limit: int = PER_BUILD, numbered: bool = True) -> DataFrame:
    """Adds ``chunk`` and ``allowed``: whole chunks are spent until one does not fit; it and all later ones are refused.

    Chunks are numbered by prefix sums over ranges, so the cut needs no pass through one task.  Without ``numbered``
    ranges behind the limit are refused as they are, with no chunk.
    """
    placed = running(requests, order, name="_place", only_below=None if numbered else max(limit, 0))
    chunk = F.floor((F.col("_place") - 1) / batch)
    spent = F.least((chunk + 1) * batch, F.col("_place_total"))
    return placed.select(*requests.columns, chunk.alias("chunk"), (F.col("_place").isNotNull() & (spent <= limit)).alias("allowed"))


def fill_cache(cache: DataFrame, decided: DataFrame, at: str, version: str = VERSION) -> DataFrame:
    """The cache with new decisions, which replace entries of the same citation; budget refusals are not cached."""
    kept = decided.where(F.coalesce(F.col("excluded_reason"), F.lit("")) != "api_budget_exceeded")
    new = kept.select(
        "normalized",
        "resolved_id",
        F.when(F.col("resolved_id").isNotNull(), "resolved").otherwise("unresolved").alias("resolution_status"),
        "confidence",
        F.lit(at).alias("timestamp"),
        F.lit(version).alias("resolver_version"),
    )
    return cache.join(new, "normalized", "left_anti").select(*new.columns).unionByName(new)


def hit_rate(lookups: DataFrame) -> DataFrame:
    return lookups.agg(F.coalesce(F.avg((F.col("state") != "uncached").cast("double")), F.lit(0.0)).alias("hit_rate"))


#: What a service says about a citation: its results, or a raised error.
Lookup = Callable[[str], list[dict]]
REFUSED, FAILED = "api_budget_exceeded", "api_error_after_retries"
_ASKED = "normalized string, results array<struct<cluster_id:bigint,citation:array<string>>>, error string"


def _asking(lookup: Lookup):
    """Each citation's results or error; an error is an outcome, so it costs no other lookup its result."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            said: list[tuple] = []
            for cite in rows["normalized"]:
                try:
                    said.append((cite, lookup(cite), None))
                except Exception as e:  # noqa: BLE001  whatever the service raises
                    said.append((cite, None, f"{FAILED}: {e}"))
            yield pd.DataFrame(said, columns=["normalized", "results", "error"])

    return ask


class Ledger:
    """Outcomes of lookups by chunk under a folder; a chunk counts once its folder is complete."""

    def __init__(self, spark, folder: str):
        self.spark, self.folder = spark, folder
        self.fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.fs_path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def done(self) -> list[str]:
        """Folders of the chunks that were written to their end."""
        if not self.fs.exists(self.fs_path(self.folder)):
            return []
        paths = [str(f.getPath()) for f in self.fs.listStatus(self.fs_path(self.folder))]
        return sorted(p for p in paths if self.fs.exists(self.fs_path(f"{p}/_SUCCESS")))

    def outcomes(self) -> DataFrame:
        done = self.done()
        return self.spark.read.schema(_ASKED).parquet(*done) if done else self.spark.createDataFrame([], _ASKED)

    def write(self, number: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/chunk-{number:06d}")


def spend(wanted: DataFrame, lookup: Lookup, ledger: Ledger, batch: int = BATCH, limit: int = PER_BUILD) -> DataFrame:
    """(normalized, results, error, refused) of citations (normalized, nth), asked in chunks in the order of ``nth``.

    What the ledger has is not asked again and counts against the budget.  A chunk's outcomes are written before the
    next chunk is asked; after a stop the next call goes on behind the last complete chunk, and a lost executor
    repeats at most its own chunk's lookups.  At most limit / batch chunks run, of ``batch`` lookups each.
    """
    spark = wanted.sparkSession
    wanted = written(wanted)
    done = ledger.done()
    spent = ledger.outcomes()
    with parted(spark, wanted.count()):
        left = written(within_budget(wanted.join(spent.select("normalized"), "normalized", "left_anti"), ["nth", "normalized"], batch, limit - spent.count(), False))
    allowed = written(left.where("allowed").coalesce(1))  # no more than the limit
    chunks = allowed.agg(F.max("chunk")).first()[0]
    tasks = min(batch, spark.sparkContext.defaultParallelism)
    for chunk in range(0 if chunks is None else chunks + 1):
        asked = allowed.where(F.col("chunk") == chunk).select("normalized").repartition(tasks)
        ledger.write(len(done) + chunk, asked.mapInPandas(_asking(lookup), _ASKED))
    told = ledger.outcomes()
    ours = wanted.select("normalized").join(told.select("normalized"), "normalized", "left_semi")  # of the side that may be large
    told = told.join(ours, "normalized", "left_semi").withColumn("refused", F.lit(False))
    refused = left.where("not allowed").select("normalized", *(F.lit(None).cast(told.schema[c].dataType).alias(c) for c in ("results", "error")), F.lit(True).alias("refused"))
    return told.unionByName(refused)


def resolve_run(
    citations: DataFrame, cache: DataFrame, lookup: Lookup, folder: str | None = None, batch: int = BATCH, limit: int = PER_BUILD, at: str = "", version: str = VERSION
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Resolve citations (row_id, pos, normalized, ...) from the cache and, within the budget, by lookups.

    Returns the citations with resolution_status, resolved_id, confidence and excluded_reason, the cache with all new
    decisions, and one row of counts.  ``folder`` holds the ledger; the same one resumes a stopped run.
    Unknown citations are asked in the order of their first occurrence, each once.  Citations, which may be costly to
    find, are written first and read from there.
    """
    spark = citations.sparkSession
    citations = written(citations)
    rows = citations.count()
    named = citations.where(F.coalesce("normalized", F.lit("")) != "")
    known = cache.where(F.col("resolver_version") == version)
    hit = (F.col("resolution_status") == "resolved") & (F.coalesce("resolved_id", F.lit("")) != "")
    entries = known.select(
        "normalized", F.when(hit, F.col("resolved_id")).alias("resolved_id"), "confidence", F.when(~hit, F.lit("cached_unresolved")).alias("excluded_reason"), F.lit("cache").alias("via")
    )
    with parted(spark, rows):
        first = written(named.groupBy("normalized").agg(F.min(F.struct("row_id", "pos")).alias("nth")).join(entries, "normalized", "left"))
    cached = first.where("via is not null").drop("nth")
    ledger = Ledger(spark, folder or new_path(spark))
    answers = written(spend(first.where("via is null").select("normalized", "nth"), lookup, ledger, batch, limit))
    matched = match(answers.where("not refused and error is null").select("normalized", "results"))
    nothing = [F.lit(None).cast("string").alias("resolved_id"), F.lit(None).cast("double").alias("confidence")]
    failed = answers.where("error is not null").select("normalized", *nothing, F.col("error").alias("excluded_reason"))
    asked = matched.unionByName(failed)
    refused = answers.where("refused").select("normalized", *nothing, F.lit(REFUSED).alias("excluded_reason"))
    decided = written(cached.unionByName(asked.withColumn("via", F.lit("lookup"))).unionByName(refused.withColumn("via", F.lit("refused"))))
    status = F.when(F.col("resolved_id").isNotNull(), "resolved").otherwise("unresolved").alias("resolution_status")
    rest = [c for c in citations.columns if c not in ("resolution_status", "resolved_id", "confidence", "excluded_reason")]
    with parted(spark, rows):
        enriched = written(citations.select(*rest).join(decided, "normalized", "left").select(*rest, status, "resolved_id", "confidence", "excluded_reason", "via"))
    new_cache = fill_cache(cache.select(*schema("citation_cache").names), decided.where("via = 'lookup'"), at, version)
    of = lambda via: F.count_if(F.col("via") == via)
    unique = decided.agg(F.count("*").alias("total_submitted"), of("cache").alias("cache_hits"), of("lookup").alias("api_calls"), of("refused").alias("budget_exceeded_count"))
    found = F.col("resolved_id").isNotNull()
    counted = enriched.where("via is not null").agg(F.count_if(found).alias("resolved_count"), F.count_if(~found & (F.col("via") != "refused")).alias("unresolved_count"))
    metrics = unique.crossJoin(F.broadcast(counted))  # one row each
    return enriched.drop("via"), new_cache, metrics


def run_targets(enriched: DataFrame) -> DataFrame:
    """(row_id, targets, resolved_citation_count) of a run's citations."""
    return targets(enriched.withColumn("state", F.col("resolution_status")))
