"""Methods by name over documents: rules, models answered from recordings, and routes of two tiers, with a cache of results."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.functions import spans as S
from casequarry.functions import validators as V
from casequarry.operators import extraction as X
from casequarry.operators import routing as Route
from casequarry.schemas import schema
from casequarry.tables import dealt, written

#: Columns of the cache of results.
RESULT = ("doc_sha1", "config_sha", "extraction", "cost_usd", "latency_s", "input_tokens", "output_tokens", "tier", "trigger")
_TIER = ("extraction", "error", "cost_usd", "latency_s", "input_tokens", "output_tokens")
_KINDS = {"cost_usd": "double", "latency_s": "double", "input_tokens": "bigint", "output_tokens": "bigint", "tier": "string", "trigger": "string"}


@dataclass(frozen=True)
class Rules:
    """An extractor of the registry."""

    name: str


@dataclass(frozen=True)
class Model:
    """A model asked with one version of the request."""

    prompt: X.Prompt
    model: str


@dataclass(frozen=True)
class Tiers:
    """A cheap method whose doubtful results a strong model does again."""

    cheap: str
    strong: Model
    triggers: tuple[str, ...] = Route.TRIGGERS


METHODS: dict[str, Rules | Model | Tiers] = {
    S.RULES_VERSION: Rules(S.RULES_VERSION),
    "llm-1": Model(X.PROMPTS["llm-1"], "small"),
    "llm-2": Model(X.PROMPTS["llm-2"], "small"),
    "routed-1": Tiers("llm-1", Model(X.PROMPTS["llm-1"], "large")),
    "routed-2": Tiers("llm-2", Model(X.PROMPTS["llm-2"], "large")),
}


def method(name: str) -> Rules | Model | Tiers:
    if name in METHODS:
        return METHODS[name]
    if name in X.EXTRACTORS:
        return Rules(name)
    raise KeyError(f"unknown method {name!r}; known: {sorted({*METHODS, *X.EXTRACTORS})}")


def config_sha(name: str) -> str:
    """Twelve hex digits that change with whatever changes a method's results: requests, models, triggers, both tiers."""
    made = method(name)
    said = {"name": name, "kind": type(made).__name__, **asdict(made)}
    if isinstance(made, Tiers):
        said["cheap"] = config_sha(made.cheap)
    return hashlib.sha256(json.dumps(said, sort_keys=True).encode()).hexdigest()[:12]


def text_key(text: Column) -> Column:
    """What a document's results are found by."""
    return F.substring(F.sha1(F.coalesce(text, F.lit(""))), 1, 16)


def results(documents: DataFrame, name: str, responses: DataFrame | None = None, cache: DataFrame | None = None) -> DataFrame:
    """Documents (``extraction.prepared``, doc_sha1) with one method's extraction, error, cost, time, tokens, tier, trigger and ``cached``."""
    kept, todo = None, documents
    if cache is not None:
        hits, todo = X.cached(documents, cache.select(*RESULT), config_sha(name))
        kept = hits.withColumn("error", F.lit(None).cast("string")).withColumn("cached", F.lit(True))
    made = method(name)
    if isinstance(made, Rules):
        found = todo.withColumn("extraction", X.EXTRACTORS[made.name](F.col("doc_text"), F.coalesce("doc_type_id", F.lit("UNKNOWN"))))
        found = found.withColumn("error", F.lit(None).cast("string"))
    elif isinstance(made, Model):
        found = _answered(todo, made, responses)
    else:
        found = _routed(todo, name, made, responses, cache)
    found = found.withColumn("extraction", F.col("extraction").cast(schema("extraction")))
    found = found.withColumns({n: F.lit(None).cast(k) for n, k in _KINDS.items() if n not in found.columns}).withColumn("cached", F.lit(False))
    return found if kept is None else found.unionByName(kept.select(*found.columns))


def _answered(documents: DataFrame, model: Model, responses: DataFrame | None) -> DataFrame:
    """Recorded replies of a model; documents that cannot be read are not asked about, failed ones cost nothing."""
    if responses is None:
        absent = {n: F.lit(None).cast(k) for n, k in {"extraction": schema("extraction"), **_KINDS}.items() if n not in ("tier", "trigger")}
        return documents.withColumns(absent).withColumn("error", F.when(X.readable(), "offline: not in cache"))
    asked = X.model_requests(documents.withColumn("text", F.col("doc_text")), model.prompt, model.model)
    got = X.answered(asked, responses, model.prompt).drop("text", "truncated", "key")
    sound = X.readable() & F.col("error").isNull()
    got = got.withColumns({n: F.when(sound, F.col(n)) for n in ("extraction", "cost_usd", "input_tokens", "output_tokens")})
    return got.withColumn("latency_s", F.lit(None).cast("double")).withColumn("error", F.when(X.readable(), F.col("error")))


def _routed(documents: DataFrame, name: str, route: Tiers, responses: DataFrame | None, cache: DataFrame | None) -> DataFrame:
    """The cheap tier, from the cache where it has it, and the strong one for documents that fire a trigger.

    The cheap results are written once; only escalated documents are asked again.
    """
    cheap = dealt(results(documents, route.cheap, responses, cache).drop("cached", "tier", "trigger"), "doc_id")
    checked = cheap.withColumn("levels", X.supported())
    # A column of its own: it is a long expression, read once for each trigger.
    checked = checked.withColumn("flags", V.validation(F.col("extraction"), F.col("doc_text"), F.col("levels"), False)["flags"])
    said = F.col("extraction.provenance")["has_facts"] == "true"
    reason = F.when(X.readable(), Route.trigger(F.col("extraction"), F.col("flags"), said, route.triggers))
    first = written(checked.withColumn("trigger", reason).drop("levels", "flags"))
    again = first.where("trigger is not null").select(*documents.columns)
    second = _answered(again, route.strong, responses).select("doc_id", F.struct(*_TIER).alias("strong"))
    joined = first.select(*documents.columns, "trigger", F.struct(*_TIER).alias("cheap")).join(second, "doc_id", "left")

    def tier(side: str) -> Column:
        got = F.col(side)
        told = F.struct(
            got["extraction"]["facts_span"].alias("span"),
            got["extraction"]["notes"].alias("notes"),
            got["cost_usd"].alias("cost_usd"),
            got["latency_s"].alias("latency_s"),
            F.coalesce(got["error"], F.when(got["extraction"].isNull(), "no result")).alias("error"),
        )
        return F.when(got.isNotNull(), told)

    done = joined.withColumn("r", Route.routed(F.col("trigger"), tier("cheap"), tier("strong")))
    best = F.when(F.col("r.tier") == "strong", F.col("strong.extraction")).otherwise(F.col("cheap.extraction"))
    # Both tiers' tokens count where the strong result is used, as cost and time do.
    tokens = lambda n: F.when(F.col("r.tier") == "strong", F.coalesce(f"strong.{n}", F.lit(0)) + F.coalesce(f"cheap.{n}", F.lit(0))).otherwise(F.col(f"cheap.{n}"))
    return done.select(
        *documents.columns,
        F.when(best.isNotNull(), best.withField("extractor_version", F.lit(name)).withField("notes", F.col("r.notes"))).alias("extraction"),
        F.when(X.readable(), F.col("r.error")).alias("error"),
        "r.cost_usd",
        "r.latency_s",
        tokens("input_tokens").alias("input_tokens"),
        tokens("output_tokens").alias("output_tokens"),
        "r.tier",
        "trigger",
    )
