"""A model that judges two candidate spans of a document: requests, parsed verdicts, cached runs.

The model is an injected callable or a table of recorded replies; nothing here calls a service.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.functions import text as T
from casequarry.functions import validators as V
from casequarry.operators.extraction import call_model, replay, request_key
from casequarry.schemas import ddl

SYSTEM = "You compare two proposed spans of the facts section of one court document and answer in the given JSON form."
#: Places of the request's values are named; the document carries the marks of both spans.
PROMPT = (
    "Document type: {doc_type_id}. Characters: {n_chars}{cut}.\n"
    "Candidate A ({name_a}): {span_a}. Candidate B ({name_b}): {span_b}.\n"
    "Rate each candidate, say which is better, and give anchors of a corrected span if neither is right.\n\n{document}"
)


@dataclass(frozen=True)
class Judge:
    """What makes a verdict: a change of any of these makes cached verdicts stale."""

    model: str = "judge"
    version: str = "judge-1"
    most_chars: int = 200_000
    system: str = SYSTEM
    prompt: str = PROMPT

    def prompt_sha(self) -> Column:
        return F.substring(F.sha2(F.concat(F.lit(self.system), F.lit("\n"), F.lit(self.prompt)), 256), 1, 16)

    def config_sha(self) -> Column:
        return F.substring(F.sha2(F.concat_ws("|", F.lit(self.model), F.lit(self.version), F.lit(str(self.most_chars)), self.prompt_sha()), 256), 1, 16)


def _told(span: Column) -> Column:
    """A span in words."""
    size = span[1] - span[0]
    return F.when(span.isNull(), "no span").otherwise(F.concat(F.lit("characters "), span[0], F.lit(" to "), span[1], F.lit(", "), size, F.lit(" long")))


def requests(rows: DataFrame, judge: Judge, names: tuple[str, str]) -> DataFrame:
    """Adds ``prompt``, ``truncated``, ``key`` (of the request) and ``cache_key`` to rows.

    ``rows`` has gold_id, doc_type_id, text, span_a and span_b (arrays of start and end, or
    null).  A span that ends past the window shown is not marked in it.
    """
    window = T.head_window(F.col("text"), judge.most_chars)

    def seen(side: str) -> tuple[Column, Column]:
        span = F.col(f"span_{side}")
        inside = span[1] <= F.length("window")
        return F.when(inside, span[0]), F.when(inside, span[1])

    shown = rows.withColumn("window", window).withColumn("truncated", F.length("window") < F.length("text"))
    values = {
        "doc_type_id": F.coalesce("doc_type_id", F.lit("UNKNOWN")),
        "n_chars": F.length("text"),
        "cut": F.when(F.col("truncated"), ", cut off below").otherwise(""),
        "name_a": F.lit(names[0]),
        "name_b": F.lit(names[1]),
        "span_a": _told(F.col("span_a")),
        "span_b": _told(F.col("span_b")),
        "document": V.marked(F.col("window"), {"A": seen("a"), "B": seen("b")}),
    }
    pieces = [F.lit("")]
    rest = judge.prompt
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [F.lit(before), values[name].cast("string")]
    prompt = F.concat(*pieces, F.lit(rest))
    sha1 = F.substring(F.sha1(F.col("text")), 1, 16)
    cache_key = F.concat_ws(":", judge.config_sha(), sha1, F.lit(names[0]), F.lit(names[1]))
    made = shown.withColumn("prompt", prompt).withColumn("cache_key", cache_key)
    return made.withColumn("key", request_key(F.lit(judge.model), F.lit(judge.system), F.col("prompt"))).drop("window")


def verdicts(answered: DataFrame, judge: Judge, names: tuple[str, str]) -> DataFrame:
    """Rows of the ``verdict`` schema and ``cache_key`` from answered requests (with reply and error).

    A reply without the required fields is an error; corrected anchors are located in the text.
    """
    parsed = F.from_json("reply", ddl("judge_wire"), {"mode": "PERMISSIVE"})
    rows = answered.withColumn("w", parsed)
    required = F.array(
        F.col("w.document_kind"), F.col("w.is_brief_with_facts").cast("string"), F.col("w.candidate_a.rating"), F.col("w.candidate_b.rating"), F.col("w.preferred"), F.col("w.confidence")
    )
    broken = F.exists(required, lambda x: x.isNull()) | ~F.coalesce(F.col("w.preferred").isin("A", "B", "tie", "neither"), F.lit(False))
    error = F.coalesce(F.col("error"), F.when(broken, "schema: the reply lacks a required field"))
    first, last = F.coalesce("w.corrected_start_anchor", F.lit("")), F.coalesce("w.corrected_end_anchor", F.lit(""))
    corrected = (first != "") | (last != "")
    rows = rows.withColumn("error", error).withColumn("place", F.when(corrected & error.isNull(), V.located("text", first, last)))
    ok = F.col("error").isNull()
    none = F.array().cast("array<string>")

    def said(path: str, kind: str = "string") -> Column:
        return F.when(ok, F.col(f"w.{path}")).cast(kind)

    optional = lambda name, kind: F.col(name).cast(kind) if name in answered.columns else F.lit(None).cast(kind)
    return rows.select(
        "cache_key",
        "gold_id",
        optional("search_result_id", "bigint").alias("search_result_id"),
        optional("source", "string").alias("source"),
        F.lit(names[0]).alias("method_a"),
        F.lit(names[1]).alias("method_b"),
        "span_a",
        "span_b",
        said("document_kind").alias("document_kind"),
        said("is_brief_with_facts", "boolean").alias("is_brief_with_facts"),
        said("candidate_a.rating").alias("rating_a"),
        F.coalesce(said("candidate_a.issues", "array<string>"), none).alias("issues_a"),
        said("candidate_a.comment").alias("comment_a"),
        said("candidate_b.rating").alias("rating_b"),
        F.coalesce(said("candidate_b.issues", "array<string>"), none).alias("issues_b"),
        said("candidate_b.comment").alias("comment_b"),
        said("preferred").alias("preferred"),
        F.when(F.col("place.start").isNotNull(), F.array("place.start", "place.end")).alias("corrected_span"),
        F.coalesce("place.notes", none).alias("corrected_notes"),
        said("confidence").alias("confidence"),
        said("summary").alias("summary"),
        F.lit(judge.model).alias("judge_model"),
        F.lit(judge.version).alias("judge_version"),
        judge.prompt_sha().alias("prompt_sha"),
        optional("cost_usd", "double").alias("cost_usd"),
        optional("latency_s", "double").alias("latency_s"),
        F.lit(False).alias("cached"),
        "error",
    )


def run(
    rows: DataFrame, judge: Judge, names: tuple[str, str], answer: DataFrame | Callable[[str], str], cache: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Verdicts of all rows, and those to add to the cache: fresh ones without an error.

    ``answer`` is a table of recorded replies (key, text, line) or a callable; ``cache`` has
    verdicts with their ``cache_key``.  Verdicts of another configuration, text or pair of
    methods are not taken from it.
    """
    asked = requests(rows, judge, names)
    known = None
    if cache is not None:
        newest = cache.dropDuplicates(["cache_key"]).withColumn("cached", F.lit(True)).drop("gold_id", "span_a", "span_b")
        known = asked.select("cache_key", "gold_id", "span_a", "span_b").join(newest, "cache_key")
        asked = asked.join(cache.select("cache_key").distinct(), "cache_key", "left_anti")
    if isinstance(answer, DataFrame):
        answered = replay(asked, answer)
    else:
        replies = call_model(asked.select("key", "prompt"), answer, attempts=1).drop("prompt").dropDuplicates(["key"])
        answered = asked.join(replies, "key")
    fresh = verdicts(answered, judge, names)
    every = fresh if known is None else fresh.unionByName(known.select(*fresh.columns))
    return every, fresh.where("error is null")
