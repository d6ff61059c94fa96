"""Running extractors over documents: a registry, cached and replayed results, and the whole chain.

Remote models are injected callables; the engine itself calls no service.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.functions import citations as Cites
from casequarry.functions import guard as G
from casequarry.functions import metrics as M
from casequarry.functions import ocr as O
from casequarry.functions import spans as S
from casequarry.functions import text as T
from casequarry.functions import validators as V
from casequarry.schemas import ddl
from casequarry.tables import dealt

#: Extractors by name: (document text, document type) -> struct of the ``extraction`` schema.
EXTRACTORS: dict[str, Callable[[Column, Column], Column]] = {}


def register(name: str, make: Callable[[Column, Column], Column]) -> None:
    EXTRACTORS[name] = make


def rules(text: Column, doc_type: Column) -> Column:
    """The rules' facts span as an ``extraction`` struct; case citations are those of the span, first of each."""
    found = S.facts_span(text, doc_type)
    span = F.when(found["start"].isNotNull(), F.struct(found["start"].alias("start"), found["end"].alias("end"), found["text"].alias("text")))
    cites = Cites.extract(F.coalesce(found["text"], F.lit("")))
    printed = F.array_distinct(F.transform(Cites.of_kind(cites, "case"), lambda c: c["original_text"]))
    none = F.array().cast("array<string>")
    return F.struct(
        F.lit("1.1").alias("schema_version"),
        F.lit(S.RULES_VERSION).alias("extractor_version"),
        found["confidence"].alias("confidence"),
        span.alias("facts_span"),
        none.alias("parties"),
        F.lit(None).cast("string").alias("procedural_posture"),
        F.array().cast("array<struct<date:string,text:string>>").alias("key_events"),
        none.alias("record_citations"),
        printed.alias("case_citations"),
        found["notes"].alias("notes"),
        doc_type.alias("doc_type_id"),
        F.create_map().cast("map<string,string>").alias("provenance"),
    )


register(S.RULES_VERSION, rules)


def from_wire(text: Column, reply: Column, version: str, doc_type: Column, wire: str = "1") -> Column:
    """An extraction from a model's JSON reply: anchors are located in the text; malformed replies give null."""
    parsed = wired(reply, wire)
    return placed(text, parsed, V.located(text, parsed["facts_start_anchor"], parsed["facts_end_anchor"]), version, doc_type, wire)


def wired(reply: Column, wire: str = "1") -> Column:
    """A model's JSON reply as a struct."""
    return F.from_json(reply, ddl(f"wire_{wire}"), {"mode": "PERMISSIVE"})


def placed(text: Column, parsed: Column, place: Column, version: str, doc_type: Column, wire: str = "1") -> Column:
    """``from_wire`` of a reply's struct (``wired``) and its anchors' place (``located``); as columns of their own each is made once."""
    valid = parsed["has_facts"].isNotNull() & parsed["confidence"].isin("high", "medium", "low")
    facts = parsed["has_facts"] & place["start"].isNotNull()
    span = F.when(facts, F.struct(place["start"].alias("start"), place["end"].alias("end"), F.substring(text, place["start"] + 1, place["end"] - place["start"]).alias("text")))
    records = parsed["record_citations"] if wire == "1" else F.transform(parsed["record_citations"], lambda c: c["as_printed"])
    told = F.when(parsed["has_facts"], place["notes"]).otherwise(F.array(F.lit("llm_no_facts")))
    none = F.array().cast("array<string>")
    made = F.struct(
        F.lit("1.1").alias("schema_version"),
        F.lit(version).alias("extractor_version"),
        parsed["confidence"].alias("confidence"),
        span.alias("facts_span"),
        F.coalesce(parsed["parties"], none).alias("parties"),
        parsed["procedural_posture"].alias("procedural_posture"),
        parsed["key_events"].alias("key_events"),
        F.coalesce(records, none).alias("record_citations"),
        F.coalesce(parsed["case_citations"], none).alias("case_citations"),
        F.concat(F.coalesce(parsed["notes"], none), told).alias("notes"),
        doc_type.alias("doc_type_id"),
        F.create_map(F.lit("has_facts"), parsed["has_facts"].cast("string")).alias("provenance"),
    )
    return F.when(valid, made)


def request_key(model: Column, system: Column, user: Column) -> Column:
    """What a recorded reply is found by."""
    return F.substring(F.sha2(F.concat_ws("|", F.coalesce(model, F.lit("None")), F.coalesce(system, F.lit("")), F.coalesce(user, F.lit(""))), 256), 1, 16)


@dataclass(frozen=True)
class Prompt:
    """A version of the request: its texts, the form of its reply and the characters of a document that it shows."""

    version: str
    system: str
    user: str
    wire: str = "1"
    most_chars: int = 200_000

    def sha(self) -> Column:
        return F.substring(F.sha2(F.concat(F.lit(self.system), F.lit("\n"), F.lit(self.user)), 256), 1, 16)


_ASK = "Find the statement of facts of this court document. Give its first and last words as they are printed, the parties, the procedural posture, dated events and all citations as JSON."
#: Request versions by name; ``$type``, ``$chars`` and ``$document`` are filled in.
PROMPTS = {
    p.version: p
    for p in (
        Prompt("llm-1", _ASK, "Type: $type. Characters: $chars.\n\n$document"),
        Prompt("llm-2", f"{_ASK} Split record citations into their prefix and pages.", "Type: $type. Characters: $chars.\n\n$document", "2"),
    )
}


def model_requests(documents: DataFrame, prompt: Prompt, model: str) -> DataFrame:
    """Adds ``prompt``, ``truncated`` and ``key`` to documents (doc_id, text, doc_type_id)."""
    window = T.head_window(F.col("text"), prompt.most_chars)
    said = F.lit(prompt.user)
    for name, value in (("$type", F.coalesce("doc_type_id", F.lit("UNKNOWN"))), ("$chars", F.length("text").cast("string")), ("$document", window)):
        said = F.replace(said, F.lit(name), value)
    made = documents.withColumn("prompt", said).withColumn("truncated", F.length(window) < F.length("text"))
    return made.withColumn("key", request_key(F.lit(model), F.lit(prompt.system), F.col("prompt")))


def answered(requests: DataFrame, responses: DataFrame, prompt: Prompt, prices: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Requests with the extraction of their last response, its tokens, cost and error.

    ``responses`` have the ``response`` schema and ``line``.  A response cut off by its token limit, of another form
    than asked for, or missing is an error; the cost is the client's own or else the tokens' at ``prices``.
    """
    newest = responses.groupBy("key").agg(F.max_by(F.struct("text", "model", "stop_reason", "usage", "cli_cost_usd"), "line").alias("r"))
    joined = dealt(requests, "key").join(newest, "key", "left")
    joined = joined.withColumn("_said", wired(F.col("r.text"), prompt.wire))
    joined = joined.withColumn("_place", V.located(F.col("text"), F.col("_said.facts_start_anchor"), F.col("_said.facts_end_anchor")))
    made = placed(F.col("text"), F.col("_said"), F.col("_place"), prompt.version, F.coalesce("doc_type_id", F.lit("UNKNOWN")), prompt.wire)
    priced = M.cost_usd(F.col("r.model"), F.col("r.usage"), prices) if prices else F.lit(None).cast("double")
    error = (
        F.when(F.col("r").isNull(), F.concat(F.lit("no recorded response for key="), F.col("key")))
        .when(F.col("r.stop_reason") == "max_tokens", "stopped at max_tokens")
        .when(F.col("extraction").isNull(), "schema: the reply is not of the form asked for")
    )
    read = joined.withColumn("extraction", F.when(F.coalesce(F.col("r.stop_reason") != "max_tokens", F.lit(True)), made)).withColumn("error", error)
    return read.withColumns(
        {
            "input_tokens": F.col("r.usage.input_tokens") + F.coalesce("r.usage.cache_creation_input_tokens", F.lit(0)) + F.coalesce("r.usage.cache_read_input_tokens", F.lit(0)),
            "output_tokens": F.col("r.usage.output_tokens"),
            "cost_usd": F.coalesce("r.cli_cost_usd", priced),
        }
    ).drop("r", "prompt", "_said", "_place")


def replay(requests: DataFrame, recorded: DataFrame) -> DataFrame:
    """Requests (with ``key``) and their recorded replies, the last of each key by ``line``; a miss has an ``error``."""
    newest = recorded.groupBy("key").agg(F.max_by("text", "line").alias("reply"))
    missed = F.when(F.col("reply").isNull(), F.concat(F.lit("no recorded response for key="), F.col("key")))
    return requests.join(newest, "key", "left").withColumn("error", missed)


def record(recorded: DataFrame, fresh: DataFrame) -> DataFrame:
    """Recordings with new ones added; a known key keeps its recording."""
    return recorded.unionByName(fresh.join(recorded.select("key"), "key", "left_anti").select(*recorded.columns)).orderBy("key")


def call_model(requests: DataFrame, model: Callable[[str], str], attempts: int = 2) -> DataFrame:
    """Replies of an injected callable to requests (key, prompt): adds reply, latency_s and error; failures become rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            replies, times, errors = [], [], []
            for prompt in batch.column("prompt").to_pylist():
                began, reply, error = time.perf_counter(), None, None
                for _ in range(attempts):
                    try:
                        reply, error = model(prompt), None
                        break
                    except Exception as e:  # noqa: BLE001  a failed call is a result
                        error = f"{type(e).__name__}: {e}"
                replies.append(reply)
                times.append(time.perf_counter() - began)
                errors.append(error)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("prompt"), pa.array(replies, pa.string()), pa.array(times, pa.float64()), pa.array(errors, pa.string())],
                names=["key", "prompt", "reply", "latency_s", "error"],
            )

    return requests.select("key", "prompt").mapInArrow(run, "key string, prompt string, reply string, latency_s double, error string")


def cached(documents: DataFrame, cache: DataFrame, config_sha: str) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_sha1) with cached results of one configuration, and those to run."""
    own = cache.where(F.col("config_sha") == config_sha).drop("config_sha").dropDuplicates(["doc_sha1"])
    return documents.join(own, "doc_sha1"), documents.join(own.select("doc_sha1"), "doc_sha1", "left_anti")


#: What a run knows of a result besides its extraction; kept where it is there.
CARRIED = ("doc_sha1", "cost_usd", "latency_s", "input_tokens", "output_tokens", "tier", "trigger", "cached")


def prepared(documents: DataFrame, page_count: str | None = None) -> DataFrame:
    """Adds clean, ocr_reasons and doc_text (what extractors read and spans count in) to documents with a text."""
    clean = documents.withColumn("clean", T.normalize(F.coalesce("text", F.lit(""))))
    reasons = O.document_reasons(F.col("clean"), F.col(page_count) if page_count else None)
    return clean.withColumn("ocr_reasons", reasons).withColumn("doc_text", T.preprocess(F.col("clean")))


def readable() -> Column:
    return (F.col("clean") != "") & (F.size("ocr_reasons") == 0)


def extract_documents(documents: DataFrame, method: str = S.RULES_VERSION, require_facts: bool = True, guard: bool = True, page_count: str | None = None) -> DataFrame:
    """The chain over (doc_id, text, doc_type_id): normalise, OCR decision, preprocess, extract, validate, guard.

    Documents without text or in need of OCR have an ``error`` and no extraction.
    """
    clean = prepared(documents, page_count)
    made = clean.withColumn("extraction", EXTRACTORS[method](F.col("doc_text"), F.coalesce("doc_type_id", F.lit("UNKNOWN"))))
    return checked_extractions(made, require_facts, guard)


def citations(extraction: str = "extraction") -> Column:
    """Case and then record citations of an extraction."""
    none = F.array().cast("array<string>")
    return F.concat(F.coalesce(f"{extraction}.case_citations", none), F.coalesce(f"{extraction}.record_citations", none))


def supported() -> Column:
    """``support_levels`` of a document's citations; a text without any is not looked at."""
    return V.support_levels(citations(), F.when(F.size(citations()) > 0, F.col("doc_text")))


def checked_extractions(made: DataFrame, require_facts: bool = True, guard: bool = True) -> DataFrame:
    """Validation and guard of extractions (doc_id, clean, ocr_reasons, doc_text, extraction); ``error`` and ``suspected``, if there, are taken."""
    checked = made.withColumn("levels", supported()).withColumn("report", V.validation(F.col("extraction"), F.col("doc_text"), F.col("levels"), require_facts))
    if guard:
        fields = {
            "parties": F.col("extraction.parties"),
            "procedural_posture": F.array("extraction.procedural_posture"),
            "key_events": F.flatten(F.transform("extraction.key_events", lambda e: F.array(e["text"], e["date"]))),
            "notes": F.col("extraction.notes"),
            "record_citations": F.col("extraction.record_citations"),
            "case_citations": F.col("extraction.case_citations"),
        }
        found = {} if "suspected" in made.columns else {"suspected": G.suspected(F.col("doc_text"))}
        checked = checked.withColumns(found | {"hits": G.output_hits(fields)})
        checked = checked.withColumn("guarded", G.guarded(F.col("report.ok"), F.col("report.flags"), F.col("suspected"), F.col("hits")))
        ok, flags = F.col("guarded.ok"), F.col("guarded.flags")
    else:
        ok, flags = F.col("report.ok"), F.col("report.flags")
    before = F.col("error") if "error" in made.columns else F.lit(None).cast("string")
    error = F.coalesce(before, F.when(F.col("clean") == "", "no_text").when(F.size("ocr_reasons") > 0, "needs_ocr"))
    kept = error.isNull()
    return checked.select(
        "doc_id",
        error.alias("error"),
        "ocr_reasons",
        F.when(kept, F.col("extraction")).alias("extraction"),
        F.when(kept, ok).alias("validation_ok"),
        F.when(kept, flags).alias("flags"),
        F.when(kept, F.col("report.citation_fidelity")).alias("citation_fidelity"),
        F.when(kept, F.col("report.citation_support")).alias("citation_support"),
        F.when(kept, F.col("report.n_nonverbatim_citations")).alias("n_nonverbatim_citations"),
        F.when(kept, F.col("doc_text")).alias("doc_text"),
        *(c for c in CARRIED if c in made.columns),
    )
