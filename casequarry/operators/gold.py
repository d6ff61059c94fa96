"""The gold set: building it, labels, suggestions of a judge, checks and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casequarry.operators.dataset import text_sha1

POLICIES = ("nonbrief", "rules_correct", "llm_correct", "corrected")
CONFIDENCE = ("low", "medium", "high")
RULES = "rules_v2"


def human(labeler: Column | None = None) -> Column:
    who = F.col("label.labeler") if labeler is None else labeler
    return (F.col("status") == "labeled") & ~F.coalesce(who, F.lit("")).startswith("judge:")


def failure_sample(failures: DataFrame, seen: DataFrame, n: int = 20, seed: int = 42) -> DataFrame:
    """n failures without a facts span whose document is not in ``seen``, drawn by a hash of their id."""
    fit = failures.where((F.col("reason") == "no_facts_span") & F.col("search_id").isNotNull())
    new = fit.join(seen.select(F.col("search_result_id").alias("search_id")), "search_id", "left_anti")
    return new.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("search_id").cast("string"))), "search_id").limit(n)


def build(audit: DataFrame, failures: DataFrame, n_failures: int = 20, seed: int = 42) -> DataFrame:
    """Seed records: each audited row and a sample of failures, with ids g001.. and f001.. ."""
    number = F.row_number().over(W.orderBy("search_result_id"))  # a gold set is labelled by hand and small
    first = audit.select(
        F.concat(F.lit("g"), F.lpad(number.cast("string"), 3, "0")).alias("gold_id"),
        "search_result_id",
        F.lit("audit_set").alias("source"),
        F.array("facts_start", "facts_end").alias("rules_span"),
        F.col("extractor_confidence").alias("confidence"),
    )
    drawn = failure_sample(failures, audit, n_failures, seed)
    place = F.row_number().over(W.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("search_id").cast("string"))), "search_id"))
    second = drawn.select(
        F.concat(F.lit("f"), F.lpad(place.cast("string"), 3, "0")).alias("gold_id"),
        F.col("search_id").alias("search_result_id"),
        F.lit("no_facts_span").alias("source"),
        F.lit(None).cast("array<bigint>").alias("rules_span"),
        F.lit("none").alias("confidence"),
    )
    return first.withColumn("rules_span", F.col("rules_span").cast("array<bigint>")).unionByName(second)


def verify(gold: DataFrame, texts: DataFrame) -> DataFrame:
    """(gold_id, problems) of records whose text changed or whose spans do not fit; texts are (gold_id, text)."""
    joined = gold.join(texts, "gold_id", "left")
    sha = text_sha1(F.col("text"))
    size = F.length("text")

    def outside(name: str, span: Column) -> Column:
        start, end = F.get(span, F.lit(0)), F.get(span, F.lit(1))
        return F.when(span.isNotNull() & ~((start >= 0) & (start < end) & (end <= size)), F.lit(f"{name} out of bounds"))

    problems = F.array_compact(
        F.array(
            F.when(F.col("text").isNull(), F.lit("no text")),
            F.when(F.col("doc_sha1").isNotNull() & (F.col("doc_sha1") != sha), F.lit("doc_sha1 changed")),
            outside("rules_span", F.col("rules_span")),
            outside("gold_span", F.col("label.gold_span")),
        )
    )
    return joined.select("gold_id", problems.alias("problems")).where(F.size("problems") > 0)


def suggestions(verdicts: DataFrame, run: str) -> DataFrame:
    """(gold_id, suggestion) from verdicts without error, the last of each gold_id by ``line`` if there is one.

    The suggested span is the judge's corrected one, else the rules' if rated correct,
    else the first other candidate rated correct.
    """
    is_rules_a, is_rules_b = F.col("method_a") == RULES, F.col("method_b") == RULES
    rules_rating = F.when(is_rules_a, F.col("rating_a")).when(is_rules_b, F.col("rating_b"))
    rules_span = F.when(is_rules_a, F.col("span_a")).when(is_rules_b, F.col("span_b"))
    facts = F.coalesce(F.col("is_brief_with_facts"), F.lit(False))

    def llm(side: str) -> Column:
        return F.col(f"method_{side}").startswith("llm") & (F.col(f"rating_{side}") == "correct") & F.col(f"span_{side}").isNotNull()

    by_rules = F.coalesce((rules_rating == "correct") & rules_span.isNotNull(), F.lit(False))
    corrected = F.col("corrected_span").isNotNull()
    span = F.when(facts & corrected, F.col("corrected_span")).when(facts & by_rules, rules_span)
    span = span.when(facts & llm("a"), F.col("span_a")).when(facts & llm("b"), F.col("span_b"))
    basis = F.when(facts & corrected, "judge_corrected").when(facts & by_rules, "rules_span")
    basis = basis.when(facts & llm("a"), F.concat("method_a", F.lit("_span"))).when(facts & llm("b"), F.concat("method_b", F.lit("_span"))).otherwise("none")
    suggestion = F.struct(
        "judge_model",
        "judge_version",
        F.lit(run).alias("judge_run"),
        "document_kind",
        facts.alias("has_facts"),
        "confidence",
        F.coalesce("summary", F.lit("")).alias("summary"),
        rules_rating.alias("rules_rating"),
        span.alias("suggested_span"),
        basis.alias("span_basis"),
    )
    last = verdicts
    if "line" in verdicts.columns:
        last = verdicts.withColumn("_n", F.row_number().over(W.partitionBy("gold_id").orderBy(F.desc("line")))).where("_n = 1").drop("_n")
    return last.where(F.coalesce(F.col("error"), F.lit("")) == "").select("gold_id", suggestion.alias("new_suggestion"))


def prefill(gold: DataFrame, found: DataFrame, overwrite: bool = False) -> DataFrame:
    """Gold records with suggestions attached where there is none yet, or everywhere; labels stay."""
    joined = gold.join(found, "gold_id", "left")
    new = F.col("new_suggestion").cast(gold.schema["suggestion"].dataType)
    chosen = F.coalesce(new, F.col("suggestion")) if overwrite else F.coalesce(F.col("suggestion"), new)
    return joined.withColumn("suggestion", chosen).select(*gold.columns)


def accept_policy(policies: tuple[str, ...] = POLICIES, least: str = "high") -> Column:
    """The policy by which a pending record's suggestion becomes its label, or null."""
    s = F.col("suggestion")
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, CONFIDENCE)), F.coalesce(s["confidence"], F.lit("low"))), F.lit(0))
    sure = (F.col("status") == "pending") & s.isNotNull() & (F.greatest(rank, F.lit(1)) >= CONFIDENCE.index(least) + 1)
    basis = F.coalesce(s["span_basis"], F.lit(""))
    spanned = s["has_facts"] & s["suggested_span"].isNotNull()
    cases = {
        "nonbrief": s["has_facts"] == F.lit(False),
        "rules_correct": spanned & (basis == "rules_span"),
        "llm_correct": spanned & basis.endswith("_span") & basis.startswith("llm"),
        "corrected": spanned & (basis == "judge_corrected"),
    }
    return F.coalesce(*(F.when(sure & test, F.lit(name)) for name, test in cases.items() if name in policies), F.lit(None).cast("string"))


def accept(gold: DataFrame, policies: tuple[str, ...] = POLICIES, least: str = "high", at: str | None = None) -> DataFrame:
    """Gold records with accepted suggestions as labels of ``judge:<model>``; other records stay as they are."""
    s, policy = F.col("suggestion"), F.col("_policy")
    nonbrief = policy == "nonbrief"
    rating = F.when(nonbrief, F.when((F.col("source") == "audit_set") & F.col("rules_span").isNotNull(), "incorrect")).when(F.col("rules_span").isNotNull(), s["rules_rating"])
    said = F.concat(F.lit("[judge:"), policy, F.lit("] "), F.when(nonbrief, F.concat(F.coalesce(s["document_kind"], F.lit("None")), F.lit(": "))).otherwise(""), s["summary"])
    label = F.struct(
        rating.alias("rating"),
        (~nonbrief).alias("has_facts"),
        F.when(~nonbrief, s["suggested_span"]).alias("gold_span"),
        said.alias("notes"),
        F.coalesce(F.lit(at), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")).alias("labeled_at"),
        F.concat(F.lit("judge:"), F.coalesce(s["judge_model"], F.lit("None"))).alias("labeler"),
    ).cast(gold.schema["label"].dataType)
    decided = gold.withColumn("_policy", accept_policy(policies, least))
    return decided.withColumn("label", F.when(policy.isNotNull(), label).otherwise(F.col("label"))).withColumn("status", F.when(policy.isNotNull(), "labeled").otherwise(F.col("status"))).drop("_policy")


def set_label(gold: DataFrame, labels: DataFrame) -> DataFrame:
    """Gold records with labels (gold_id, rating, has_facts, gold_span, notes, labeler, labeled_at) set; others stay as they are.

    A span without facts, or one that ends before it starts or past the document, is refused with an
    error; so is an unknown id.
    """
    given = labels.select("gold_id", F.struct("rating", "has_facts", "gold_span", "notes", "labeled_at", "labeler").alias("_given"))
    joined = gold.join(given, "gold_id", "full")
    span = F.col("_given.gold_span")
    outside = (F.get(span, F.lit(0)) < 0) | (F.get(span, F.lit(1)) <= F.get(span, F.lit(0))) | (F.get(span, F.lit(1)) > F.col("doc_chars"))
    bad = F.when(F.col("status").isNull(), "unknown gold_id").when((F.col("_given.has_facts") == F.lit(False)) & span.isNotNull(), "span without facts").when(outside, "span out of bounds")
    checked = F.when(F.col("_given").isNotNull() & bad.isNotNull(), F.raise_error(F.concat(bad, F.lit(": "), "gold_id")).cast("string"))
    new = F.col("_given").cast(gold.schema["label"].dataType)
    status = F.coalesce(checked, F.when(new.isNotNull(), "labeled").otherwise(F.col("status")))
    return joined.withColumn("status", status).withColumn("label", F.coalesce(new, F.col("label"))).select(*gold.columns)


def stats(gold: DataFrame) -> DataFrame:
    """Counts in long form (measure, value, n): status, source and status, ratings, labellers, suggestions and corrections."""
    label = F.col("label")
    corrected = label["gold_span"].isNotNull() & ~label["gold_span"].eqNullSafe(F.col("rules_span"))
    unsure = F.coalesce(F.try_element_at("stratum", F.lit("confidence")).isin("low", "medium"), F.lit(False))

    def item(measure: str, value: Column, when: Column | None = None) -> Column:
        made = F.struct(F.lit(measure).alias("measure"), value.cast("string").alias("value"))
        return made if when is None else F.when(when, made)

    items = F.array_compact(
        F.array(
            item("total", F.lit("all")),
            item("status", F.col("status")),
            item("source/status", F.concat_ws("/", "source", "status")),
            item("rating", label["rating"], label["rating"].isNotNull()),
            item("labeler", F.when(human(), "human").otherwise("judge"), F.col("status") == "labeled"),
            item("with_suggestion", F.lit("all"), F.col("suggestion").isNotNull()),
            item("with_gold_span", F.lit("all"), label["gold_span"].isNotNull()),
            item("boundary_corrected", F.lit("all"), corrected),
            item("boundary_corrected_low_medium", F.lit("all"), corrected & unsure),
        )
    )
    return gold.select(F.explode(items).alias("i")).groupBy("i.measure", "i.value").agg(F.count("*").alias("n"))


def verdict_summary(verdicts: DataFrame) -> DataFrame:
    """Counts in long form (measure, source, value, n) over verdicts without error, and errors themselves."""
    ok = F.coalesce(F.col("error"), F.lit("")) == ""

    def items(measure: str, values: Column, source: Column | None = None) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(measure).alias("measure"), (F.lit("all") if source is None else source).alias("source"), v.cast("string").alias("value")))

    def one(measure: str, value: Column, source: Column | None = None) -> Column:
        return items(measure, F.array_compact(F.array(value)), source)

    src = F.col("source")
    none = F.array().cast("array<string>")
    glaring = (F.col("rating_a") == "incorrect") | ((F.col("is_brief_with_facts") == F.lit(False)) & F.col("span_a").isNotNull())
    counted = F.concat(
        one("document_kind", F.col("document_kind")),
        one("is_brief_with_facts", F.col("is_brief_with_facts").cast("string")),
        one("rating_a", F.col("rating_a"), src),
        one("rating_b", F.col("rating_b"), src),
        items("issues_a", F.coalesce("issues_a", none)),
        items("issues_b", F.coalesce("issues_b", none)),
        one("preferred", F.col("preferred")),
        one("confidence", F.col("confidence")),
        one("corrected_spans", F.when(F.col("corrected_span").isNotNull(), F.lit("all"))),
        one("glaring", F.when(glaring, F.lit("all"))),
    )
    rows = verdicts.select(F.explode(F.when(ok, F.concat(counted, one("ok", F.lit("all")))).otherwise(one("error", F.lit("all")))).alias("i"))
    return rows.groupBy("i.measure", "i.source", "i.value").agg(F.count("*").alias("n"))
