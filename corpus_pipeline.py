"""The corpus pipeline: quality, line dedup, near-dedup, decontamination and mixing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the
columns of ``documents``; the last adds ``copy``, the number of a document's repetition.
Null and repeated rows are treated as the stages' operators define; a stage that drops
documents by id drops all rows of that id.  Texts are joined with what was decided about
them by sort-merge at every size: the decisions grow with the documents, so the driver never
holds them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry.llm import common as C
from casequarry.llm import decontaminate, linededup, mixing, quality, simhash
from casequarry.operators.running import running

#: A document stays if its probability of good quality is at least this.
LEAST_QUALITY = 0.3


def _packed(docs: DataFrame) -> DataFrame:
    """Documents as (key, row): no column name can clash with those of a join."""
    return docs.select(F.col("doc_id").alias("key"), F.struct("*").alias("row"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from all labels."""
    model = quality.fit(docs, C.tables(spark, sf_dir, "labels"))
    score = quality.scorer(model)
    return docs.where(score("text") >= LEAST_QUALITY)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; n_chars follows the text."""
    kept = linededup.drop_common_lines(docs, carry=tuple(docs.columns))
    changed = F.col("n_dropped") > 0
    row = F.col("carried")
    values = {c: row[c] for c in docs.columns} | {"text": F.when(changed, F.col("kept")).otherwise(row["text"])}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.when(changed, F.length("kept").cast(kind)).otherwise(row["n_chars"])
    return kept.select(*(values[c].alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, that of its least id; rows of groups without any id all stay."""
    grouped = C.written(simhash.grouped(docs))
    first = grouped.where("doc_id is not null").groupBy("component").agg(F.min(F.struct("doc_id", "fp")).alias("r")).select("r.*")
    nameless = grouped.where("component_id is null").select("doc_id", "fp").distinct()
    keep = C.written(first.unionByName(nameless).select(F.col("doc_id").alias("k"), F.col("fp").alias("f")))
    repeated = C.written(grouped.where("doc_id is not null").groupBy(F.col("doc_id").alias("k")).agg(F.count("*").alias("n")).where("n > 1").select("k"))
    packed, once = _packed(docs), keep.where("k is not null")
    named = packed.where("key is not null")
    many = not repeated.isEmpty()
    if many:
        once = once.join(repeated, "k", "left_anti")
    stay = named.join(once.hint("merge"), F.col("key") == F.col("k"), "left_semi").select("row")
    if many:
        # Rows of one id are told apart by their fingerprints; of equal ones that of the least text stays.
        marked = named.join(repeated, F.col("key") == F.col("k"), "left_semi").withColumn("mark", simhash.fingerprints(F.col("row.text")))
        held = marked.join(keep, (F.col("key") == F.col("k")) & (F.col("mark") == F.col("f")), "left_semi")
        stay = stay.unionByName(held.groupBy("key", "mark").agg(F.min_by("row", F.struct("row.text")).alias("row")).select("row"))
    free = keep.where("k is null").select("f")
    if not free.isEmpty():
        nulls = packed.where("key is null").withColumn("mark", simhash.fingerprints(F.col("row.text")))
        stay = stay.unionByName(nulls.join(free, F.col("mark") == F.col("f"), "left_semi").select("row"))
    return stay.select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontaminate.contamination(docs, C.tables(spark, sf_dir, "benchmark"))
    gone = found.where("n_hit > 0").select(F.col("doc_id").alias("k")).distinct()
    return _packed(docs).join(gone.hint("merge"), F.col("key").eqNullSafe(F.col("k")), "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, numbered from 1 in ``copy``."""
    taken = C.written(mixing.mix(docs).select(F.col("doc_id").alias("k"), F.col("size").alias("words"), "copies"))
    packed = _packed(docs)
    repeated = C.written(taken.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select(F.col("k").alias("again")))
    same, again = F.col("key").eqNullSafe(F.col("k")), lambda c: F.col(c).eqNullSafe(F.col("again"))
    mixed = None
    if not repeated.isEmpty():
        # Rows of one id, null ids among them, are matched by their place in the order of id and size, which both tables share.
        salt = F.monotonically_increasing_id()
        ours = taken.join(repeated, again("k"), "left_semi").withColumn("s", salt)
        theirs = packed.join(repeated, again("key"), "left_semi").withColumn("w", mixing.word_count("row.text")).withColumn("s2", salt)
        ours, theirs = running(ours, ["k", "words", "s"], name="nth"), running(theirs, ["key", "w", "s2"], name="m")
        mixed = theirs.join(ours, F.col("m") == F.col("nth")).select("row", "copies")
        taken, packed = taken.join(repeated, again("k"), "left_anti"), packed.join(repeated, again("key"), "left_anti")
    plain = packed.join(taken.where("copies > 0").hint("merge"), same).select("row", "copies")
    mixed = plain if mixed is None else plain.unionByName(mixed.where("copies > 0"))
    name = "copy"
    while name in docs.columns:
        name += "_"
    return mixed.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("number")).select("row.*", F.col("number").alias(name))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
]

#: The classifier and the fingerprints have no SQL form; tests hold the stages against their operators and plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = C.tables(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = C.written(stage(spark, docs, sf_dir))
        if before is not None:
            C.remove(before)  # the next stage's table is whole
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
