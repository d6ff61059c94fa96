"""Toxicity by a counterfactual-regularised classifier.

A logistic model over the presence of words and word beginnings.  Identity terms in the
labelled texts are swapped for other terms of their group, and the change that a swap
makes to the score is penalised, so the mention of a group as such moves no score.

Beside the listed groups, groups are derived from the labelled sample: words of middling
frequency that toxic and other texts mention alike, and that follow the same word most
often, stand for each other.  So the penalty acts on texts of any vocabulary.

Fitting uses a bounded sample of labelled rows (``rows``).  Features are the ``terms``
most associated with toxic texts in it, and the terms of all groups, whose weights may
have either sign.  Every whole text is scored.

Defined results: a null or empty text gets the score of a text without any feature.
Without labels, or with labels of one kind only, every score is the labels' mean (0 if
there are none).  Repeated rows are scored apart.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

from casequarry.llm import common as C
from casequarry.llm.training import SAMPLE_ROWS, Adam, labelled_sample, sigmoid

TERMS, LEAST_DOCS = 256, 5
#: Derived terms at most, and the least share of the sample's texts that has such a term; the largest is a fifth.
DERIVED, LEAST_SHARE, MOST_SHARE = 64, 0.01, 0.2
#: G-squared up to which toxic and other texts have a term alike.
ALIKE = 1.0
#: Lengths in bytes of the word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6, 7, 8, 9, 10)
#: Interchangeable mentions of groups.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("transgender", "cisgender"),
    ("black", "white", "asian", "hispanic", "latino"),
    ("african", "european", "american", "arab"),
    ("immigrants", "natives"),
    ("disabled", "abled"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)


def swap(text: str, groups: tuple[tuple[str, ...], ...]) -> str:
    """``text`` with every identity term replaced by the next of its group."""
    following = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    return re.sub(r"\w+", lambda m: following.get(m[0].lower(), m[0]), text)


def _features(texts: C.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes and the text that each stands in."""
    low = C.lower_bytes(texts.data)
    starts, ends, counts = C.words(texts, C.ALNUM, low)
    sums = C.byte_sums(low)
    owner = np.repeat(np.arange(len(counts)), counts)
    hashes, owners = [C.span_hash(sums, starts, ends)], [owner]
    for n in BEGINNINGS:
        long = ends - starts > n
        hashes.append(C.span_hash(sums, starts[long], starts[long] + n) ^ np.uint64(0x5BD1))
        owners.append(owner[long])
    return np.concatenate(hashes), np.concatenate(owners)


def _sets(texts: list[str]) -> list[np.ndarray]:
    out = []
    for t in C.passes(pa.array(texts, pa.string())):
        hashes, owner = _features(t)
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(1, len(t)))
        out += [np.unique(part).view(np.int64) for part in np.split(hashes[order], cuts)]
    return out


def _training_features(groups: tuple[tuple[str, ...], ...]):
    kind = StructType().add("here", ArrayType(LongType())).add("swapped", ArrayType(LongType()))

    @F.arrow_udf(kind)
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            texts = [t or "" for t in column.to_pylist()]
            other = [swap(t, groups) for t in texts]
            swapped = [None if a == b else s for a, b, s in zip(texts, other, _sets(other), strict=True)]
            many = pa.list_(pa.int64())
            yield pa.StructArray.from_arrays([pa.array(_sets(texts), many), pa.array(swapped, many)], names=["here", "swapped"])

    return extract


@dataclass(frozen=True)
class Model:
    """``hashes`` in ascending order, a weight for each, and the bias; ``swapped`` rows of the sample moved features."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    groups: tuple[tuple[str, ...], ...] = ()
    swapped: int = 0

    def scores(self, column: pa.Array) -> np.ndarray:
        hint = np.zeros(1 << 16, bool)
        hint[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True
        out = []
        for texts in C.passes(column):
            hashes, owner = _features(texts)
            maybe = hint[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
            hashes, owner = hashes[maybe], owner[maybe]
            total = np.full(len(texts), self.bias)
            if len(self.hashes) and len(hashes):
                at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
                hit = self.hashes[at] == hashes
                pairs = np.unique(owner[hit] * len(self.hashes) + at[hit])
                total += np.bincount(pairs // len(self.hashes), self.weights[pairs % len(self.hashes)], len(texts))
            out.append(sigmoid(total))
        return np.concatenate(out) if out else np.zeros(0)


def _association(positive: int, negative: int) -> Column:
    """G-squared of a feature that ``p`` of the positive and ``n`` of the negative texts have."""
    total = float(positive + negative)

    def cell(seen: Column, row: Column, side: int) -> Column:
        return F.when(seen > 0, seen * F.ln(seen * total / (row * float(side)))).otherwise(0.0)

    has, lacks = F.col("p") + F.col("n"), total - F.col("p") - F.col("n")
    return 2 * (
        cell(F.col("p"), has, positive)
        + cell(F.col("n"), has, negative)
        + cell(positive - F.col("p"), lacks, positive)
        + cell(negative - F.col("n"), lacks, negative)
    )


def derived_groups(sample: DataFrame, positive: int, negative: int) -> tuple[tuple[str, ...], ...]:
    """Groups of at most DERIVED words of ``sample`` (text, label) that stand for each other."""
    low = F.regexp_extract_all(C.ascii_lower(F.col("text")), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    pairs = sample.select("doc_id", F.col("label") > 0, low.alias("w")).toDF("doc_id", "toxic", "w").select(
        "doc_id", "toxic", F.posexplode("w").alias("pos", "word"), F.col("w")
    )
    pairs = pairs.select("doc_id", "toxic", "word", F.when(F.col("pos") > 0, F.get("w", F.col("pos") - 1)).alias("before"))
    seen = pairs.groupBy("word", "doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    counted = seen.groupBy("word").agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n"))
    share = (F.col("p") + F.col("n")) / (positive + negative)
    middling = counted.where((F.length("word") > 2) & share.between(LEAST_SHARE, MOST_SHARE) & (_association(positive, negative) <= ALIKE))
    chosen = middling.select("word", (F.col("p") + F.col("n")).alias("docs")).orderBy(F.desc("docs"), "word").limit(4 * DERIVED)
    context = pairs.where("before is not null").join(F.broadcast(chosen), "word").groupBy("word", "docs", "before").agg(F.count("*").alias("times"))
    best = context.groupBy("word", "docs").agg(F.max_by("before", F.struct("times", "before")).alias("before"))
    rows = sorted(best.collect(), key=lambda r: (-r.docs, r.word))  # at most 4 * DERIVED rows
    groups: dict[str, list[str]] = {}
    for r in rows:
        groups.setdefault(r.before, []).append(r.word)
    out, left = [], DERIVED
    for words in groups.values():
        words = words[: max(0, left)]
        if len(words) > 1:
            out.append(tuple(words))
            left -= len(words)
    return tuple(out)


def _words_hashed(words: list[str]) -> np.ndarray:
    """The features that stand for whole words."""
    out = []
    for texts in C.passes(pa.array(words, pa.string())):
        low = C.lower_bytes(texts.data)
        starts, ends, _ = C.words(texts, C.ALNUM, low)
        out.append(C.span_hash(C.byte_sums(low), starts, ends))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS,
    penalty: float = 1.0,
    rows: int = SAMPLE_ROWS,
    terms: int = TERMS,
    steps: int = 600,
    derive: bool = True,
) -> Model:
    """Fit on at most ``rows`` labelled documents; ``penalty`` weighs squared changes of the score under swaps."""
    C.tune(docs.sparkSession)
    drawn = C.written(labelled_sample(docs, labels, label, rows))
    count = {int(r["label"] > 0): r["n"] for r in drawn.groupBy((F.col("label") > 0).cast("int").alias("label")).agg(F.count("*").alias("n")).collect()}
    positive, negative = count.get(1, 0), count.get(0, 0)
    if not positive or not negative:
        mean = positive / max(1, positive + negative)
        return Model(np.zeros(0, np.uint64), np.zeros(0), 30.0 if mean == 1 else -30.0)
    if derive:
        listed = {t for g in groups for t in g}
        found = (tuple(w for w in g if w not in listed) for g in derived_groups(drawn, positive, negative))
        groups = (*groups, *(g for g in found if len(g) > 1))
    sample = C.written(drawn.select("doc_id", "label", _training_features(groups)("text").alias("f")).select("doc_id", "label", "f.here", "f.swapped"))
    chosen = (
        sample.select("label", F.explode("here").alias("h"))
        .groupBy("h")
        .agg(F.count_if(F.col("label") > 0).alias("p"), F.count_if(F.col("label") <= 0).alias("n"))
        .where((F.col("p") + F.col("n") >= LEAST_DOCS) & (F.col("p") * negative > F.col("n") * positive))
        .select("h", _association(positive, negative).alias("g"))
        .orderBy(F.desc("g"), "h")
        .limit(terms)
        .toArrow()["h"]
        .to_numpy()
    )
    hashes = np.unique(np.concatenate((chosen.view(np.uint64), _words_hashed([t for g in groups for t in g]))))
    wanted = F.array(*(F.lit(int(h)) for h in hashes.view(np.int64))) if len(hashes) else F.array().cast("array<bigint>")
    few = sample.select(
        "doc_id", "label", F.array_intersect("here", wanted).alias("here"), F.array_intersect("swapped", wanted).alias("swapped")
    ).toArrow()  # at most ``rows`` rows of ``terms`` and the groups' hashes
    few = few.sort_by("doc_id")
    y = (few["label"].to_numpy() > 0).astype(float)

    def matrix(name: str, base: np.ndarray | None = None) -> np.ndarray:
        out = np.zeros((len(y), len(hashes)))
        for i, found in enumerate(few[name].to_pylist()):
            if found is None:
                out[i] = base[i]
            elif found:
                out[i, np.searchsorted(hashes, np.array(found, np.int64).view(np.uint64))] = 1
        return out

    here = matrix("here")
    other = matrix("swapped", here)
    moved = np.flatnonzero((here != other).any(axis=1))
    one, two = here[moved], other[moved]
    parts = {"w": np.zeros(len(hashes)), "b": np.array([np.log(positive / negative)])}
    adam = Adam(parts, 0.05)
    for _ in range(steps):
        miss = (sigmoid(here @ parts["w"] + parts["b"]) - y) / len(y)
        grad, rest = here.T @ miss + 1e-4 * parts["w"], miss.sum()
        if len(moved):
            p, q = sigmoid(one @ parts["w"] + parts["b"]), sigmoid(two @ parts["w"] + parts["b"])
            pull = 2 * penalty / len(moved) * (p - q)
            by_one, by_two = pull * p * (1 - p), pull * q * (1 - q)
            grad += one.T @ by_one - two.T @ by_two
            rest += (by_one - by_two).sum()
        adam.update({"w": grad, "b": np.array([rest])})
    return Model(hashes, parts["w"], float(parts["b"][0]), groups, len(moved))


def scorer(model: Model):
    @F.arrow_udf(DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(model.scores(column), pa.float64())

    return score
