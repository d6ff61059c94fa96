"""Language identification by error-correcting output codes.

Each language has a codeword; one binary linear classifier over byte trigrams predicts
each bit.  A text gets the language whose codeword loses least, each bit weighed by how
well its classifier does; a text whose two best languages are close is flagged.

Fitting uses a bounded sample of labelled rows (``rows``); every whole text is scored.

Defined results: a null text, or one without any letter, is ``und`` with score 0, as is
every text where no language was learned.  Repeated rows are predicted apart.  Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from casequarry.llm import common as C
from casequarry.llm.training import Adam, sigmoid

SAMPLE_ROWS, BUCKETS, AMBIGUOUS = 3000, 4096, 0.6
UNDETERMINED = "und"

_rng = np.random.default_rng(77)
_MIX = _rng.integers(0, BUCKETS, (3, 256)).astype(np.int32)
#: Bytes as the classifiers see them: letters and non-ASCII as they are, lower-cased, the rest a space.
_SEEN = np.full(256, 32, np.uint8)
_SEEN[97:123] = np.arange(97, 123)
_SEEN[65:91] = np.arange(97, 123)
_SEEN[128:] = np.arange(128, 256)
_A, _B, _C = (m[_SEEN] for m in _MIX)


def trigrams(texts: C.Texts) -> np.ndarray:
    """Bucket of the trigram at each byte; BUCKETS where it would leave its text."""
    data, n = texts.data, len(texts.data)
    out = np.full(n, BUCKETS, np.int32)
    if n > 2:
        out[:-2] = _A[data[:-2]] ^ _B[data[1:-1]] ^ _C[data[2:]]
    ends = texts.starts[1:]
    for back in (1, 2):
        at = ends - back
        out[at[at >= texts.starts[:-1]]] = BUCKETS
    return out


def codewords(languages: int) -> np.ndarray:
    """Rows of -1 and 1: every distinct split for few languages, seeded far-apart splits for many."""
    if languages <= 6:
        splits = [(1, *rest) for rest in product((-1, 1), repeat=languages - 1)]
        splits = [s for s in splits if -1 in s] or [(1,) * languages]
        return np.array(splits, np.int8).T
    rng, bits = np.random.default_rng(5), int(np.ceil(10 * np.log2(languages)))
    tries = [rng.choice(np.array([-1, 1], np.int8), (languages, bits)) for _ in range(200)]

    def gap(code: np.ndarray) -> int:
        far = (code[:, None] != code[None]).sum(axis=2)
        return int(far[np.triu_indices(languages, 1)].min())

    return max(tries, key=gap)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def margins(self, column: pa.Array) -> np.ndarray:
        out = []
        table = np.concatenate((self.weights, np.zeros((1, self.weights.shape[1]), np.float32)))
        for texts in C.passes(column):
            found = trigrams(texts)
            sizes = np.diff(texts.starts)
            total = np.zeros((len(texts), table.shape[1]), np.float32)
            full = sizes > 0
            if full.any():
                total[full] = np.add.reduceat(table[found], texts.starts[:-1][full], axis=0)
            out.append(total / np.maximum(sizes - 2, 1)[:, None] + self.bias)
        return np.concatenate(out) if out else np.zeros((0, table.shape[1]), np.float32)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest codeword by weighed logistic loss, and its share of the likelihood."""
        loss = np.logaddexp(0, -self.code[None] * margins[:, None]) @ self.trust
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return loss.argmin(axis=1), share.max(axis=1) / share.sum(axis=1)


def fit(docs: DataFrame, lang_col: str = "lang", rows: int = SAMPLE_ROWS, steps: int = 150, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Fit on at most ``rows`` rows with text and language, drawn by a hash of their id."""
    C.tune(docs.sparkSession)
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    known = known.where("lang is not null and text is not null")
    # Ids are drawn on their own; they are at most ``rows`` and can be sent to every task.
    drawn = known.select(F.col("doc_id").alias("k")).where("k is not null").orderBy(F.xxhash64(F.lit("sample"), "k"), "k").limit(rows)
    texts = known.join(F.broadcast(drawn.distinct()), F.col("doc_id") == F.col("k")).groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("r"))
    sample = texts.select("doc_id", "r.lang", _profile()("r.text").alias("counts")).toArrow().sort_by("doc_id")
    if not len(sample):
        return None
    names = sample["lang"].to_pylist()
    languages = sorted(set(names))
    x = np.zeros((len(names), BUCKETS), np.float32)
    for i, raw in enumerate(sample["counts"].to_pylist()):
        pair = np.frombuffer(raw, np.int32).reshape(2, -1)
        x[i, pair[0]] = pair[1]
    x /= np.maximum(x.sum(axis=1, keepdims=True), 1)
    code = codewords(len(languages))
    y = code[[languages.index(n) for n in names]].astype(np.float32)
    # Every fifth row is left out of the fit and tells how far each bit can be trusted.
    kept = np.arange(len(y)) % 5 != 4
    fitted, pattern = x[kept], y[kept]
    parts = {"w": np.zeros((BUCKETS, code.shape[1]), np.float32), "b": np.zeros(code.shape[1], np.float32)}
    adam = Adam(parts, 0.5)
    for _ in range(steps):
        pull = (-pattern * sigmoid(-pattern * (fitted @ parts["w"] + parts["b"])) / len(pattern)).astype(np.float32)
        adam.update({"w": fitted.T @ pull + np.float32(1e-7) * parts["w"], "b": pull.sum(axis=0)})
    told = ~kept if len(y) > 4 else kept
    right = ((x[told] @ parts["w"] + parts["b"]) * y[told] > 0).mean(axis=0)
    return Model(languages, code, parts["w"], parts["b"], np.maximum(2 * right - 1, 0.01))


def _profile():
    from pyspark.sql.types import BinaryType

    @F.arrow_udf(BinaryType())
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            out = []
            for texts in C.passes(column):
                found = trigrams(texts)
                for a, b in zip(texts.starts[:-1], texts.starts[1:], strict=True):
                    n = np.bincount(found[a:b], minlength=BUCKETS + 1)[:BUCKETS]
                    at = np.flatnonzero(n)
                    out.append(np.concatenate((at, n[at])).astype(np.int32).tobytes())
            yield pa.array(out, pa.binary())

    return count


def predictor(model: Model | None):
    """A column function: struct of lang, score and ambiguous for a text column."""
    kind = StructType().add("lang", StringType()).add("score", DoubleType()).add("ambiguous", BooleanType())

    @F.arrow_udf(kind)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            if model is None:
                lang, score = [None] * len(column), np.zeros(len(column))
            else:
                best, score = model.decode(model.margins(column))
                lang = [model.languages[i] for i in best]
            yield pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score.astype(float)), pa.array(score < AMBIGUOUS)], names=["lang", "score", "ambiguous"]
            )

    def apply(text: Column) -> Column:
        # Texts without letters have no language whatever the classifiers say.
        raw, letters = predict(text), F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
        said = letters & raw["lang"].isNotNull()
        return F.struct(
            F.when(said, raw["lang"]).otherwise(UNDETERMINED).alias("lang"),
            F.when(said, raw["score"]).otherwise(0.0).alias("score"),
            (~said | raw["ambiguous"]).alias("ambiguous"),
        )

    return apply
