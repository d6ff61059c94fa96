"""Language-model scores against the model computed from plain counts."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from casequarry.llm import common as C
from casequarry.llm import ngrams, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
D = ngrams.DISCOUNT


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


class Model:
    def __init__(self, texts):
        self.n1 = Counter(t for text in texts for t in tokens(text))
        self.total, self.kinds = sum(self.n1.values()), len(self.n1)
        self.seen = [defaultdict(Counter), defaultdict(Counter)]
        for text in texts:
            for a, b, c in self.grams(text):
                self.seen[0][b][c] += 1
                self.seen[1][a, b][c] += 1

    def known(self, t):
        return t if t in self.n1 else "?unknown"

    def grams(self, text):
        t = ["?start", "?start", *map(self.known, tokens(text))]
        return zip(t, t[1:], t[2:], strict=False)

    def p(self, a, b, c):
        out = (self.n1[c] + 0.5) / (self.total + 0.5 * (self.kinds + 1))
        for counts in (self.seen[0].get(b), self.seen[1].get((a, b))):
            if counts:
                n = sum(counts.values())
                out = max(counts[c] - D, 0) / n + D * len(counts) / n * out
        return out

    def row(self, text):
        t = tokens(text)
        base = sum(math.log10((self.n1[x] + 0.5) / (self.total + 0.5 * (self.kinds + 1))) for x in t)
        return len(t), sum(x in self.n1 for x in t), base, sum(math.log10(self.p(*g)) for g in self.grams(text))


def compare(rows, docs):
    model = Model([t for d, t in docs if not held(d)])
    expected = sorted(((d is None, d or 0), *model.row(t)) for d, t in docs)
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_tokens, r.n_known, r.base_score, r.score) for r in rows)
    assert len(got) == len(expected) and {r.train_tokens for r in rows} <= {model.total}
    for mine, theirs in zip(got, expected, strict=True):
        assert mine[:3] == theirs[:3]
        assert mine[3] == pytest.approx(theirs[3], abs=1e-6)
        assert mine[4] == pytest.approx(theirs[4], abs=6e-4 * mine[1])  # 16-bit codes
    assert {(r.doc_id, r.held_out) for r in rows} == {(d, held(d)) for d, _ in docs}
    return model


def run(spark, docs):
    df = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id bigint, text string, run int, shard string")
    return ngrams.scores(df, C.remainder(F.col("doc_id"), 5) == 1).collect()


@pytest.mark.parametrize("shard", [1 << 21, 300])
def test_scores(spark, monkeypatch, shard):
    """One shard, and many shards of tokens and words."""
    monkeypatch.setattr(ngrams, "TOKENS", shard)
    monkeypatch.setattr(ngrams, "WORDS", shard)
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocab, [1 / (k + 1) for k in range(60)], k=rng.randint(0, 40)))) for i in range(200)]
    docs += [(500, None), (501, ""), (502, "Été W1 w1\tw2\n"), (503, "the same " * 3000), (None, "w1 w2 w3"), (7, "w1 w2"), (7, "w1 w2"), (504, "only here, and here")]
    compare(run(spark, docs), docs)


def test_edges(spark):
    assert run(spark, []) == []
    docs = [(i, "a b") for i in range(60) if held(i)]
    assert docs and {(r.base_score, r.score, r.n_known, r.train_tokens) for r in run(spark, docs)} == {(0.0, 0.0, 0, 0)}


def test_classes_of_frequent_words(spark, monkeypatch):
    """A frequent middle word is split by the first word; probabilities of any context still sum to one."""
    monkeypatch.setattr(ngrams, "CLASS", 50)
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices("abcd", [8, 1, 1, 1], k=20))) for i in range(100)]
    plain = {r.doc_id: r for r in run(spark, docs)}
    assert all(r.score < 0 and r.n_tokens == 21 for r in plain.values())
    rng = np.random.default_rng(5)
    words = 6
    ctx, w1, w3 = (rng.integers(0, k, 4000) for k in (3, 4, words))
    p1 = np.bincount(w3, minlength=words) / len(w3)
    asks = [(c, a, w) for c in range(4) for a in range(5) for w in range(words)]
    every = [np.concatenate([x, [q[i] for q in asks]]) for i, x in enumerate((ctx, w1, w3))]
    logs = ngrams._tallied(*every, ngrams.code(p1)[every[2]].astype(int), np.arange(len(every[0])) < 4000)
    for k in range(len(asks) // words):
        total = (10 ** (logs[4000 + k * words : 4000 + (k + 1) * words] / -ngrams.SCALE)).sum()
        assert total == pytest.approx(1, abs=2e-3)


@pytest.mark.parametrize("block", [4, 1 << 13])
def test_elias_fano(monkeypatch, block):
    monkeypatch.setattr(ngrams.EliasFano, "BLOCK", block)
    rng = np.random.default_rng(1)
    for values in ([], [0], [7], [0, 0, 0], [5, 5, 9], sorted(rng.integers(0, 1000, 300)), np.unique(rng.integers(0, 1 << 50, 300)), np.arange(50)):
        values = np.array(values, np.int64)
        coded = ngrams.EliasFano(ngrams.EliasFano.arrays(values))
        assert coded.at(np.arange(len(values))).tolist() == values.tolist()
        if len(np.unique(values)) == len(values):
            asks = np.unique(np.concatenate([values, values + 1, np.maximum(values - 1, 0), [0, 1 << 51]]))
            place, found = coded.successor(asks)
            want = np.searchsorted(values, asks)
            assert place.tolist() == want.tolist()
            assert [f for f, w in zip(found, want, strict=True) if w < len(values)] == [values[w] for w in want if w < len(values)]


def test_packing():
    for values in ([], [0, 0], [1, 255, 256], [1 << 40, 3]):
        assert ngrams.unpack(ngrams.pack(np.array(values, np.int64))).tolist() == values


def test_query(spark, sf):
    docs = [tuple(r) for r in C.tables(spark, sf, "documents").select("doc_id", "text").collect()]
    rows = queries.QUERIES["op13_lm_score"](spark, sf).collect()
    compare(rows, docs)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
