"""Ranked search against scores computed document by document."""

import math
import random
import re
from collections import Counter

import numpy as np
from oracle import check, connect

from casequarry.llm import lexical, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    tf = [(d, Counter(words(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in set(items):
        asked = Counter(words(text))
        scored = []
        for d, c in tf:
            m = 75 + (25 * sum(c.values()) * n_docs) // max(1, total)
            s = sum(q * math.floor(1000 * math.log((2.0 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d))
        out += [(item, i, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id bigint, text string, term string, n int")
    q = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, no string")
    return sorted((tuple(r) for r in lexical.search(d, q, **more).collect()), key=str)


def test_ranking(spark):
    rng = random.Random(3)
    vocab = ["a", "B", "été", "x1", "12", "der", "Die", "das", "rare"]
    docs = [(i, " ".join(rng.choices(vocab, [9, 8, 7, 6, 5, 4, 3, 2, 0.2], k=rng.randint(0, 12)))) for i in range(400)]
    docs += [(None, "rare rare"), (5, "rare"), (5, "rare"), (-7, "rare"), (1000, None), (1001, ""), (1002, "-- ."), (1003, "a " * 30_000)]
    items = [(1, "A rare été rare"), (1, "A rare été rare"), (2, "das; der die"), (2, "12"), (3, None), (4, "nowhere"), (None, "x1-b")]
    expected = brute(docs, items, 6)
    assert found(spark, docs, items, k=6) == expected
    assert found(spark, docs, items, k=6, block_items=2, window=64) == expected  # several blocks of queries, windows smaller than a shard


def test_edges(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a b")], []) == []
    assert found(spark, [(1, None)], [(1, "a")]) == []


def test_heap_keeps_smaller_documents_of_ties():
    best = lexical._Best(3)
    best.add(np.array([5, 5, 5, 1]), np.array([9, 4, 7, 1]))
    best.add(np.array([5, 6, 0]), np.array([2, 30, 3]))
    assert sorted(best.heap) == [(5, -4), (5, -2), (6, -30)]


def test_query(spark, sf):
    check(queries.QUERIES["op12_lexical_search"](spark, sf), connect(sf), queries.ORACLE_SQL["op12_lexical_search"])
