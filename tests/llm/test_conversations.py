"""The prefix trie against one built node by node."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from oracle import check, connect

from casequarry.llm import conversations, queries

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]


def brute(convs):
    """convs: id -> list of texts."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1].encode()) if node else 0) + sum(saved[k] for k in kids[node])
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest() if n in ends else None)
        for n, m in members.items()
    )


def rows(nodes):
    return sorted((*r[:-1], bytes(r[-1]).hex() if r[-1] is not None else None) for r in nodes.select(*NAMES).collect())


def table(spark, convs):
    said = [(c, i, "user", t, "extra") for c, turns in convs.items() for i, t in enumerate(turns)]
    turns = conversations.sequences(spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string, part string"))
    bare = spark.createDataFrame([(c,) for c in convs], "conv_id bigint")
    from pyspark.sql import functions as F

    return bare.join(turns, "conv_id", "left").select("conv_id", F.coalesce("turns", F.array().cast("array<string>")).alias("turns"))


SHAPES = {
    "small alphabet": lambda r: {i: [r.choice("abé") * r.randint(1, 2) for _ in range(r.randint(0, 5))] for i in range(120)},
    "chains": lambda r: {i: ["x"] * r.randint(0, 40) for i in range(60)},
    "comb": lambda r: {i: ["x"] * (i // 2) + ["yz"] * (i % 2) for i in range(60)},
    "copies": lambda r: {i: r.choice([["a", "b"], ["a", "b", "c"], [], ["a"]]) for i in range(90)},
    "one root text": lambda r: {i: ["same", "start", *(r.choice("ab") for _ in range(r.randint(0, 6)))] for i in range(80)},
    "one": lambda r: {7: ["a", "b"]},
    "one without turns": lambda r: {7: []},
}


@pytest.mark.parametrize(("shape", "blocks"), [*((s, 6) for s in SHAPES), ("small alphabet", 30)])
def test_trie(spark, shape, blocks):
    convs = SHAPES[shape](random.Random(blocks))
    assert rows(conversations.prefix_trie(table(spark, convs), blocks)) == brute(convs)


def test_edges(spark):
    turns = [(5, None, "a", "late"), (5, 0, None, None), (5, 1, "a", "x" * 100_000), (5, 1, "a", "x" * 100_000), (6, 0, "a", ""), (None, 0, "a", "b"), (-3, 2, "u", "ö")]
    df = spark.createDataFrame([(*t, "e", "e") for t in turns], "conv_id bigint, turn bigint, role string, text string, head string, key string")
    got = {r.conv_id: len(r.turns) for r in conversations.sequences(df).collect()}
    assert got == {5: 4, 6: 1, -3: 1}
    first = next(r for r in conversations.sequences(df).collect() if r.conv_id == 5).turns
    assert int(first[0][32:], 16) == 4 and first[2] == first[3]  # the turn without a number comes first, repeated rows stay
    assert conversations.prefix_trie(conversations.branched(df)).count() > 0
    assert conversations.prefix_trie(conversations.branched(df.where("false"))).count() == 0


def test_pieces_of_ends(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 7)
    convs = {i: ["a"] if i % 3 else ["a", "b"] for i in range(100)}
    assert rows(conversations.prefix_trie(table(spark, convs), 3)) == brute(convs)


def test_minima():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 33):
        x = rng.integers(0, 6, n)
        low = conversations.Minima(x)
        at, v = (a.ravel() for a in np.meshgrid(np.arange(n), np.arange(7)))
        assert low.smaller_before(at, v).tolist() == [max((j for j in range(i) if x[j] < w), default=-1) for i, w in zip(at, v, strict=True)]
        assert low.smaller_after(at, v).tolist() == [min((j for j in range(i + 1, n) if x[j] < w), default=n) for i, w in zip(at, v, strict=True)]
        a, b = (np.concatenate(p) if n else np.zeros(0, int) for p in zip(*[(np.full(n - i + 1, i), np.arange(i, n + 1)) for i in range(n)])) if n else (np.zeros(0, int), np.zeros(0, int))
        assert low.least(a, b).tolist() == [min(x[i:j], default=np.iinfo(np.int64).max) for i, j in zip(a, b, strict=True)]


def test_query(spark, sf):
    check(queries.QUERIES["op11_conversation_trie"](spark, sf), connect(sf), queries.ORACLE_SQL["op11_conversation_trie"])
