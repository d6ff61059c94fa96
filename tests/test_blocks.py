"""Block joins, running sums, the resolver's ledger and bucketed versions."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casequarry import schemas
from casequarry.operators import blocks
from casequarry.operators import resolve as Res
from casequarry.operators import retrieval as R
from casequarry.operators.running import running
from casequarry.sources.versioned import BucketedTable


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    words = [f"w{i:02d}" for i in range(40)]
    made = []
    for i in range(140):
        text = " ".join(rng.choices(words, [1 / (k + 1) for k in range(40)], k=rng.randint(0, 12)))
        made.append((i, text, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)] if i % 17 else None))
    return made


def frames(spark, rows):
    df = spark.createDataFrame(rows, "row_id bigint, text string, vector array<double>")
    return df.where("row_id % 5 <> 0"), df.where("row_id % 5 = 0")


def cosines(rows):
    """All pairs by plain loops: (query, train) -> (lexical, dense or None), rounded."""
    train = [r for r in rows if r[0] % 5]
    asked = [r for r in rows if r[0] % 5 == 0]
    tf = {r[0]: {w: r[1].split().count(w) for w in set(r[1].split())} for r in rows}
    df = {w: sum(w in tf[r[0]] for r in train) for r in train for w in tf[r[0]]}
    idf = {w: np.log((1 + len(train)) / (1 + n)) + 1 for w, n in df.items()}
    unit = {}
    for i, c in tf.items():
        v = {w: (1 + np.log(n)) * idf[w] for w, n in c.items() if w in idf}
        unit[i] = {w: x / np.sqrt(sum(y * y for y in v.values())) for w, x in v.items()}
    out = {}
    for q in asked:
        for t in train:
            lex = round(sum(x * unit[t[0]].get(w, 0.0) for w, x in unit[q[0]].items()), 6)
            den = None
            if q[2] is not None and t[2] is not None:
                a, b = (np.array(v) / (np.linalg.norm(v) or 1.0) for v in (q[2], t[2]))
                den = round(float(a @ b), 6)
            out[q[0], t[0]] = lex, den
    return out


def best(scores, n):
    by = {}
    for (q, t), s in scores.items():
        by.setdefault(q, []).append((-s, t))
    return {(q, t): -s for q, found in by.items() for s, t in sorted(found)[:n]}


def close(got, want):
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)


@pytest.mark.parametrize("sizes", [{}, {"query_rows": 9, "train_rows": 40}])
def test_nearest_of_all_pairs(spark, rows, sizes):
    train, asked = frames(spark, rows)
    pairs = cosines(rows)
    lexical = R.lexical_nearest(*R.tfidf_vectors(train, asked), 9, **sizes)
    close({(r.query_id, r.train_id): r.sim for r in lexical.collect()}, best({k: lex for k, (lex, _) in pairs.items() if lex > 0}, 9))
    dense = R.dense_nearest(train, asked, 9, **sizes)
    close({(r.query_id, r.train_id): r.sim for r in dense.collect()}, best({k: d for k, (_, d) in pairs.items() if d is not None}, 9))
    for alpha in (0.3,):
        both = {k: v for k, v in pairs.items() if v[1] is not None}
        bounds = {q: [(min(x), max(x)) for x in zip(*[v for (a, _), v in both.items() if a == q], strict=True)] for q, _ in both}
        mixed = {
            k: round(alpha * (v[0] - bounds[k[0]][0][0]) / (np.ptp(bounds[k[0]][0]) or 1) + (1 - alpha) * (v[1] - bounds[k[0]][1][0]) / (np.ptp(bounds[k[0]][1]) or 1) + R.NUDGE, 6)
            for k, v in both.items()
        }
        got = {(r.query_id, r.train_id): r.sim for r in R.hybrid_nearest(train, asked, 9, (alpha,), **sizes).collect()}
        close(got, best(mixed, 9))


def test_plan_does_not_grow_with_blocks(spark, rows):
    train, asked = frames(spark, rows)
    t, q = R.tfidf_vectors(train, asked)
    plans = [R.lexical_nearest(t, q, 5, query_rows=n, train_rows=n)._jdf.queryExecution().optimizedPlan().toString().count("\n") for n in (1000, 5)]
    assert plans[0] == plans[1]
    assert blocks.block_counts(100, 100, 8) == (1, 1) and blocks.block_counts(10**6, 10**7, 8) == (489, 1221) and blocks.block_counts(100, 10**4, 8) == (1, 16)


def test_empty_sides(spark, rows):
    train, asked = frames(spark, rows)
    for t, q in ((train.where("false"), asked), (train, asked.where("false"))):
        assert R.lexical_nearest(*R.tfidf_vectors(t, q), 3).count() == R.dense_nearest(t, q, 3).count() == R.hybrid_nearest(t, q, 3).count() == 0


def test_running(spark):
    rng = random.Random(1)
    values = [(i, rng.randint(0, 9)) for i in range(500)]
    rng.shuffle(values)
    df = spark.createDataFrame(values, "i int, n int").repartition(6)
    upto = dict(zip(range(500), np.cumsum([n for _, n in sorted(values)]).tolist(), strict=True))
    got = running(df, ["i"], F.col("n")).collect()
    assert {r.i: r.upto for r in got} == upto and {r.upto_total for r in got} == {upto[499]}
    some = {r.i: r.upto for r in running(df, ["i"], F.col("n"), only_below=300).collect()}
    assert all(some[i] in (u, None) for i, u in upto.items()) and all(some[i] == u for i, u in upto.items() if u <= 300)
    assert running(df.where("false"), ["i"]).count() == 0


def cites(spark, n=23):
    return spark.createDataFrame([(d, p, f"{100 + (d + p) % n} U.S. {(d + p) % n}") for d in range(10) for p in range(5)] + [(11, 0, None), (11, 1, "")], "row_id bigint, pos int, normalized string")


CACHE = [("100 U.S. 0", "c0", "resolved", 1.0, "t", Res.VERSION), ("101 U.S. 1", None, "unresolved", None, "t", Res.VERSION), ("102 U.S. 2", "old", "resolved", 1.0, "t", "resolver-0")]


def service(folder, stop=None):
    """A lookup that notes each call in a file, and is out of order from call ``stop`` on."""

    def lookup(cite):
        calls = sorted(folder.iterdir())
        if stop is not None and len(calls) >= stop:
            import os

            os._exit(1)  # the worker dies, as with a lost executor
        page = int(cite.split()[-1])
        path = folder / f"{page}-{len([c for c in calls if c.name.startswith(f'{page}-')])}"
        path.touch()
        if page % 7 == 5:
            raise OSError("503")
        return [] if page % 7 == 6 else [{"cluster_id": page, "citation": [cite]}]

    return lookup


def test_resolve_run(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    cache = spark.createDataFrame(CACHE, schemas.schema("citation_cache"))
    enriched, filled, metrics = Res.resolve_run(cites(spark), cache, service(tmp_path / "calls"), str(tmp_path / "ledger"), batch=4, limit=9, at="now")
    got = {r.normalized: (r.resolution_status, r.resolved_id, r.excluded_reason) for r in enriched.collect()}
    assert got["100 U.S. 0"] == ("resolved", "c0", None) and got["101 U.S. 1"] == ("unresolved", None, "cached_unresolved")
    assert got["102 U.S. 2"] == ("resolved", "2", None)  # an entry of another version is asked again
    assert got["105 U.S. 5"] == ("unresolved", None, "api_error_after_retries: 503") and got["106 U.S. 6"] == ("unresolved", None, "no_match")
    assert got["110 U.S. 10"] == ("unresolved", None, "api_budget_exceeded")  # a third chunk of four passes nine
    m = metrics.first()
    assert (m.total_submitted, m.cache_hits, m.api_calls, m.budget_exceeded_count) == (14, 2, 8, 4)
    assert m.resolved_count + m.unresolved_count + sum(1 for r in enriched.collect() if r.excluded_reason == Res.REFUSED) == 50
    cached = {r.normalized: (r.resolved_id, r.resolution_status) for r in filled.collect()}
    assert len(cached) == 10 and cached["105 U.S. 5"] == (None, "unresolved") and "110 U.S. 10" not in cached and cached["102 U.S. 2"] == ("2", "resolved")
    told = {r.row_id: r.targets for r in Res.run_targets(enriched).collect()}
    assert told[0] == ["c0", "2", "3", "4"]


def test_resolve_run_finds_citations_once(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    found = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def costly(cite):
        found.add(1)
        return cite

    cache = spark.createDataFrame(CACHE, schemas.schema("citation_cache"))
    rows = cites(spark).withColumn("normalized", costly("normalized"))
    enriched, _, metrics = Res.resolve_run(rows, cache, service(tmp_path / "calls"), batch=4, limit=9)
    n = enriched.count()
    assert metrics.first().api_calls == 8 and found.value == n


def test_resolve_run_goes_on_where_it_stopped(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    cache = spark.createDataFrame(CACHE, schemas.schema("citation_cache"))
    ledger = str(tmp_path / "ledger")
    one = cites(spark).coalesce(1)
    with pytest.raises(Exception):  # noqa: B017, PT011  the job of the third chunk fails
        Res.resolve_run(one, cache, service(calls, stop=8), ledger, batch=4)
    assert len(Res.Ledger(spark, ledger).done()) == 2 and len(list(calls.iterdir())) == 8
    enriched, _, metrics = Res.resolve_run(one, cache, service(calls), ledger, batch=4)
    assert metrics.first().api_calls == 12 and len(list(calls.iterdir())) == 12  # each citation was asked once
    Res.resolve_run(one, cache, service(calls), ledger, batch=4)[0].count()
    assert all(c.name.endswith("-0") for c in calls.iterdir()) and enriched.where("excluded_reason = 'api_budget_exceeded'").count() == 0


def test_bucketed_table(spark, tmp_path):
    kind = schemas.StructType.fromDDL("k string, v int")
    table = BucketedTable(spark, str(tmp_path / "t"), "k", kind, 8)
    replace = lambda old, new: old.join(new, "k", "left_anti").unionByName(new)
    assert table.read().count() == 0
    first = spark.createDataFrame([(f"k{i}", i) for i in range(40)], kind)
    assert table.upsert(0, first, replace) == list(range(8))
    before = table.pointers()
    touched = table.upsert(1, spark.createDataFrame([("k3", 300), ("new", 1)], kind), replace)
    after = table.pointers()
    assert len(touched) <= 2 and {b for b in after if after[b] != before.get(b)} == set(touched)
    values = {r.k: r.v for r in table.read().collect()}
    assert values == {f"k{i}": i for i in range(40)} | {"k3": 300, "new": 1}
    assert table.upsert(1, spark.createDataFrame([("k3", 300), ("new", 1)], kind), replace) == touched  # repeated
    assert {r.k: r.v for r in table.read().collect()} == values and table.read(0).count() == 40
    assert json.loads((tmp_path / "t" / "pointers" / "000000001.json").read_text())["rewritten"] == touched
    assert table.vacuum(1) == len(touched) and {r.k: r.v for r in table.read().collect()} == values


def test_rounds_leave_what_one_join_finds(spark, rows, monkeypatch):
    """Query blocks met in several rounds, frequent terms as a matrix or not at all, parts of blocks: the same neighbours."""
    train, asked = frames(spark, rows)
    t, q = R.tfidf_vectors(train, asked)
    want = sorted(map(tuple, R.lexical_nearest(t, q, 9).collect()))
    monkeypatch.setattr(blocks, "ROUND", 2)
    assert sorted(map(tuple, R.lexical_nearest(t, q, 9, query_rows=5, train_rows=30).collect())) == want
    one = q.toArrow(), t.toArrow()
    kinds = R._kinds(q, t)[1]
    found = []
    for shared, dense, chunk, slab in ((0.0, 1024, 256, 8192), (0.01, 3, 5, 7), (2.0, 0, 256, 50)):
        for name, value in (("SHARED", shared), ("DENSE_TERMS", dense), ("CHUNK", chunk), ("SLAB", slab)):
            monkeypatch.setattr(R, name, value)
        pairs = R._best_kernel(9, kinds, True)(*one).to_pylist()
        found.append({(p["query_id"], p["train_id"]): p["sim"] for p in pairs})
    assert found[0] == found[1] == found[2] == {(r.query_id, r.train_id): r.sim for r in R.lexical_nearest(t, q, 9).collect()}


def test_a_number_of_the_row_is_worked_out_once(spark, rows):
    """Norms stand outside the lambdas, so a vector's work grows with its length and not with its square."""
    train, asked = frames(spark, rows)
    for frame in (R.unit(train.where("vector is not null")), R.weights(R.tokens(asked), R.vocabulary(R.tokens(train), 112, 50), (50,))):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "array_repeat(" in plan
    made = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [])], "row_id bigint, vector array<double>")
    assert {r.row_id: r.vector for r in R.unit(made).collect()} == {1: [0.6, 0.8], 2: [0.0, 0.0], 3: [0.0, 0.0], 4: []}
