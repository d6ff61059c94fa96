"""Classifiers by their held-out accuracy, passages by planted ones, and the pipeline by its stages' own results."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casequarry.llm import common as C
from casequarry.llm import langid, passages, quality, queries, simhash, toxicity

SF01 = "/root/testdata/sf0.01"
GOOD, BAD = "the river runs by the old town and people walk there in the evening", "zorp|zorp|zorp|blat|blat|blat|zorp|zorp"


def labelled(spark, n=160, extra=()):
    rows = [(i, f"{GOOD if i % 2 else BAD} {i}", i % 2) for i in range(n)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + list(extra), "doc_id bigint, text string, label string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (10**6, 1)], "doc_id bigint, y int")


def test_held_out_remainders(spark):
    rows = spark.range(50).select("id", C.remainder(F.col("id"), 5).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def held_out(spark, name, label):
    scored = queries.QUERIES[name](spark, SF01).where("held_out")
    truth = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    return scored.join(truth, "doc_id").toPandas()


def test_quality_accuracy(spark):
    got = held_out(spark, "op8_quality", "quality")
    assert (got.predicted == got.y).mean() >= 0.93 and got.predicted[got.y == 1].mean() >= 0.97
    assert got.score.between(0, 1).all()


def test_toxicity_accuracy(spark):
    got = held_out(spark, "op2_toxicity", "toxic")
    assert (got.predicted == got.y).mean() >= 0.88 and got.predicted[got.y == 0].mean() <= 0.03


def test_language_accuracy(spark):
    got = queries.op6_language(spark, SF01).where("held_out").join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.lang_pred == got.lang).mean() >= 0.98


def test_quality_edges(spark, edges, empty):
    docs, labels = labelled(spark)
    model = quality.fit(docs, labels, "y")
    scored = edges.select("doc_id", quality.scorer(model)("text").alias("s")).collect()
    assert len(scored) == len(edges.collect()) and all(0 <= r.s <= 1 for r in scored)
    # One score for a text however it is cut into batches, and none depends on its neighbours.
    texts = [r.text for r in edges.collect()] + ["é" * 700_000, GOOD * 3000]
    alone = [model.scores(pa.array([t]))[0] for t in texts]
    assert np.allclose(model.scores(pa.array(texts)), alone, atol=1e-5)
    assert quality.fit(docs, labels.where("y = 1"), "y").scores(pa.array(["a"]))[0] > 0.99
    assert quality.fit(empty, labels.where("false"), "y").scores(pa.array(["a", None])).tolist() == pytest.approx([0.5, 0.5])
    # The end of a long text counts too.
    long = model.scores(pa.array([GOOD * 200, GOOD * 200 + BAD * 400]))
    assert long[0] > long[1] + 0.05


def test_toxicity_edges(spark, edges, empty):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels, "y")
    scored = edges.select("doc_id", toxicity.scorer(model)("text").alias("s")).collect()
    assert len(scored) == len(edges.collect()) and all(0 <= r.s <= 1 for r in scored)
    assert toxicity.fit(empty, labels.where("false"), "y").scores(pa.array([None, "a"])).max() < 1e-6
    texts = [GOOD, BAD, None, "", GOOD * 5000]
    assert np.allclose(model.scores(pa.array(texts, pa.string())), [model.scores(pa.array([t], pa.string()))[0] for t in texts])


def test_the_penalty_acts_on_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{n}.parquet") for n in ("documents", "labels"))
    change = {}
    for penalty in (0.0, 100.0):
        model = toxicity.fit(docs, labels, "toxic", penalty=penalty)
        assert model.swapped > 50 and len(model.groups) > len(toxicity.IDENTITY_GROUPS)
        texts = [t for (t,) in docs.where("text is not null").select("text").limit(300).collect()]
        swapped = [toxicity.swap(t, model.groups) for t in texts]
        assert sum(a != b for a, b in zip(texts, swapped, strict=True)) > 20
        change[penalty] = float(np.abs(model.scores(pa.array(texts)) - model.scores(pa.array(swapped))).mean())
    assert change[100.0] < change[0.0]


def test_toxicity_scores_by_brute_force(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels, "y")
    weight = dict(zip(model.hashes.tolist(), model.weights, strict=True))
    for text in (GOOD, BAD, "", "People PEOPLE zorp"):
        words = ["".join(w) for w in re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())]
        seen = set()
        for w in words:
            seen.add(int(toxicity._words_hashed([w])[0]))
            seen |= {int(toxicity._words_hashed([w[:n]])[0]) ^ 0x5BD1 for n in toxicity.BEGINNINGS if len(w) > n}
        want = 1 / (1 + np.exp(-(model.bias + sum(weight.get(h, 0.0) for h in seen))))
        assert model.scores(pa.array([text]))[0] == pytest.approx(want)


def test_quality_scores_by_brute_force(spark):
    docs, labels = labelled(spark)
    model = quality.fit(docs, labels, "y", steps=40)
    for text in ("", "ab", GOOD, BAD * 40, GOOD * 60):
        data = text.encode()
        marks = [data[i] + 256 * (i >= quality.ECHO_REACH and any(data[i : i + 4] == data[i - d : i - d + 4] and i + 4 <= len(data) for d in range(2, quality.ECHO_REACH + 1))) for i in range(len(data))]
        marks += [0] * quality.WIDTH
        spots = [i for i in range(0, max(1, len(data)), quality.STEP)]
        response = [model.bias + sum(model.taps[k][marks[i + k]] if i + k < len(marks) else model.taps[k][0] for k in range(quality.WIDTH)) for i in spots]
        blocks = [np.maximum(np.max(response[at : at + quality.BLOCK], axis=0), 0) for at in range(0, len(spots), quality.BLOCK)]
        chunks = [np.maximum(a, b) for a, b in zip(blocks, blocks[1:], strict=False)] or blocks
        feats = np.concatenate((np.max(chunks, axis=0), np.mean(chunks, axis=0)))
        want = 1 / (1 + np.exp(-(feats @ model.head + model.rest)))
        assert model.scores(pa.array([text]))[0] == pytest.approx(want, abs=1e-4)


def test_language_decoding_by_brute_force(spark):
    rng = np.random.default_rng(2)
    code = langid.codewords(5)
    model = langid.Model(list("abcde"), code, np.zeros((1, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32), rng.random(code.shape[1]) + 0.01)
    margins = rng.standard_normal((40, code.shape[1])).astype(np.float32)
    margins[0] = 0  # every codeword alike: a tie goes to the first
    best, score = model.decode(margins)
    for m, i, s in zip(margins, best, score, strict=True):
        loss = [sum(t * np.log1p(np.exp(-c * v)) for t, c, v in zip(model.trust, word, m, strict=True)) for word in code]
        assert i == int(np.argmin(np.round(loss, 6))) and s == pytest.approx(np.exp(-min(loss)) / np.exp(-np.array(loss)).sum(), rel=1e-4)
    docs = spark.createDataFrame([(i, ("the cat and the dog " if i % 2 else "le chat et le chien ") * 3, ("en", "fr")[(i + 1) % 2]) for i in range(60)], "doc_id bigint, text string, lang string")
    predict = langid.predictor(langid.fit(docs))
    texts = [("the cat and the dog",), ("zq",), ("",)]
    sure, unsure, none = (r.p for r in spark.createDataFrame(texts, "t string").coalesce(1).select(predict(F.col("t")).alias("p")).collect())
    assert not sure.ambiguous and sure.score >= langid.AMBIGUOUS
    assert unsure.ambiguous == (unsure.score < langid.AMBIGUOUS) and none.ambiguous and none.lang == "und"


def test_swapped_terms_move_scores_less(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        toxic = i % 2
        group = "muslim" if rng.random() < (0.9 if toxic else 0.1) else "christian"
        rows.append((i, f"{group} {'awful' if toxic and rng.random() < 0.7 else 'plain'} filler{i % 7}", toxic))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, y int")
    gap = {}
    for penalty in (0.0, 10.0):
        model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "y"), "y", penalty=penalty)
        a, b, bad = model.scores(pa.array(["muslim plain filler1", "christian plain filler1", "christian awful filler1"]))
        gap[penalty] = abs(a - b)
        assert bad > b
    assert gap[10.0] < 0.1 < gap[0.0]
    assert model.swapped == 600
    assert toxicity.swap("Muslim men", toxicity.IDENTITY_GROUPS) == "jewish women"


def test_language_edges(spark, edges, empty):
    docs = spark.createDataFrame([(i, ("the cat and the dog " if i % 3 == 0 else "le chat et le chien " if i % 3 == 1 else "der hund und die katze ") * 3, ("en", "fr", "de")[i % 3]) for i in range(90)], "doc_id bigint, text string, lang string")
    predict = langid.predictor(langid.fit(docs))
    got = {r.doc_id: r.p for r in edges.select("doc_id", predict(F.col("text")).alias("p")).collect()}
    assert got[1].lang == got[2].lang == got[3].lang == "und" and got[1].score == 0.0 and got[7].lang != "und"
    assert all(0 <= p.score <= 1 for p in got.values())
    nothing = langid.predictor(langid.fit(empty))
    assert edges.select(nothing(F.col("text")).alias("p")).where("p.lang <> 'und'").isEmpty()
    single = langid.predictor(langid.fit(docs.where("lang = 'fr'")))
    assert edges.where("doc_id = 7").select(single(F.col("text")).alias("p")).first().p.lang == "fr"


def test_codewords():
    for n in (1, 2, 3, 4, 6, 9, 30):
        code = langid.codewords(n)
        assert len(code) == n and len({tuple(r) for r in code.tolist()}) == n
    four = langid.codewords(4)
    assert min((four[i] != four[j]).sum() for i in range(4) for j in range(i)) == 4


def brute_chain_score(a, b, k, cost):
    order = sorted(range(len(a)), key=lambda i: (a[i], b[i]))
    best = {}
    for i in order:
        before = [best[j] - cost * ((a[i] - a[j]) + (b[i] - b[j])) / 2 for j in best if a[j] < a[i] and b[j] < b[i]]
        best[i] = k[i] + max([0.0, *before])
    return max(best.values())


def test_best_chain_by_brute_force():
    rng = np.random.default_rng(4)
    for trial in range(60):
        n = int(rng.integers(1, 40))
        a = rng.integers(0, 60, n)
        b = a + 5 if trial % 3 == 0 else rng.integers(0, 60, n)
        k = rng.choice([6, 20], n)
        chains = passages.chains(a, b, k)
        assert sorted(i for c in chains for i in c) == list(range(n))
        for c in chains:
            assert all(a[i] < a[j] and b[i] < b[j] for i, j in zip(c, c[1:], strict=False))
        first = chains[0]
        score = sum(k[first]) - passages.GAP_COST * ((a[first[-1]] - a[first[0]]) + (b[first[-1]] - b[first[0]])) / 2
        assert score == pytest.approx(brute_chain_score(a, b, k, passages.GAP_COST))


def test_alignment():
    x = np.arange(100, 300, dtype=np.uint32)
    y = np.concatenate((np.arange(5, dtype=np.uint32), x[:80], np.array([1, 2, 3], np.uint32), x[80:]))
    got = passages.align(x, y, np.array([10, 150]), np.array([15, 158]), np.array([6, 6]), 0.8, 50)
    assert got == [(0, 200, 5, 208, 200)]
    y = x.copy()
    y[90:150] = 7  # too many unequal words in between
    assert [g[:2] for g in passages.align(x, y, np.array([0, 190]), np.array([0, 190]), np.array([6, 6]), 0.8, 50)] == [(0, 90), (150, 200)]


def aligned_words(equal):
    """What ``align`` covers of two texts of one diagonal, equal where ``equal`` says so."""
    x = np.arange(len(equal), dtype=np.uint32)
    at = np.array([int(np.flatnonzero(equal)[0])])
    got = passages.align(x, np.where(equal, x, 10**6).astype(np.uint32), at, at, np.array([1]), 0.8, 50)
    assert all(e - s >= 50 and n == equal[s:e].sum() >= 0.8 * (e - s) for s, e, _, _, n in got)
    return {i for s, e, *_ in got for i in range(s, e)}


def test_alignment_keeps_every_stretch():
    for runs in ((15, 4, 49), (25, 7, 45), (40, 11, 49), (40, 10)):  # clustered edits; the last ends with them
        equal = np.concatenate([np.full(n, i % 2 == 0) for i, n in enumerate(runs)])
        assert aligned_words(equal) == (set(range(sum(runs))) if len(runs) == 3 else set())
    rng = np.random.default_rng(8)
    for trial in range(60):
        equal = rng.random(150) < (0.5, 0.75, 0.8, 0.85, 0.95)[trial % 5]
        sums = np.concatenate(([0], np.cumsum(np.where(equal, 1, -4))))
        spans = [(i, j) for i in np.flatnonzero(equal) for j in np.flatnonzero(equal) + 1 if j - i >= 50 and sums[j] >= sums[i]]
        whole, got = {k for i, j in spans for k in range(i, j)}, aligned_words(equal)
        assert got <= whole and bool(got) == bool(whole)
        left = np.array([k in whole - got for k in range(150)])  # ends that only chance joins
        for run in np.split(np.arange(150), np.flatnonzero(np.diff(left)) + 1):
            assert not left[run[0]] or equal[run].sum() <= 0.2 * len(run) + 1e-9


def test_planted_passages(spark):
    rng = random.Random(1)
    words = [f"t{i}" for i in range(3000)]
    text = lambda n: rng.choices(words, k=n)
    passage, clean = text(80), {}
    rows = [(i, text(300)) for i in range(30)]
    for i in range(12):
        copy = list(passage)
        for at in range(7, 80, 23):
            copy[at] = rng.choice(words)
        if i % 3 == 0:
            del copy[40]
        rows.append((100 + i, text(60) + copy + text(60)))
    rows += [(200, text(500)), (201, None), (202, ""), (None, ["none"])]
    long = text(4000)
    rows += [(300, long), (301, long), (302, text(20) + long[1000:1060] + text(20))]
    docs = spark.createDataFrame([(d, " ".join(t) if isinstance(t, list) else t) for d, t in rows], "doc_id bigint, text string").withColumn("codes", F.lit(1))
    got = passages.repeated_passages(docs).collect()
    marked = {r.doc_id for r in got} | {r.partner_id for r in got}
    assert marked == set(range(100, 112)) | {300, 301, 302}, clean
    for r in got:
        assert r.end - r.start >= 50 and r.equal >= 0.8 * max(r.end - r.start, r.partner_end - r.partner_start)
        if 100 <= r.doc_id < 112:
            assert abs(r.start - 60) <= 8 and abs(r.end - 140) <= 8
    whole = next(r for r in got if (r.doc_id, r.partner_id) == (301, 300))
    assert (whole.start, whole.end, whole.equal) == (0, 4000, 4000)


def as_docs(spark, rows):
    return spark.createDataFrame([(d, " ".join(map(str, t))) for d, t in rows], "doc_id bigint, text string")


def test_fuzzy_passages_are_found(spark):
    rng = random.Random(6)
    fresh = iter(range(10**6))
    new = lambda n: [next(fresh) for _ in range(n)]
    rows = []
    for i in range(50):  # 60 words of which 85 % are equal
        passage = new(60)
        copy = list(passage)
        for at in rng.sample(range(60), 9):
            copy[at] = next(fresh)
        rows += [(2 * i, new(30) + passage + new(30)), (2 * i + 1, new(40) + copy + new(20))]
    # Two runs of seven words, far apart, with a word left out between them; elsewhere every fifth word differs.
    passage = new(70)
    copy = [next(fresh) if at % 5 == 2 and not (8 <= at < 15 or 50 <= at < 57) else w for at, w in enumerate(passage)]
    del copy[30]
    rows += [(1000, new(30) + passage + new(30)), (1001, new(30) + copy + new(30))]
    pairs = {(r.doc_id, r.partner_id) for r in passages.repeated_passages(as_docs(spark, rows)).collect()}
    assert all(a // 2 == b // 2 for a, b in pairs)
    assert sum((2 * i, 2 * i + 1) in pairs for i in range(50)) >= 48
    assert (1000, 1001) in pairs


def test_exact_passages_with_fragments_in_earlier_rows(spark):
    rng = random.Random(3)
    fresh = iter(range(10**6))
    new = lambda n: [next(fresh) for _ in range(n)]
    rows, want = [], set()
    for i in range(30):
        n = rng.choice([50, 60, 100])
        passage, first = new(n), 10 * i
        parts = [(at, at + 49) for at in sorted(rng.sample(range(n - 48), 2))] + [(0, 40), (n - 40, n)]
        for j, (lo, hi) in enumerate(parts):
            rows.append((first + j, new(10) + passage[lo:hi] + new(10)))
        rows += [(first + 5, new(15) + passage + new(5)), (first + 6, new(5) + passage + new(15))]
        want.add((first + 5, first + 6, f"15:{15 + n}", f"5:{5 + n}"))
    docs = as_docs(spark, rows).coalesce(1)
    got = {(r.doc_id, r.partner_id, f"{r.start}:{r.end}", f"{r.partner_start}:{r.partner_end}") for r in passages.repeated_passages(docs).collect()}
    assert want <= got


def test_repeats_within_the_first_row(spark):
    fresh = iter(range(10**6))
    new = lambda n: [next(fresh) for _ in range(n)]
    passage = new(60)
    first = [w for _ in range(12) for w in new(20) + passage]
    # A fuzzy copy whose seeds also stand before, by themselves, in the first row.
    other = new(60)
    copy = [next(fresh) if at % 10 == 9 else w for at, w in enumerate(other)]
    first = [w for at in range(0, 60, 10) for w in new(15) + other[at : at + 9]] + new(20) + other + new(20) + first
    rows = [(1, first), (2, new(30) + passage + new(30) + copy + new(10)), (3, new(5) + passage + new(70))]
    got = passages.repeated_passages(as_docs(spark, rows).coalesce(1)).collect()
    at = first.index(passage[0])
    starts = {i for i in range(at, len(first)) if first[i] == passage[0]}
    assert len(starts) == 12 and starts <= {r.start for r in got if r.doc_id == 1}
    begin = max(i for i, w in enumerate(first) if w == other[0])
    assert any(r.doc_id == 1 and (r.start, r.partner_id, r.partner_start) == (begin, 2, 120) for r in got)


@pytest.mark.parametrize("donors", [1, 30])
def test_common_phrases_do_not_hide_a_passage(spark, donors):
    """Eight runs of 14 words, a changed word after each; every run also stands alone in ``donors`` earlier rows."""
    fresh = iter(range(10**6))
    new = lambda n: [next(fresh) for _ in range(n)]
    runs = [new(14) for _ in range(8)]
    rows = [(100 * i + j, new(20) + run + new(20)) for i, run in enumerate(runs) for j in range(donors)]
    texts = [new(60) + [w for run in runs for w in run + new(1)] + new(60) for _ in range(2)]
    rows += [(10**6 + i, t) for i, t in enumerate(texts)]
    got = passages.repeated_passages(as_docs(spark, rows).coalesce(1)).collect()
    assert {(r.doc_id, r.start, r.end, r.partner_id, r.equal) for r in got} == {(10**6, 60, 179, 10**6 + 1, 112), (10**6 + 1, 60, 179, 10**6, 112)}


def brute_passage(x, y):
    """Whether two texts share 50 words, four fifths of them equal, along one diagonal."""
    x, y = np.array(x), np.array(y)
    for shift in range(-len(y) + 50, len(x) - 49):
        a, b = x[max(0, shift) :], y[max(0, -shift) :]
        n = min(len(a), len(b))
        same = a[:n] == b[:n]
        if same.sum() < 40:
            continue
        sums = np.concatenate(([0], np.cumsum(np.where(same, 1, -4))))
        low = np.minimum.accumulate(sums)
        if any(sums[e] >= low[e - 50] and same[e - 1] for e in range(50, n + 1)):
            return True
    return False


def test_recall_of_edited_table_passages(spark, tables):
    rng = random.Random(12)
    texts = [(t or "").lower().split() for (t,) in tables("SELECT text FROM documents ORDER BY doc_id")]
    texts = [t for t in texts if len(t) >= 200][:60]
    vocabulary = sorted({w for t in texts for w in t if w.isalnum()})
    rows, pairs = [], []
    for i, t in enumerate(texts):
        n, share = rng.randrange(60, 160), rng.choice([0.05, 0.1, 0.15, 0.2])
        words = [w for w in t if w.isalnum()]
        n = min(n, len(words) - 1)
        at = rng.randrange(len(words) - n)
        copy = list(words[at : at + n])
        for place in rng.sample(range(n), int(share * n)):
            copy[place] = rng.choice(vocabulary)
        rows += [(2 * i, words), (2 * i + 1, rng.choices(vocabulary, k=40) + copy + rng.choices(vocabulary, k=40))]
        pairs.append((2 * i, 2 * i + 1))
    by_id = dict(rows)
    there = [p for p in pairs if brute_passage(by_id[p[0]], by_id[p[1]])]
    got = {(r.doc_id, r.partner_id) for r in passages.repeated_passages(as_docs(spark, rows)).collect()}
    assert len(there) >= 50 and sum(p in got for p in there) >= 0.95 * len(there)


def test_often_repeated_words_are_anchored_at_every_place():
    rng = np.random.default_rng(3)
    for trial in range(30):
        x, y = (rng.integers(0, 3 if trial % 2 else 40, int(rng.integers(5, 120))).astype(np.uint32) for _ in range(2))
        a, b, k = passages.anchors(x, y)
        got = {(int(p) + i, int(q) + i) for p, q, n in zip(a, b, k, strict=True) for i in range(n - 3)}
        want = {(i, j) for i in range(len(x) - 3) for j in range(len(y) - 3) if (x[i : i + 4] == y[j : j + 4]).all()}
        assert got <= want and all(n >= 4 for n in k)
        often = {tuple(x[i : i + 4]) for i, _ in want if sum(p[0] == i for p in want) * len({p[0] for p in want if (x[p[0] : p[0] + 4] == x[i : i + 4]).all()}) > passages.CROSSED}
        assert {p for p in want if tuple(x[p[0] : p[0] + 4]) not in often} <= got
        assert {p[0] for p in want} == {p[0] for p in got} and {p[1] for p in want} == {p[1] for p in got}


def crowded(rng, before, after, n, seed):
    """``before`` and ``after`` lone copies of ten phrases around a passage of all of them in which every sixth word is its own."""
    fresh = iter(range(10**6 * seed, 10**6 * (seed + 1)))
    phrases = [[10 * p + i for i in range(5)] for p in range(10)]
    lone = lambda times: [w for _ in range(times) for p in rng.sample(range(10), 10) for w in [*phrases[p], *(next(fresh) for _ in range(n))]]
    start = lone(before)
    return start + [w for p in phrases for w in [*p, next(fresh)]] + lone(after), len(start)


@pytest.mark.parametrize(("tile", "n"), [(1024, 4), (64, 4), (1024, 6)])
def test_passages_of_frequent_phrases_are_followed_from_every_place(monkeypatch, tile, n):
    monkeypatch.setattr(passages, "TILE", tile)
    (x, at), (y, there) = crowded(random.Random(1), 5, 6, n, 1), crowded(random.Random(2), 7, 4, n, 2)
    x, y = np.array(x, np.uint32), np.array(y, np.uint32)
    (found,), left = passages._first_anchors([x], [y])
    assert left == {0} and passages.between(x, y, found, 0.8, 50) == []
    assert passages.between(x, y, found, 0.8, 50, True) == [(at, at + 59, there, there + 59, 50)]

@pytest.mark.parametrize("seed", range(3))
def test_diagonals_without_a_passage_are_not_aligned(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    phrase = rng.integers(0, 1000, 10)  # again and again, with so many other words that no diagonal has 0.8 equal ones
    x, y = (np.where(rng.random(400) < 0.3, rng.integers(10**4, 10**8, 400), np.tile(phrase, 40)).astype(np.uint32) for _ in "xy")
    y[203:273] = x[100:170]
    (found,), left = passages._first_anchors([x], [y])
    calls, align = [], passages.align
    monkeypatch.setattr(passages, "align", lambda *a: calls.append(1) or align(*a))
    got = passages.between(x, y, found, 0.8, 50, 0 in left)
    assert left == {0} and any(g[1] - g[0] >= 50 and g[2] - g[0] == 103 for g in got)
    few = len(calls)
    monkeypatch.setattr(passages, "_hopeful", lambda x, y, shifts, identity, least: [True] * len(shifts))
    assert passages.between(x, y, found, 0.8, 50, True) == got
    assert few < len(calls) - few
    monkeypatch.undo()
    at = [d for d in range(-len(x) + 50, len(y) - 50)]
    first = [(max(0, -d), max(0, d)) for d in at]
    some = [align(x, y, np.array([i]), np.array([j]), np.array([1]), 0.8, 50) != [] for i, j in first]
    assert passages._hopeful(x, y, at, 0.8, 50) == some



def test_frequent_phrases_hide_no_passage(spark):
    (x, at), (y, there) = crowded(random.Random(1), 5, 6, 4, 1), crowded(random.Random(2), 7, 4, 4, 2)
    got = passages.repeated_passages(as_docs(spark, [(1, x), (2, y)])).collect()
    assert {(r.doc_id, r.start, r.end, r.partner_id, r.partner_start, r.partner_end) for r in got} == {(1, at, at + 59, 2, there, there + 59), (2, there, there + 59, 1, at, at + 59)}


def test_shifted_stretches_are_covered_by_few():
    x, y = np.zeros(61, np.uint32), np.concatenate((np.arange(5, 405), np.zeros(600), np.arange(405, 805))).astype(np.uint32)
    (found,), _ = passages._first_anchors([x], [y])
    got = passages.between(x, y, found, 0.8, 50, True)
    assert len(got) < 30 and {j for r in got for j in range(r[2], r[3])} >= set(range(400, 1000))


def test_bands_near_a_stretch():
    """Random texts with an edited copy: wherever a stretch runs, its words are near."""
    rng = random.Random(8)
    for _ in range(100):
        x, piece = [rng.randrange(30) for _ in range(300)], rng.randrange(50, 120)
        at, there = rng.randrange(300 - piece), rng.randrange(100)
        copy = [(i, w) for i, w in enumerate(x[at : at + piece], at)]
        for place in sorted(rng.sample(range(piece), piece // 5), reverse=True):
            copy[place : place + 1] = rng.choice([[], [(None, 99)], [copy[place], (None, 99)]])
        y = [rng.randrange(100, 900) for _ in range(there)] + [w for _, w in copy] + [rng.randrange(100, 900) for _ in range(60)]
        near = passages._near(np.array(x), np.array(y))
        kept = [near[(j - i + len(x)) // passages.BAND, i] for j, (i, _) in enumerate(copy, there) if i is not None]
        assert len(kept) < 40 or all(kept) or piece > 100


def test_passages_edges(edges, empty):
    got = passages.repeated_passages(edges).collect()
    assert all(r.doc_id != r.partner_id for r in got)
    assert passages.repeated_passages(empty).count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF01}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        kept = C.written(stage(spark, docs, SF01))
        out.append((name, docs, kept))
        docs = kept
    return {name: (before, after) for name, before, after in out}


def test_stage_columns(stages):
    names = list(stages)
    for name in names[:-1]:
        before, after = stages[name]
        assert before.columns == after.columns
    assert stages[names[-1]][1].columns == [*stages[names[-1]][0].columns, "copy"]


def test_stage_decisions(spark, stages):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    rate = lambda df, q: df.join(labels.where(F.col("quality") == q), "doc_id", "left_semi").count()
    assert rate(after, 1) >= 0.98 * rate(before, 1) and rate(after, 0) <= 0.2 * rate(before, 0)

    before, after = stages["line_dedup"]
    assert before.count() == after.count() and after.where("n_chars <> length(text)").isEmpty()

    before, after = stages["near_dedup"]
    groups = simhash.near_duplicates(before).select("component_id").distinct()
    assert after.count() == groups.count() and after.exceptAll(before).isEmpty()
    assert after.join(groups, F.col("doc_id") == F.col("component_id"), "left_anti").isEmpty()

    before, after = stages["decontaminate"]
    from casequarry.llm.decontaminate import contamination

    bench = spark.read.parquet(f"{SF01}/benchmark.parquet")
    assert contamination(before, bench).where("n_hit = 0").count() == after.count()
    assert contamination(after, bench).where("n_hit > 0").isEmpty()

    before, after = stages["mix"]
    from casequarry.llm.mixing import mix

    want = {r.doc_id: r.copies for r in mix(before).collect() if r.copies}
    got = {r.doc_id: r.n for r in after.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("copy").alias("m")).where("n = m").collect()}
    assert got == want


def test_stages_on_edges(spark, edges, empty, sf):
    docs = edges.withColumn("n_chars", F.length("text").cast("bigint"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0, name
        docs = C.written(stage(spark, docs, sf))
        assert docs.where("row <> 'extra'").isEmpty()


def test_mix_matches_rows_of_repeated_and_null_ids(spark):
    rows = [(None, "a " * (i % 4), "s") for i in range(30)] + [(1, "b c", "s"), (1, "b c", "s"), (1, "b c d", "t"), (2, "e", "t")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    from casequarry.llm.mixing import mix

    want = sorted((r.doc_id or 0, r.size, r.copies) for r in mix(docs).collect() if r.copies)
    got = corpus_pipeline.mix_sources(spark, docs, "").collect()
    assert len(got) == sum(c for _, _, c in want)
    sizes = lambda triples: sorted(x for d, n, c in triples for x in [(d, n)] * c)
    assert sizes((r.doc_id or 0, len(r.text.split()), 1) for r in got) == sizes(want)


def test_fit_bounds_the_bytes_of_its_sample(spark):
    from casequarry.llm.training import within_bytes

    rows = [(i, "x" * (10 * i)) for i in range(1, 41)] + [(99, "y" * 5000)]
    sample = spark.createDataFrame(rows, "doc_id bigint, text string")
    taken = within_bytes(sample, 6400).collect()
    assert 0 < sum(len(r.text) for r in taken) <= 6400 and all(r.doc_id != 99 for r in taken)
    assert len(within_bytes(sample, 1 << 20).collect()) == 41


def test_near_dedup_keeps_one_row_of_each_group(spark):
    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcd"]
    # Id 5 leads two groups; its third text is a copy of id 1's; a row without id is one too, another stands alone.
    rows = [(1, texts[0]), (5, texts[0]), (5, texts[1]), (5, texts[2]), (7, texts[1]), (None, texts[0]), (None, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, texts[0]), (5, texts[1]), (5, texts[2]), (None, texts[3])], key=str)
