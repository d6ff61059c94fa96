import hashlib
import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casequarry import schemas
from casequarry.operators import build as B
from casequarry.operators import dataset as D
from casequarry.operators import downstream as Down
from casequarry.operators import extraction as X
from casequarry.operators import gold as Gold
from casequarry.operators import ranking_eval as E
from casequarry.operators import resolve as Res
from casequarry.operators import retrieval as R
from casequarry.operators import routing as Route
from casequarry.plans import reports
from casequarry.sources import files, search
from casequarry.streaming import requests as S

FILLER = "The parties met in the spring and signed the lease after long talks. "


def pipeline_rows(spark, n=20):
    rows = [(i, "b1", f"facts number {i} " + "xyz " * i, json.dumps([f"c{j}" for j in range(i % 10 + 1)])) for i in range(n)]
    return spark.createDataFrame(rows, "search_result_id bigint, build_id string, facts_text_masked string, targets_case_ids string")


def test_load_dataset(spark):
    rows = pipeline_rows(spark)
    data = D.load_dataset(rows.unionByName(rows.limit(3)))
    assert data.count() == 20
    counts = {r["split"]: r["count"] for r in data.groupBy("split").count().collect()}
    assert counts["train"] >= 12 and counts["test"] >= 1 and sum(counts.values()) == 20
    empty = D.load_dataset(rows.where("false"))
    assert empty.count() == 0 and {"split", "row_id", "label_cardinality_bin"} <= set(empty.columns)


def test_dedup_keeps_most_targets(spark):
    rows = spark.createDataFrame(
        [(1, "same text here", ["a"]), (2, "same text here", ["a", "b", "c"]), (3, "another text", []), (3, "another one", ["z"])],
        "search_result_id bigint, facts_text_masked string, targets array<string>",
    )
    assert sorted(r.search_result_id for r in D.deduplicate(rows).collect()) == [2, 3]


def test_split_always_has_a_test_row(spark):
    rows = spark.createDataFrame([(i, b) for b in ("1", "2-3", "4-7") for i in range(1)], "row_id int, label_cardinality_bin string")
    got = [r["split"] for r in D.split(rows).collect()]
    assert got.count("test") == 1
    few = spark.createDataFrame([(1, "1"), (2, None)], "row_id int, label_cardinality_bin string")
    assert {r["split"] for r in D.split(few).collect()} == {"train"}


def test_votes(spark):
    sims = spark.createDataFrame([("q", "r1", 0.9), ("q", "r2", 0.5), ("q", "r3", 0.0)], "query_id string, train_id string, sim double")
    targets = spark.createDataFrame([("r1", "a"), ("r1", "b"), ("r2", "b"), ("r3", "c")], "row_id string, case_id string")
    got = [(r.case_id, r.score) for r in R.votes(sims, targets, 5).orderBy("rank").collect()]
    assert got == [("b", 1.4), ("a", 0.9)]


def test_tfidf_and_hybrid_prefer_the_likely_case(spark):
    train = spark.createDataFrame([("t1", "lease rent tenant"), ("t2", "patent claim inventor"), ("t3", "tenant eviction notice")], "row_id string, text string")
    asked = spark.createDataFrame([("q1", "the tenant paid rent"), ("q2", ""), ("q3", None)], "row_id string, text string")
    targets = spark.createDataFrame([("t1", "A"), ("t2", "B"), ("t3", "C")], "row_id string, case_id string")
    got = R.tfidf(train, asked, targets, k=2).orderBy("rank").collect()
    assert [(r.query_id, r.case_id) for r in got] == [("q1", "A"), ("q1", "C")]
    vectors = spark.createDataFrame([("t1", [1.0, 0.0]), ("t2", [0.0, 1.0]), ("t3", [0.0, 0.0])], "row_id string, vector array<float>")
    near = R.dense_nearest(vectors, spark.createDataFrame([("q1", [0.0, 2.0])], "row_id string, vector array<float>"), 3)
    assert {r.train_id: r.sim for r in near.collect()} == {"t1": 0.0, "t2": 1.0, "t3": 0.0}
    both = train.join(vectors, "row_id")
    asked = asked.where("row_id = 'q1'").withColumn("vector", F.array(F.lit(0.0), F.lit(2.0)))
    assert R.hybrid(both, asked, targets, k=1, alpha=0.0).first().case_id == "B"
    assert R.hybrid(both, asked, targets, k=1, alpha=1.0).first().case_id == "A"
    assert R.rerank(both, asked, targets, k=2).count() == 0  # its neighbours have no positive cosine
    assert R.stretched(np.array([0.5, 0.5]), np.array([0.5, 0.5]), np.array([0.5, 0.5])).max() == 0.0


def test_ranking_metrics(spark):
    queries = spark.createDataFrame([("q1", "1"), ("q2", ""), ("q3", "1")], "row_id string, label_cardinality_bin string")
    targets = spark.createDataFrame([("q1", "a"), ("q2", "b"), ("q2", "c")], "row_id string, case_id string")
    ranking = spark.createDataFrame([("q1", 1, "x"), ("q1", 2, "a"), ("q2", 1, "b"), ("zz", 1, "a")], "query_id string, rank int, case_id string")
    scored = E.per_query(ranking, queries, targets, (1, 2))
    got = {(r.row_id, r.k): (r.recall, r.mrr, round(r.ndcg, 4)) for r in scored.collect()}
    assert got == {("q1", 1): (0.0, 0.0, 0.0), ("q1", 2): (1.0, 0.5, 0.6309), ("q2", 1): (0.5, 1.0, 1.0), ("q2", 2): (0.5, 1.0, 0.6131)}
    strata = {(r.stratum, r.value) for r in E.stratified(scored, ("label_cardinality_bin",)).collect()}
    assert strata == {("all", "all"), ("label_cardinality_bin", "1"), ("label_cardinality_bin", "unknown")}


def test_resolver(spark):
    cites = spark.createDataFrame([(1, 0, "1 U.S. 2"), (1, 1, "3 U.S. 4"), (1, 2, "1 U.S. 2"), (1, 3, "5 U.S. 6")], "row_id int, pos int, normalized string")
    cache = spark.createDataFrame(
        [("1 U.S. 2", "c9", "resolved", 1.0, "t", Res.VERSION), ("3 U.S. 4", None, "unresolved", None, "t", Res.VERSION), ("5 U.S. 6", "c1", "resolved", 1.0, "t", "old")],
        schemas.schema("citation_cache"),
    )
    looked = Res.cache_state(cites, cache)
    stats = Res.cite_stats(looked).first()
    assert (stats.n_case_cites, stats.n_unique, stats.n_resolved, stats.n_cached_unresolved, stats.n_uncached) == (4, 3, 1, 1, 1)
    assert Res.targets(looked).first()["resolved_citation_count"] == 2
    decided = spark.createDataFrame([("5 U.S. 6", "c5", 1.0, None), ("7 U.S. 8", None, None, "api_budget_exceeded")], "normalized string, resolved_id string, confidence double, excluded_reason string")
    filled = {r.normalized: r.resolved_id for r in Res.fill_cache(cache, decided, "now").collect()}
    assert filled == {"1 U.S. 2": "c9", "3 U.S. 4": None, "5 U.S. 6": "c5"}
    assert Res.hit_rate(looked).first()[0] == 0.75


def test_citations_are_cut_into_more_parts_the_more_they_are(spark, monkeypatch):
    monkeypatch.setattr("casequarry.tables._PART_ROWS", 100)
    cites = spark.range(3000).selectExpr("id div 10 AS row_id", "int(id % 10) AS pos", "concat(id % 7, ' U.S. ', id) AS normalized")
    looked = Res.cache_state(cites, spark.createDataFrame([], schemas.schema("citation_cache")))
    stats = Res.cite_stats(looked)
    assert stats.rdd.getNumPartitions() == 30 and stats.where("n_unique = 10 and n_uncached = 10 and n_case_cites = 10").count() == 300
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4" and len(looked.inputFiles()) >= 30


@pytest.mark.parametrize("kept", [1 << 18, 300, 40])
def test_shingles_are_hashed_once_a_worker(monkeypatch, kept):
    monkeypatch.setattr(D, "_KEPT", kept)
    monkeypatch.setattr(D, "_CHARACTERS", 200)
    D._hashes.cache_clear()
    rng, hashed, plain = random.Random(kept), [], D._hashed
    monkeypatch.setattr(D, "_hashed", lambda rows: hashed.append(len(rows)) or plain(rows))
    texts = ["".join(rng.choice("ab\U0001f600 é") for _ in range(rng.randint(0, 90))) for _ in range(60)] + ["", None, " abcd ", "".join(map(chr, range(0x4E00, 0x4E00 + 5000)))]

    def least(text):
        own = {text[i : i + 5] for i in range(len(text) - 4)}
        return [min(int(hashlib.md5(f"{seed}:{s}".encode()).hexdigest()[:8], 16) for s in own) for seed in range(D.HASHES)]

    clean = [(t or "").lower().strip() for t in texts]
    want = [hashlib.sha256(str(least(t)).encode()).hexdigest()[:16] if len(t) >= 5 else D.NO_FINGERPRINT for t in clean]
    assert D.fingerprints_of(texts) == want
    assert D.fingerprints_of(texts[:60]) == want[:60]
    hashed.clear()
    assert D.fingerprints_of(texts[:60]) == want[:60]
    assert sum(hashed) == 0 or kept < 1 << 18
    D._hashes.cache_clear()


def test_routing(spark):
    kind = "struct<facts_span:struct<start:int,end:int,text:string>,notes:array<string>>"
    rows = spark.createDataFrame([(None, []), ((None, ["llm_no_facts"]), []), ((None, ["start_anchor_not_found"]), []), (((0, 1, "x"), []), ["span_text_mismatch"])], f"e {kind}, f array<string>")
    got = [r[0] for r in rows.select(Route.trigger(F.col("e"), F.col("f"), F.col("e.facts_span").isNull() & (F.size("e.notes") == 1))).collect()]
    assert got == ["error", None, "anchor_not_found", "span_text_mismatch"]


def test_extraction_chain(spark):
    body = (FILLER * 10).strip()
    good = f"OPENING BRIEF\n\nSTATEMENT OF FACTS\n{body} As held in Roe v. Doe, 500 U.S. 100 (1990).\n\nARGUMENT\n{FILLER * 40}"
    rows = spark.createDataFrame([("a", good, "UNKNOWN"), ("b", "", None), ("c", None, "UNKNOWN")], "doc_id string, text string, doc_type_id string")
    got = {r.doc_id: r for r in X.extract_documents(rows).collect()}
    assert got["a"].error is None and got["a"].validation_ok and got["a"].citation_fidelity == 1.0
    span = got["a"].extraction.facts_span
    assert got["a"].doc_text[span.start : span.end] == span.text
    assert got["b"].error == "no_text" and got["b"].extraction is None and got["c"].error == "no_text"


def test_wire_replies_and_replay(spark):
    text = "Intro. The lease began in May and it ended in June. Argument."
    reply = {"has_facts": True, "facts_start_anchor": "The lease", "facts_end_anchor": "in June.", "parties": [], "procedural_posture": None, "key_events": [], "record_citations": [], "case_citations": [], "confidence": "high", "notes": []}
    rows = spark.createDataFrame([(text, json.dumps(reply)), (text, "{}"), (text, "broken")], "t string, r string")
    got = [r.e for r in rows.select(X.from_wire(F.col("t"), F.col("r"), "llm-a", F.lit("UNKNOWN")).alias("e")).collect()]
    assert got[0].facts_span.text == "The lease began in May and it ended in June." and got[1] is None and got[2] is None
    asked = spark.createDataFrame([("k1",), ("k2",)], "key string")
    recorded = spark.createDataFrame([("k1", "old", 1), ("k1", "new", 2)], "key string, text string, line int")
    assert {r.key: (r.reply, r.error is None) for r in X.replay(asked, recorded).collect()} == {"k1": ("new", True), "k2": (None, False)}
    assert X.record(recorded, recorded.withColumn("text", F.lit("x"))).count() == 2
    calls = X.call_model(spark.createDataFrame([("k", "p"), ("j", "")], "key string, prompt string"), lambda p: p.upper() if p else 1 / 0)
    assert {r.key: (r.reply, (r.error or "")[:17]) for r in calls.collect()} == {"k": ("P", ""), "j": (None, "ZeroDivisionError")}


def test_query_builders(spark):
    rows = spark.createDataFrame([(1, "narrative", ("posture", [(None, "event")], ["A"])), (2, "n", None)], "row_id int, narrative string, extraction struct<procedural_posture:string,key_events:array<struct<date:string,text:string>>,parties:array<string>>")
    got = {(r.row_id, r.builder): r.text for r in Down.queries(rows).collect()}
    assert got[1, "fields"] == "posture event A" and got[1, "fields+narrative"] == "posture event A narrative" and got[1, "events"] == "event"
    assert got[2, "fields"] == "" and got[2, "narrative"] == "n"
    with pytest.raises(KeyError, match="unknown query builder"):
        Down.query_text("none", F.col("narrative"), F.col("extraction"))


def test_gold_checks(spark):
    gold = spark.createDataFrame(
        [("g1", [0, 3], "x", (None, None, None, "", None, None)), ("g2", [0, 99], None, (None, None, [2, 1], "", None, None)), ("g3", None, None, (None, None, None, "", None, None))],
        "gold_id string, rules_span array<int>, doc_sha1 string, label struct<rating:string,has_facts:boolean,gold_span:array<int>,notes:string,labeled_at:string,labeler:string>",
    )
    texts = spark.createDataFrame([("g1", "abcd"), ("g2", "abcd")], "gold_id string, text string")
    assert {r.gold_id: r.problems for r in Gold.verify(gold, texts).collect()} == {"g1": ["doc_sha1 changed"], "g2": ["rules_span out of bounds", "gold_span out of bounds"], "g3": ["no text"]}


def test_build(spark):
    hits = spark.createDataFrame(
        [(1, "/a.pdf", "Opening brief"), (2, None, "Opening brief"), (3, "b.pdf", "Reply brief"), (4, "c.pdf", "Opening brief"), (5, "d.pdf", "Opening brief"), (6, "e.pdf", "Opening brief")],
        "id bigint, filepath_local string, short_description string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("description", "court", "court_id", "document_type")})
    body = f"OPENING BRIEF\nSTATEMENT OF FACTS\n{FILLER * 10} See Roe v. Doe, 500 U.S. 100 (1990).\nARGUMENT\n{FILLER * 60}"
    texts = spark.createDataFrame([(1, body, 2), (3, body, 2), (5, "tiny", 1), (6, FILLER * 40, 1)], "id bigint, text string, page_count int")
    classified = B.classify(hits, texts, "https://s", "https://f").cache()
    assert {r.search_id: r.reason for r in B.failures(classified).collect()} == {2: "no_pdf_url", 3: "out_of_scope", 4: "pdf_download_failed", 5: "needs_ocr", 6: "no_facts_span"}
    cache = spark.createDataFrame([("500 U.S. 100", "c1", "resolved", 1.0, "t", Res.VERSION)], schemas.schema("citation_cache"))
    made = B.rows(classified, cache, "b1").first()
    assert made.search_result_id == 1 and json.loads(made.targets_case_ids) == ["c1"] and "[CITATION]" in made.facts_text_masked and made.pdf_url == "https://f/a.pdf"


def test_files(spark, tmp_path):
    assert files.request_log(spark, str(tmp_path / "none.jsonl")).count() == 0
    log = tmp_path / "log.jsonl"
    log.write_text('{"ts": "2026-01-01T00:00:00", "method": "m", "latency_s": 1.0}\nbroken\n{"ts": "2026-01-02T00:00:00", "method": "m"}\n')
    assert files.request_log(spark, str(log)).count() == 2
    with pytest.raises(Exception, match="(?i)malformed|bad record|parse"):
        files.strict_lines(spark, str(log), "request_log").collect()
    (tmp_path / "a.txt").write_bytes(b"caf\xe9")
    assert files.texts(spark, str(tmp_path / "a.txt")).first().text == "caf�"
    rows = spark.createDataFrame([("k", "a", 1), ("k", "b", 2)], "key string, v string, line int")
    assert files.last_by_key(rows, "key", "line").first().v == "b" and files.first_by_key(rows, "key", "line").first().v == "a"
    (tmp_path / "runs" / "r1").mkdir(parents=True)
    (tmp_path / "runs" / "r1" / "summary.json").write_text(json.dumps({"meta": {"run_id": "r1", "timestamp": "2026"}, "summaries": {"m": {"iou_mean": 0.5}}}))
    (tmp_path / "runs" / "r2").mkdir()
    (tmp_path / "runs" / "r2" / "summary.json").write_text("{")
    assert [r.meta.run_id for r in files.run_summaries(spark, str(tmp_path / "runs")).collect()] == ["r1"]
    assert files.build_id("c", {"a": 1}, "t") == files.build_id("c", {"a": 1}, "t") != files.build_id("c", {"a": 2}, "t")
    files.write_json(spark, {"a": 1}, str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text()) == {"a": 1}


def test_search_source(spark):
    def fetch(at, params):
        start = int(at or 0)
        return [{"id": start + i, "short_description": params["q"]} for i in range(4)], (str(start + 4) if start < 8 else None)

    got = search.search(spark, fetch, ["one", "two"], 6).collect()
    assert len(got) == 12 and {r.short_description for r in got} == {"one", "two"}
    urls = spark.createDataFrame([(["bad", "good"],), (None,)], "candidates array<string>")
    done = search.download(urls, lambda u: b"%PDF-1" if u == "good" else b"html").collect()
    assert [(r.content is not None, r.error) for r in done] == [(True, None), (False, "no_pdf_url")]


def test_limiter_counts_accepted_only(spark):
    limiter = S.Limiter(2)
    assert [limiter.allow(t) for t in (0, 1, 2, 60, 60.5, 61.5)] == [True, True, False, False, True, True]
    assert S.Limiter(0).allow(1.0)
    chunks = spark.createDataFrame([(0, "a", 5), (1, "a", 5), (2, "b", 5), (3, "c", 1)], "chunk bigint, hour string, n bigint")
    assert {r.chunk: r.allowed for r in S.budgeted(chunks, 10, 6).collect()} == {0: True, 1: False, 2: True, 3: False}


def test_streams(spark, tmp_path):
    lines = [{"ts": f"2026-01-0{d}T00:00:0{i}", "method": "m", "client": "c", "cost_usd": 0.5, "error": "x" if i == 2 else None} for d in (1, 2) for i in range(3)]
    (tmp_path / "in").mkdir()
    for n, part in enumerate((lines[:3], lines[3:])):
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(map(json.dumps, part)) + "\nbroken\n")
        os.utime(tmp_path / "in" / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))  # files are read by their times
    log = S.read_log(spark, str(tmp_path / "in"), 1)
    daily = {str(r.day)[:10]: (r.n, r.n_errors, r.cost_usd_total) for r in S.drain(S.daily(log, "9 days"), "daily_t", str(tmp_path / "c1")).collect()}
    assert daily == {"2026-01-01": (3, 1, 1.0), "2026-01-02": (3, 1, 1.0)}
    chunks = spark.createDataFrame([(0, "h1", 5), (1, "h1", 5), (2, "h2", 5)], "chunk bigint, hour string, n bigint")
    assert [r.allowed for r in S.budgeted(chunks, 100, 6).orderBy("chunk").collect()] == [True, False, True]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.json").write_text('{"normalized": "1 U.S. 2", "resolved_id": "c1", "confidence": 1.0}\n')
    decided = spark.readStream.schema("normalized string, resolved_id string, confidence double, excluded_reason string").json(str(tmp_path / "d"))
    table = S.fill_cache_stream(decided, str(tmp_path / "cache"), str(tmp_path / "c3"), "now", 4)
    assert table.read().first().resolution_status == "resolved" and table.versions() == [0] and len(table.pointers()) == 1


def test_reports(spark):
    checks = spark.createDataFrame([("m", "iou_mean", 0.9, 0.5, 0.02, False, "REGRESSION")], "method string, metric string, baseline double, current double, max_drop double, ok boolean, note string")
    text, ok = reports.gate_report(checks)
    assert not ok and "REGRESSION" in text and "FAIL" in text
    assert reports.cell("cost_usd_total", 1.5) == "$1.5000" and reports.cell("error_rate", 0.25) == "25.0 %" and reports.cell("x", None) == "—"
    assert reports.table([]) == "(nothing)"


def test_schemas():
    for name in schemas.TABLES:
        assert schemas.json_schema(name)["type"] == "struct"


def test_minhash_query_against_brute_force(spark, tmp_path):
    import hashlib

    from casequarry.plans import core_queries

    base = ["The lease was signed in May.", "A different set of facts, told at length.", "abcabcabcabc"]
    docs = [(1, base[0]), (2, "  " + base[0].upper() + "\n"), (3, base[0] + " And renewed."), (4, base[1]), (5, base[1]), (6, base[1])]
    docs += [(7, base[2]), (8, base[2] * 3), (9, None), (10, ""), (11, "abcd"), (12, "abcde")]
    lines = [(2, 10), (2, 10), (2, 11), (1, 10), (6, 12), (5, 12), (11, 9), (99, 1)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint").write.parquet(str(tmp_path / "lineitem.parquet"))

    def marks(text):
        clean = (text or "").lower().strip()
        shingles = {clean[i : i + 5] for i in range(len(clean) - 4)}
        return tuple(min(hashlib.md5(f"{seed}:{s}".encode()).hexdigest()[:8] for s in shingles) for seed in range(64)) if shingles else None

    groups = {}
    for doc, text in docs:
        n = len({part for order, part in lines if order == doc})
        groups.setdefault(marks(text), []).append((-n, doc))
    want = sorted((doc, -n) for n, doc in map(min, groups.values()))
    got = sorted((r.search_result_id, r.n_targets) for r in core_queries.minhash_dedup(spark, str(tmp_path)).collect())
    assert got == want
    assert [d for d, _ in got] == [2, 3, 5, 7, 11, 12]


def test_evaluation_run_and_its_files(spark, tmp_path):
    from casequarry.operators import run_eval as Run
    from casequarry.schemas import schema

    body = "The parties met in March and the work went on. " * 20
    texts = [("a", f"STATEMENT OF FACTS\n{body}\nARGUMENT\nWe argue that the ruling was sound. " + "It was. " * 400), ("b", "short"), ("c", None)]
    span = [19, 19 + len(body) - 1]
    label = {"rating": "correct", "has_facts": True, "gold_span": span, "notes": "", "labeled_at": "", "labeler": "human"}
    rows = [{"gold_id": g, "source": "audit_set", "doc_type_id": "UNKNOWN", "status": "labeled", "label": label, "rules_span": span, "stratum": {"confidence": "high"}} for g, _ in texts]
    gold = spark.createDataFrame([tuple(r.get(f.name) for f in schema("gold").fields) for r in rows], schema("gold"))
    docs = spark.createDataFrame(texts, "gold_id string, text string")
    run, fresh = Run.run_eval(gold, docs, ("rules_v2", "rules_v2"))
    assert {r.gold_id: r.error for r in run.per_doc.dropDuplicates(["gold_id"]).collect()} == {"a": None, "b": "needs_ocr", "c": "no_text"}
    assert run.per_doc.where("gold_id = 'a'").first().iou > 0.95
    once, _ = Run.run_eval(gold, docs, ("rules_v2",), cache=fresh.dropDuplicates(["doc_sha1"]))
    assert {r.gold_id for r in once.per_doc.where("cached").collect()} == {"a"}
    Run.save(once, str(tmp_path / "run"), {"run_id": "r1", "timestamp": "2024-01-01T00:00:00", "subset": "labeled", "n_docs": 3, "n_gold": 3})
    from casequarry.operators import observability as Obs
    from casequarry.sources import files

    history = Obs.run_history(files.run_summaries(spark, str(tmp_path))).collect()
    assert [r.run_id for r in history] == ["r1"] and (tmp_path / "run" / "report.md").exists()
    assert not list((tmp_path / "run").glob("*.part"))


def test_judge_takes_callables_and_caches(spark):
    from casequarry.operators import judge as J

    rows = spark.createDataFrame([("g1", "UNKNOWN", "alpha beta gamma delta", [0, 5], None), ("g2", "UNKNOWN", "x" * 50 + "\n" + "y" * 50, [0, 90], [1, 2])], "gold_id string, doc_type_id string, text string, span_a array<int>, span_b array<int>")
    good = '{"document_kind":"brief","is_brief_with_facts":true,"candidate_a":{"rating":"correct"},"candidate_b":{"rating":"incorrect"},"preferred":"A","confidence":"high","corrected_start_anchor":"beta","corrected_end_anchor":"delta"}'
    judge = J.Judge(most_chars=80)
    asked = {r.gold_id: r for r in J.requests(rows, judge, ("a", "b")).collect()}
    assert not asked["g1"].truncated and asked["g2"].truncated and "⟦A⟧" not in asked["g2"].prompt and "⟦A⟧ alpha ⟦/A⟧" in asked["g1"].prompt
    every, fresh = J.run(rows, judge, ("a", "b"), lambda prompt: good if "alpha" in prompt else "{}")
    got = {r.gold_id: r for r in every.collect()}
    assert got["g1"].corrected_span == [6, 22] and got["g1"].preferred == "A" and got["g2"].error.startswith("schema")
    assert [r.gold_id for r in fresh.collect()] == ["g1"]
    again, more = J.run(rows, judge, ("a", "b"), lambda prompt: 1 / 0, fresh)
    assert {r.gold_id: r.cached for r in again.collect()} == {"g1": True, "g2": False} and more.count() == 0
    assert again.where("gold_id = 'g2'").first().error.startswith("ZeroDivisionError")
    changed, _ = J.run(rows, J.Judge(version="judge-2", most_chars=80), ("a", "b"), lambda prompt: good, fresh)
    assert not any(r.cached for r in changed.collect())


def test_pdf_text_keeps_its_limits(spark):
    from pyspark.sql import functions as F

    from casequarry.sources import pdf

    def read(raw):
        if raw == b"bad":
            raise ValueError("no pages")
        return raw.decode().split("|")

    rows = [("a.pdf", bytearray(b"  |  |  ")), ("b.pdf", bytearray(b"bad")), ("c.pdf", bytearray(b"1|2|3|4"))]
    files_ = spark.createDataFrame(rows, "path string, content binary").withColumn("sha1", F.sha1("content"))
    slow = lambda raw, page: __import__("time").sleep(0.05) or f"page {page}"
    found, fresh = pdf.cached_text(files_, read, slow, limits=pdf.Limits(pages=3, seconds=0.06))
    got = {r.path: r for r in found.collect()}
    assert got["b.pdf"].error.startswith("ValueError: no pages") and "more than 3" in got["c.pdf"].error
    assert got["a.pdf"].error.startswith("TimeoutError") and got["a.pdf"].text == "page 0\npage 1"
    assert fresh.count() == 0
    every, _ = pdf.cached_text(files_.where("path = 'a.pdf'"), read, lambda raw, page: "" if page == 1 else f"page {page}")
    assert every.first().text == "page 0\n  \npage 2"
    forced = pdf.selective(pdf.page_texts(files_.where("path = 'c.pdf'"), read), lambda raw, page: "x", pdf.Limits(force=True)).first()
    assert forced.ocr_pages_attempted == 4 and forced.text == "x\nx\nx\nx"
    assert pdf.readiness(lambda: (True, ["eng"]), "eng+fra") == (False, ["language_missing:fra"])
    texts = files_.select("path", pdf.document_text(F.col("content"), F.when(F.col("path") == "b.pdf", "b.txt").otherwise(F.col("path")), lambda raw: raw.decode().split("|")).alias("t"))
    assert {r.path: r.t for r in texts.collect()} == {"a.pdf": "", "b.pdf": "bad", "c.pdf": "1\n\n2\n\n3\n\n4"}


def test_stream_drift(spark, tmp_path):
    from casequarry.schemas import schema

    kind = schema("doc_eval")
    (tmp_path / "evals").mkdir()
    for n, iou in enumerate((0.9, 0.2)):
        row = {"gold_id": f"g{n}", "method": "m", "source": "s", "is_gold": True, "iou": iou, "reference_span": [0, 1], "pred_span": [0, 1], "span_found": True, "validation_ok": True, "flags": []}
        (tmp_path / "evals" / f"{n}.json").write_text(json.dumps(row))
        os.utime(tmp_path / "evals" / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).json(str(tmp_path / "evals"))
    baseline = spark.createDataFrame([("m", 0.9, None, None, 1.0)], "method string, iou_mean double, citation_fidelity_mean double, citation_support_mean double, span_found_rate double")
    S.drift_checks(stream, baseline, str(tmp_path / "drift"), str(tmp_path / "c2"))
    checks = spark.read.parquet(str(tmp_path / "drift" / "checks")).where("metric = 'iou_mean'")
    assert {r.batch: r.ok for r in checks.collect()} == {0: True, 1: False}


def test_set_label_checks_spans(spark):
    from casequarry.operators import gold as Gold
    from casequarry.schemas import schema

    kind = schema("gold")
    rows = [{"gold_id": g, "status": "pending", "doc_chars": 100} for g in ("a", "b")]
    gold = spark.createDataFrame([tuple(r.get(f.name) for f in kind.fields) for r in rows], kind)
    label = "gold_id string, rating string, has_facts boolean, gold_span array<int>, notes string, labeler string, labeled_at string"
    make = lambda *r: spark.createDataFrame([r], label)
    got = {r.gold_id: r for r in Gold.set_label(gold, make("a", "correct", True, [5, 50], "", "me", "now")).collect()}
    assert got["a"].status == "labeled" and got["a"].label.gold_span == [5, 50] and got["b"].status == "pending"
    for bad in (("a", "correct", False, [5, 50], "", "me", "now"), ("a", "correct", True, [5, 500], "", "me", "now"), ("z", "correct", True, None, "", "me", "now")):
        with pytest.raises(Exception, match="span|unknown"):
            Gold.set_label(gold, make(*bad)).collect()


def test_search_tries_again(spark):
    from casequarry.sources import search as Src

    waits, answers = [], [429, 503, None]

    def fetch(at):
        code = answers.pop(0)
        if code:
            raise Src.Status(code)
        return "done"

    assert Src.persistent(fetch, sleep=waits.append)("x") == "done" and waits == [1.0, 2.0]
    with pytest.raises(Src.Status):
        Src.persistent(lambda: (_ for _ in ()).throw(Src.Status(404)), sleep=waits.append)()
    urls = spark.createDataFrame([(["u1", "u2"],), (["u3"],)], "candidates array<string>")

    def get(url):
        if url == "u1":
            raise Src.Status(202)
        return b"%PDF-1" if url == "u2" else b"<html>"

    got = Src.download(urls, get, attempts=2, backoff=0.0).collect()
    assert [(bytes(r.content) if r.content else None, r.error) for r in got] == [(b"%PDF-1", None), (None, "not_a_pdf")]


def test_report_formats(spark):
    small = spark.createDataFrame([("m", 0.5)], "method string, win_rate double")
    assert "50.0 %" in reports.comparison_report(small, small) and "## Against popularity" in reports.comparison_report(small, small)
    assert "## Missed targets" in reports.error_report(small, small)
    assert "| lookups | 3 | 75.0 % |" in reports.cost_report({"lookups": 3, "pages": 1}, 2.0, 0.25) and "$0.5000" in reports.cost_report({"lookups": 3, "pages": 1}, 2.0)
    assert "—" in reports.cost_report({}, 0.0)
    assert reports.downstream_report(small, small, small, small).count("## ") == 4
    page = reports.results_page("All", {"One": reports.comparison_report(small), "Two": reports.gold_report(spark.createDataFrame([("total", "all", 2)], "measure string, value string, n int"))})
    assert page.count("\n## ") == 2 and page.count("\n### ") == 2 and "| total | all | 2 |" in page
    row = {"doc_id": "d1", "error": None, "extraction": {"facts_span": {"start": 3, "end": 9}, "confidence": "high", "case_citations": ["1 U.S. 2"], "notes": []}, "validation_ok": True, "flags": ["a", "b"]}
    text = reports.document_summary(row)
    assert "3 to 9" in text and "| flags | a, b |" in text and "| valid | yes |" in text
    assert "needs_ocr" in reports.document_summary({"doc_id": "d2", "error": "needs_ocr", "extraction": None})


def test_recorded_model_runs(spark):
    docs = spark.createDataFrame([("d1", "alpha beta gamma delta epsilon zeta", "UNKNOWN"), ("d2", "one two three", None), ("d3", "x", None), ("d4", "y", None)], "doc_id string, text string, doc_type_id string")
    prompt = X.PROMPTS["llm-2"]
    asked = X.model_requests(docs, prompt, "m")
    keys = {r.doc_id: r.key for r in asked.collect()}
    first = asked.where("doc_id = 'd1'").first()
    assert first.prompt == "Type: UNKNOWN. Characters: 35.\n\nalpha beta gamma delta epsilon zeta" and not first.truncated
    assert X.model_requests(docs, X.Prompt("p", "s", "$document", most_chars=10), "m").where("doc_id = 'd1'").first().truncated
    good = {"has_facts": True, "facts_start_anchor": "beta", "facts_end_anchor": "epsilon", "record_citations": [{"as_printed": "R. 1", "prefix": "R.", "pages": ["1"]}], "confidence": "high"}
    usage = {"input_tokens": 100, "output_tokens": 10, "cache_creation_input_tokens": 5, "cache_read_input_tokens": 0}
    rows = [(keys["d1"], "m", "end_turn", "{}", usage, None, 0), (keys["d1"], "m", "end_turn", json.dumps(good), usage, None, 1), (keys["d2"], "m", "max_tokens", json.dumps(good), usage, 0.5, 2), (keys["d3"], "m", "end_turn", "not json", None, None, 3)]
    kind = "key string, model string, stop_reason string, text string, usage struct<input_tokens:bigint,output_tokens:bigint,cache_creation_input_tokens:bigint,cache_read_input_tokens:bigint>, cli_cost_usd double, line int"
    got = {r.doc_id: r for r in X.answered(asked, spark.createDataFrame(rows, kind), prompt, {"m": {"input": 1.0, "output": 2.0}}).collect()}
    assert got["d1"].error is None and got["d1"].extraction.facts_span.text == "beta gamma delta epsilon" and got["d1"].extraction.record_citations == ["R. 1"]
    assert got["d1"].input_tokens == 105 and got["d1"].cost_usd > 0
    assert got["d2"].error == "stopped at max_tokens" and got["d2"].cost_usd == 0.5 and got["d2"].extraction is None
    assert got["d3"].error.startswith("schema") and got["d4"].error.startswith("no recorded response")
