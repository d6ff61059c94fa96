"""Operators with one right answer, against brute force and SQL, and on edge cases."""

import hashlib
import json
import random
import re
import time

import duckdb
import pytest
import xxhash
from oracle import check, connect
from pyspark.sql import functions as F

from casequarry.llm import components, decontaminate, exactdedup, linededup, mixing, queries, secrets, simhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf, name):
    check(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLE_SQL[name])


def brute_contamination(docs, items, window=10):
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        w = words.findall((text or "").translate(LOW))
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    sizes, out = {len(k) for k in windows}, []
    for doc, text in docs:
        w, hit, found = words.findall((text or "").translate(LOW)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if items_ := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= items_
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def contamination(docs, items):
    got = decontaminate.contamination(docs, items).select("doc_id", "n_words", "n_hit", "items", "n_items", "spans").collect()
    for r in got:
        assert r.n_items == len(r["items"])
        assert sum(s.e - s.s for s in r.spans or []) == r.n_hit
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str)


def test_contamination_of_the_tables(spark, sf, tables):
    docs, items = tables("SELECT doc_id, text FROM documents"), tables("SELECT item_id, text FROM benchmark")
    read = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    want = brute_contamination(docs, items)
    assert contamination(read("documents"), read("benchmark")) == want
    got = queries.op1_decontaminate(spark, sf).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((d, n, h, len(i), sha(",".join(i)), h > 0) for d, n, h, i in want), key=str)


def test_contamination_edges(spark, edges, empty):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(12)]
    items = [(1, "hello there"), (2, None), (3, ""), (4, " ".join(rng.choices(words, k=30))), (4, " ".join(rng.choices(words, k=30))), (None, "shared line"), (5, "Été"), (6, " ".join(words[:9])), (7, " ".join(words[:10]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("mark", F.lit(1))
    docs = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    more = [(100 + i, " ".join(rng.choices(words, k=200) + items[3][1].split()[i : i + 14] + rng.choices(words, k=5))) for i in range(8)]
    both = edges.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    named = [i for i in items if i[0] is not None]
    assert contamination(both, bench.where("item_id is not null")) == brute_contamination(docs + more, named)
    assert contamination(edges, bench.where("false")) == brute_contamination(docs, [])
    assert contamination(empty, bench) == []
    assert len(contamination(edges, bench)) == len(docs)


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """component of each (id, fingerprint) row, or None where no id is reached."""
    group = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 2 or (rows[i][0] is not None and rows[i][0] == rows[j][0]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (doc, _) in zip(group, rows, strict=True):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return [least.get(g) for g in group]


def test_simhash_of_the_tables(spark, sf, tables):
    rows = [(d, brute_fingerprint(t)) for d, t in tables("SELECT doc_id, text FROM documents")]
    want = sorted((d, format(f, "016x"), c) for (d, f), c in zip(rows, brute_components(rows), strict=True))
    assert sorted(map(tuple, queries.op5_simhash(spark, sf).collect())) == want


def test_simhash_edges(spark, edges, empty):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in edges.collect()]
    want = sorted(((d, format(f, "016x"), c) for (d, f), c in zip(rows, brute_components(rows), strict=True)), key=str)
    assert sorted(map(tuple, simhash.near_duplicates(edges).collect()), key=str) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_links_pass_through_rows_without_ids(spark, monkeypatch):
    # Fingerprints as texts: 1 - null - 2 in steps of two bits, and an id of two far texts.
    monkeypatch.setattr(simhash, "fingerprints", lambda text: text.cast("bigint"))
    rows = [(1, "0"), (None, "3"), (2, "15"), (None, str(255 << 40)), (None, str(255 << 40 | 3)), (9, str(255 << 40 | 15)), (None, str(255 << 20))]
    rows += [(4, str(255 << 50)), (6, str(255 << 50 | 1)), (6, str(255 << 8))]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got} == {
        (d, int(t), c) for (d, t), c in zip(rows, [1, 1, 1, 9, 9, 9, None, 4, 4, 4], strict=True)
    }


def test_links_are_all_close_pairs(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    values = {centre} | {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.5) << rng.randrange(64) for _ in range(150)}
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    got = {(r.a, r.b): r.shared_bytes for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint")).collect()}
    mask = 2**64 - 1
    want = {}
    for a in signed:
        for b in signed:
            if a < b and ((a ^ b) & mask).bit_count() <= 2:
                want[a, b] = sum(((a ^ b) & mask) >> 8 * i & 255 == 0 for i in range(8))
    assert got == want


def test_tally_of_shared_bytes(spark):
    rng = random.Random(15)
    values = {rng.getrandbits(64) for _ in range(20)}
    for v in list(values):  # up to four changed bytes, in one bit or in many
        for _ in range(15):
            new = v
            for place in rng.sample(range(8), rng.randrange(1, 5)):
                new ^= rng.choice([1 << rng.randrange(8), rng.randrange(1, 256)]) << 8 * place
            values.add(new)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    want = {}
    for a in signed:
        for b in signed:
            shared = sum(((a ^ b) >> 8 * i) & 255 == 0 for i in range(8))
            if a < b and shared >= 5:
                want[a, b] = shared
    frame = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    assert {(r.a, r.b): r.shared_bytes for r in simhash.tallied(frame).collect()} == want
    close = {p for p in want if ((p[0] ^ p[1]) & (2**64 - 1)).bit_count() <= 2}
    assert {(r.a, r.b) for r in simhash.links(frame).collect()} == close
    retained = {p for p, shared in want.items() if shared >= 6}
    assert len(close) < len(retained) < len(want)  # the tally drops pairs that met, the verification drops retained ones


@pytest.mark.parametrize("block", [components.BLOCK, 7])
def test_components(spark, block):
    rng = random.Random(9)
    chain = [(i, i + 1) for i in range(60)]
    edges = chain + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(25)] + [(-5, 300)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint"), block).collect()}
    want = {n: n for e in edges if e[0] != e[1] for n in e}
    while any(want[u] != want[v] for u, v in edges if u != v):
        for u, v in edges:
            if u != v:
                want[u] = want[v] = min(want[u], want[v])
    assert got == want
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
    star = spark.range(1, 3000).selectExpr("id as u", "0L as v").unionByName(spark.range(5000, 5600).selectExpr("id + 1 as u", "id as v"))
    found = components.components(star, 500 if block == 7 else block)
    assert {(r.component, r.n) for r in found.groupBy("component").agg(F.count("*").alias("n")).collect()} == {(0, 3000), (5000, 601)}


def test_line_dedup_edges(edges, empty):
    rows = edges.collect()
    keys = lambda text: [line.strip(SPACE).translate(LOW) for line in (text or "").split("\n")]
    for least in (2, 3):
        seen = {}
        for r in rows:
            for key in {k for k in keys(r.text) if k}:
                seen.setdefault(key, set()).add(r.doc_id)
        count = {k: len(v) for k, v in seen.items()}
        want = []
        for r in rows:
            lines = (r.text or "").split("\n")
            stay = [line for line, k in zip(lines, keys(r.text), strict=True) if not (k and count[k] >= least)]
            want.append((r.doc_id, len(lines), len(lines) - len(stay), "\n".join(stay)))
        got = linededup.drop_common_lines(edges, min_docs=least, carry=("source", "row")).collect()
        assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got), key=str) == sorted(want, key=str)
        assert {r.carried.row for r in got} == {"extra"}
    assert linededup.drop_common_lines(empty).count() == 0


def test_lines_of_repeated_ids_count_once(spark, tmp_path):
    rows = [(7, "one\nsame")] * 12 + [(None, "other\nsame")] * 12 + [(i, "same\nkept") for i in range(20, 27)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert linededup.drop_common_lines(docs, min_docs=10).where("n_dropped > 0").isEmpty()
    assert linededup.drop_common_lines(docs, min_docs=9).where("n_dropped = 1").count() == len(rows)
    lines = duckdb.sql("SELECT k FROM (SELECT unnest(string_split(text, chr(10))) AS k, doc_id FROM read_json_auto('{}')) GROUP BY k HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= 9".format(write_json(tmp_path, rows))).fetchall()
    assert lines == [("same",)]


def write_json(folder, rows):
    path = folder / "rows.json"
    path.write_text("\n".join(json.dumps({"doc_id": d, "text": t}) for d, t in rows))
    return path


@pytest.mark.parametrize("collide", [False, True])
def test_exact_dedup_edges(edges, empty, collide):
    rows = edges.collect()
    hashed = (lambda c: F.substring(exactdedup.content_hash(c), 1, 0)) if collide else exactdedup.content_hash
    groups = {}
    for r in rows:
        groups.setdefault((r.text or "").translate(LOW), []).append(r.doc_id)
    want = []
    for r in rows:
        text = (r.text or "").translate(LOW)
        keep = max((d for d in groups[text] if d is not None), default=None)
        want.append((r.doc_id, keep, len(groups[text]), r.doc_id == keep, sha(text)))
    got = exactdedup.exact_duplicates(edges, keep="largest", hashed=hashed)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert exactdedup.exact_duplicates(empty).count() == 0
    assert exactdedup.exact_duplicates(edges).where("doc_id = 5").first().keep_id == 4


RULES = (
    ("assign", re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile("[0-9a-f]+"), 0, 32),
)


def brute_secrets(text):
    found = []
    for order, (kind, rule, group, least) in enumerate(RULES):
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in rule.finditer(text or "") if len(m[group]) >= least]
    return ",".join(f[2] for f in sorted(found))


def spans(df):
    return sorted(((r.doc_id, r.s) for r in df.select("doc_id", secrets.span_list().alias("s")).collect()), key=str)


def test_secrets(spark, sf, tables, edges, empty):
    got = sorted((r.doc_id, r.spans, r.base_sha256) for r in queries.op9_secrets(spark, sf).collect())
    assert got == sorted((d, brute_secrets(t), sha(brute_secrets(t))) for d, t in tables("SELECT doc_id, text FROM documents"))
    tricky = ["token: secret: abcdefghij", "token=secret=abcdefgh", "api_key='x' apikey: 12345678", "é" * 5 + "passwd=" + "z" * 9 + "\n" + "f" * 31 + " " + "0" * 33, "AKIA" * 4, "AKIAKIA" + "Z" * 9, "Token = \"A/b+c_d.e-f=g\""]
    rows = spark.createDataFrame(list(enumerate(tricky)), "doc_id bigint, text string")
    assert spans(secrets.secrets(rows)) == [(i, brute_secrets(t)) for i, t in enumerate(tricky)]
    assert spans(secrets.secrets(edges)) == sorted(((r.doc_id, brute_secrets(r.text)) for r in edges.collect()), key=str)
    assert secrets.secrets(empty).count() == 0


def test_many_secrets_in_one_text(spark):
    text = " ".join(f"token=abcdefgh{i}" for i in range(40_000)) + " AKIA" + "Z" * 12
    rows = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    began = time.time()
    (got,) = secrets.secrets(rows).collect()
    assert time.time() - began < 20
    want = [(m.start(), m.end()) for m in RULES[0][1].finditer(text)]
    assert [(s.start, s.end) for s in got.assign] == want and len(got.access) == 1


def test_secret_query_scans_only_unseen_pairs(spark, sf, monkeypatch):
    made = []
    real = secrets.scan_blobs
    monkeypatch.setattr(secrets, "scan_blobs", lambda docs, ledger, rules, col: made.append((docs, ledger, rules, out := real(docs, ledger, rules, col))) or out)
    queries.op9_secrets(spark, sf).count()
    (first, none, early, _), (docs, ledger, rules, _) = made
    assert none is None and [r.name for r in early] == ["access", "hex"] and len(rules) == 3
    # After both commits nothing is unseen, and every pair of a blob and a rule version stands in the ledger once.
    assert real(docs, spark.read.parquet(ledger.inputFiles()[0].rsplit("/", 1)[0]), rules, "text").isEmpty()
    whole = spark.read.parquet(ledger.inputFiles()[0].rsplit("/", 1)[0])
    assert whole.groupBy("blob", "rule", "rule_version").count().where("count > 1").isEmpty()
    blobs = docs.select(secrets.blob_id(F.col("text")).alias("blob")).distinct()
    old = first.select(secrets.blob_id(F.col("text")).alias("blob")).distinct()
    both = blobs.intersect(old).count()
    assert 0 < both < blobs.count()
    assert whole.count() == 2 * old.count() + 3 * blobs.count() - 2 * both


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    path = str(tmp_path / "ledger")
    first = spark.createDataFrame([("a.txt", 1, "token=abcdefgh1"), ("b.txt", 1, "token=abcdefgh1"), ("c.txt", 1, "nothing")], "path string, version int, text string")
    ids = ("path", "version")
    found = secrets.scan_history(first, path, id_cols=ids)
    assert sorted((r.path, r.start, r.end) for r in found.collect()) == [("a.txt", 0, 15), ("b.txt", 0, 15)]
    ledger = spark.read.parquet(path)
    assert ledger.count() == 6  # two blobs, three rules
    assert secrets.scan_blobs(first, ledger).count() == 0
    second = first.unionByName(spark.createDataFrame([("a.txt", 2, "secret=12345678")], first.schema))
    assert secrets.scan_blobs(second, ledger).count() == 1
    assert secrets.scan_history(second, path, id_cols=ids).count() == 3
    newer = (*secrets.RULES[1:], secrets.Rule("assign", 2, r"(token)=(\w+)", 2, 4, "token"))
    fresh = secrets.scan_blobs(second, spark.read.parquet(path), newer).select("assign", "hex").collect()
    assert len(fresh) == 3 and all(r.hex is None and r.assign is not None for r in fresh)


def test_mix_edges(edges, empty):
    got = mixing.mix(edges).collect()
    assert len(got) == len(edges.collect())
    for r in got:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"] and r.target <= 3 * r.source_size + 1e-6
    sources = {r.source: (r.source_size, r.target) for r in got}
    assert sum(t for _, t in sources.values()) == pytest.approx(sum(s for s, _ in sources.values()))
    assert mixing.mix(empty).count() == 0


def test_targets_fill_up_from_those_that_stop(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), ("d", 0), (None, 5)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    weights, sizes = {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}, {"a": 10, "b": 1000, "c": 1000, "d": 0, None: 5}
    stopped = set()
    while True:  # reshare until nobody is above
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)
        share = {s: rest * weights[s] / sum(weights[o] for o in sizes if o not in stopped) for s in sizes if s not in stopped}
        above = {s for s, t in share.items() if t > 3 * sizes[s]}
        if not above:
            break
        stopped |= above
    want = {s: 3.0 * sizes[s] for s in stopped} | share
    assert got == pytest.approx(want)


def test_mix_takes_near_the_target(spark, sf):
    mixed = mixing.mix(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = mixed.groupBy("source", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("largest"))
    for r in rows.collect():
        assert abs(r.taken - r.target) <= 1.01 * r.largest + 1
    assert queries.op10_mix(spark, sf).exceptAll(queries.op10_mix(spark, sf)).isEmpty()


def test_passages_of_the_tables(spark, sf, tables):
    words = {d: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW)) for d, t in tables("SELECT doc_id, text FROM documents")}
    got = queries.op4_passages(spark, sf).collect()
    assert {(r.doc_id, r.span, r.partner_id, r.partner_span) for r in got} == {(r.partner_id, r.partner_span, r.doc_id, r.span) for r in got}
    group = {d: d for d in words}

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    for r in got:
        (a0, a1), (b0, b1) = (map(int, s.split(":")) for s in (r.span, r.partner_span))
        assert 0 <= a0 and a1 <= len(words[r.doc_id]) and min(a1 - a0, b1 - b0) >= 50 and 0.8 <= r.identity <= 1
        if a1 - a0 == b1 - b0:  # words equal at equal places are a common subsequence
            same = sum(x == y for x, y in zip(words[r.doc_id][a0:a1], words[r.partner_id][b0:b1], strict=True))
            assert r.identity < 1 or same == a1 - a0
        group[root(r.doc_id)] = root(r.partner_id)
    first = {}
    for d, w in words.items():
        for i in range(len(w) - 49):
            other = first.setdefault(tuple(w[i : i + 50]), d)
            assert root(other) == root(d), (other, d, i)


def test_simhash_never_broadcasts_its_postings(spark):
    """The planner takes a posted table for small, whatever its 56 rows a fingerprint come to."""
    from casequarry.llm import common as C

    distinct = C.written(spark.range(50).select(F.xxhash64("id").alias("fp")))
    plan = simhash.tallied(distinct)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
