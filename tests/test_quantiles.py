"""Order statistics for any distribution, MinHash and citation intervals against plain versions."""

import hashlib
import random
import statistics
import time

import pytest
from pyspark.sql import functions as F

from casequarry.functions import citations as Cites
from casequarry.operators import dataset as D
from casequarry.operators.quantiles import at_ranks, median

SPREADS = {
    "within a hundredth": lambda r: 7 + r.random() / 100,
    "ever closer": lambda r: 2.0 ** -r.randint(0, 40),
    "huge and tiny": lambda r: r.choice([-1e308, 1e308, 0.0, 1e-300, r.random()]),
    "few values": lambda r: float(r.randint(0, 3)),
}


@pytest.mark.parametrize("spread", SPREADS)
def test_ranks(spark, spread):
    rng = random.Random(2)
    rows = [(rng.choice(["a", None, "b"]), SPREADS[spread](rng)) for _ in range(600)] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = at_ranks(df, ["g"], "v", {"first": lambda n: F.lit(0), "third": lambda n: F.floor(n / 3), "last": lambda n: n - 1}, bins=8, few=5)
    for r in got.collect():
        own = sorted(v for g, v in rows if g == r.g and v is not None)
        assert (r.first, r.third, r.last) == (own[0], own[len(own) // 3], own[-1])
    if spread == "within a hundredth":
        mid = {r.g: r.m for r in median(df, ["g"], "v", "m").collect()}
        assert mid == {g: pytest.approx(statistics.median(v for k, v in rows if k == g and v is not None)) for g in ("a", None, "b")}


def test_ranks_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert median(df, ["g"], "v", "m").count() == 0 and median(df.where("false"), ["g"], "v", "m").count() == 0


def plain_fingerprint(text):
    clean = (text or "").lower().strip()
    shingles = {clean[i : i + 5].encode() for i in range(len(clean) - 4)}
    if not shingles:
        return "0" * 16
    minima = [int.from_bytes(min(hashlib.md5(b"%d:" % seed + s).digest()[:4] for s in shingles)) for seed in range(64)]
    return hashlib.sha256(str(minima).encode()).hexdigest()[:16]


def test_fingerprints(monkeypatch):
    rng = random.Random(1)
    texts = ["", None, "abcd", "abcde", " Ab\0cde ", "été çà 日本語テキスト𝄞𝄞𝄞", "x" * 100]
    texts += ["".join(rng.choices("abcdef ghié", k=rng.randint(0, 200))) for _ in range(40)]
    texts += ["".join(chr(0x4E00 + rng.randint(0, 9000)) for _ in range(300)) for _ in range(30)]  # a large alphabet
    want = [plain_fingerprint(t) for t in texts]
    assert D.fingerprints_of(texts) == want
    monkeypatch.setattr(D, "_CHARACTERS", 100)
    assert D.fingerprints_of(texts) == want


def test_many_citations_in_one_text():
    text = "Roe v. Doe, 12 F.3d 345 (9th Cir. 2001); Id. at 3. See 28 U.S.C. § 1331. " * 50_000
    began = time.perf_counter()
    found = Cites.find(text)
    assert len(found) == 150_000 and time.perf_counter() - began < 20
    rng = random.Random(4)
    spans = [(a, a + rng.randint(0, 30)) for a in (rng.randint(0, 300) for _ in range(60))]
    cover = Cites._Cover(spans)
    for a in range(0, 300, 7):
        for b in range(a, a + 40, 3):
            assert ((a, b) in cover) == any(x <= a and b <= y for x, y in spans)
    assert (1, 2) not in Cites._Cover([])
