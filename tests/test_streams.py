"""Streams decided by keyed state and timers give the batch operators' results, whatever the order of arrival."""

import json
import os
import random

from pyspark.sql import functions as F

from casequarry.streaming import requests as S
from casequarry.streaming import stateful


def arriving(spark, folder, parts, kind):
    """A stream of one file for each part, read in order."""
    folder.mkdir()
    for n, rows in enumerate(parts):
        (folder / f"{n:02d}.json").write_text("\n".join(map(json.dumps, rows)))
        os.utime(folder / f"{n:02d}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).json(str(folder))


def stamp(s):
    return f"2026-01-01T{int(s) // 3600:02d}:{int(s) // 60 % 60:02d}:{s % 60:06.3f}Z"


def shuffled(rng, rows, slack, size):
    """Rows by a time that differs from their own by less than ``slack`` seconds, in parts."""
    rows = sorted(rows, key=lambda r: r[0] + rng.random() * slack)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def test_limited_stream_equals_batch(spark, tmp_path):
    rng = random.Random(7)
    rows = [(rng.randint(0, 900_000) / 1000 + 0.0, rng.choice("abc")) for _ in range(150)]
    parts = [[{"client": c, "at": stamp(s)} for s, c in p] for p in shuffled(rng, rows, 200, 50)]
    parts.append([{"client": "z", "at": stamp(7200.0)}])  # moves the watermark past all others
    kind = "client string, at timestamp"
    batch = S.limited(spark.createDataFrame([r for p in parts for r in p], "client string, at string").withColumn("at", F.to_timestamp("at")), 2)
    want = sorted((r.client, r.at.timestamp(), r.allowed) for r in batch.collect() if r.client != "z")
    stream = stateful.limited_stream(arriving(spark, tmp_path / "in", parts, kind), 2, "10 minutes")
    got = sorted((r.client, round(r.s, 3), r.allowed) for r in S.drain(stream, "limited_t", str(tmp_path / "c"), "append").collect() if r.client != "z")
    assert [(c, round(s, 3), a) for c, s, a in want] == got and {a for _, _, a in got} == {True, False}


def test_budgeted_stream_equals_batch(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i * 240.0, i, rng.randint(1, 9)) for i in range(60)]  # four hours, fifteen chunks each
    parts = [[{"chunk": i, "n": n, "at": stamp(s)} for s, i, n in p] for p in shuffled(rng, rows, 1500, 20)]
    parts.append([{"chunk": 999, "n": 0, "at": stamp(36_000.0)}])
    hours = spark.createDataFrame([(i, f"2026-01-01T{int(s) // 3600:02d}", n) for s, i, n in rows], "chunk bigint, hour string, n bigint")
    for limits in ((90, 40),):
        want = {r.chunk: r.allowed for r in S.budgeted(hours, *limits).collect()}
        folder = tmp_path / f"b{limits[0]}"
        stream = arriving(spark, tmp_path / f"in{limits[0]}", parts, "chunk bigint, n bigint, at timestamp")
        done = S.budgeted_stream(stream, str(folder), str(tmp_path / f"c{limits[0]}"), *limits, late="30 minutes")
        assert {r.chunk: r.allowed for r in done.collect() if r.chunk != 999} == want and {True, False} == set(want.values())


def test_budget_is_a_monotone_cut(spark):
    """Against the same rule met one chunk after another."""
    rng = random.Random(9)
    rows = [(i, f"h{i // 20:02d}", rng.randint(1, 9)) for i in range(200)]
    spent, left, cut, want = 0, {}, False, {}
    fits = {}
    for h in {h for _, h, _ in rows}:
        own = [(i, n) for i, g, n in rows if g == h]
        fits |= dict(zip([i for i, _ in own], stateful.spent_in_order([n for _, n in own], 60), strict=True))
    for i, _, n in rows:
        cut |= fits[i] and spent + n > 333
        want[i] = fits[i] and not cut
        spent += n if want[i] else 0
    df = spark.createDataFrame(rows, "chunk bigint, hour string, n bigint")
    assert {r.chunk: r.allowed for r in S.budgeted(df, 333, 60).collect()} == want and left == {}
