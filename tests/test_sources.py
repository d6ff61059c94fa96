"""Search source with pushed filters, page ranges and a stream; lines replaced in one step."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casequarry.sources import lines, search

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import this file
SIZE = 5


def service(folder, hits):
    """Pages of numbered hits; every request is noted as a file."""

    def fetch(address, params):
        said = {"at": address} | params
        (folder / f"{len(list(folder.iterdir())):04d}-{abs(hash(json.dumps(said))) % 10**6}.json").write_text(json.dumps(said))
        found = [h for h in hits if all(h.get(k) == params[k] for k in search.FILTERED if k in params)]
        found = [h for h in found if int(params.get("after", 0)) < h["id"] <= int(params.get("until", 1 << 60))]
        page = int(address or 0)
        return found[page * SIZE : (page + 1) * SIZE], str(page + 1) if (page + 1) * SIZE < len(found) else None

    return fetch


def asked(folder):
    return [json.loads(p.read_text()) for p in sorted(folder.iterdir())]


HITS = [{"id": i, "court": "ca9" if i % 3 else "nysd", "short_description": f"brief {i}"} for i in range(1, 32)]


def test_filters_reach_the_service(spark, tmp_path):
    found = search.search(spark, service(tmp_path, HITS), ["q"], 100, name="s_filter").where((F.col("court") == "ca9") & (F.col("id") > 10))
    assert sorted(r.id for r in found.collect()) == [h["id"] for h in HITS if h["court"] == "ca9" and h["id"] > 10]
    assert {r["court"] for r in asked(tmp_path)} == {"ca9"} and len(asked(tmp_path)) == -(-21 // SIZE)


def test_page_ranges(spark, tmp_path):
    count = lambda params: len([h for h in HITS if "court" not in params or h["court"] == params["court"]])
    made = search.search(spark, service(tmp_path, HITS), ["q"], 23, name="s_pages", count=count, page_size=SIZE, pages=2)
    assert made.rdd.getNumPartitions() == 3 and sorted(r.id for r in made.collect()) == list(range(1, 24))
    assert sorted(r["at"] for r in asked(tmp_path)) == ["0", "1", "2", "3", "4"]


def test_stream_repeats_no_page(spark, tmp_path):
    calls, store = tmp_path / "calls", tmp_path / "hits.json"
    calls.mkdir()
    store.write_text(json.dumps(HITS[:12]))

    def fetch(address, params):
        return service(calls, json.loads(store.read_text()))(address, params)

    newest = lambda params: max(h["id"] for h in json.loads(store.read_text()))
    seen = []
    for n, upto in enumerate((12, 31)):
        store.write_text(json.dumps(HITS[:upto]))
        stream = search.search_stream(spark, fetch, ["q"], newest).select("id")
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
        seen.append(sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()))
        assert {r["after"] for r in asked(calls)} <= {"0", "12"}, n
    assert seen == [list(range(1, 13)), list(range(1, 32))]
    windows = [(r["after"], r["at"]) for r in asked(calls)]
    assert len(windows) == len(set(windows))


def test_lines_are_replaced_in_one_step(spark, tmp_path):
    kind = StructType.fromDDL("k bigint, s string, a array<int>")
    path = str(tmp_path / "gold")
    assert lines.read(spark, path, kind).count() == 0
    first = spark.range(20).select(F.col("id").alias("k"), F.lit("é\n\"x\"").alias("s"), F.array(F.lit(1)).alias("a")).repartition(3)
    lines.replace(first, path)
    assert sorted(map(tuple, lines.read(spark, path, kind).collect())) == [(i, 'é\n"x"', [1]) for i in range(20)]
    bad = spark.range(20, 40).select(F.when(F.col("id") == 33, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("bigint").alias("k"), F.lit("n").alias("s"), F.array(F.lit(2)).alias("a"))
    with pytest.raises(Exception, match="stop"):
        lines.replace(bad.repartition(3), path)
    assert {r.k for r in lines.read(spark, path, kind).collect()} == set(range(20))
    assert len([p for p in (tmp_path / "gold").iterdir() if p.name.startswith("v-")]) == 1  # nothing of the failed write is left
    lines.replace(first.where("k < 2"), path)
    assert lines.read(spark, path, kind).count() == 2 and len([p for p in (tmp_path / "gold").iterdir() if p.name.startswith("v-")]) == 1
