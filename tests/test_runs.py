"""Runs of replayed models and routes, their cache, and the smoke gate from files."""

import json

import pytest
from pyspark.sql import functions as F

from casequarry import __main__ as cli
from casequarry.operators import extraction as X
from casequarry.operators import methods as M
from casequarry.operators import run_eval as Run
from casequarry.plans.eval_queries import _brief_gold, _brief_recordings
from casequarry.schemas import wire_schema
from casequarry.sources import files


@pytest.fixture(scope="module")
def briefs(spark):
    body = "The work went on as they had agreed. " * 45
    rows = []
    for i in range(10):
        head, told = f"Docket {i}\nSTATEMENT OF FACTS\n", f"The parties of case {i} met in March. {body}They parted in June."
        rows.append((i, f"{head}{told}\nARGUMENT\n" + "We argue that the ruling was sound. " * 60, len(head), len(head) + len(told)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, s int, e int")


def _asked(briefs):
    return briefs.select(F.col("doc_id").cast("string").alias("gold_id"), "text", F.lit("FEDERAL_APPELLATE").alias("doc_type_id"))


def test_route_takes_cached_cheap_results(spark, briefs):
    """Without recordings of the cheap model, the cached results alone decide; the strong one is asked where a trigger fires."""
    recorded = _brief_recordings(briefs)
    _, cached = Run.run_method(_asked(briefs), "llm-1", None, recorded)
    assert {r.config_sha for r in cached.collect()} == {M.config_sha("llm-1")}
    strong_only = recorded.where("model = 'large'")
    got = {int(r.gold_id): r for r in Run.run_method(_asked(briefs), "routed-1", cached, strong_only)[0].collect()}
    assert [got[i].tier for i in range(10)] == ["cheap", "strong", "cheap", "strong", "strong", "cheap", "strong", "cheap", "strong", "strong"]
    assert (got[5].cost_usd, got[1].cost_usd, got[3].cost_usd) == (0.25, 1.75, 1.5)
    assert got[1].extractor_version == "routed-1" and got[1].extractor_notes[-1] == "routed:strong:anchor_not_found"
    assert got[2].pred_span is None and "llm_no_facts" in got[2].extractor_notes


def test_repeated_null_and_unreadable_documents(spark, briefs):
    """Repeated texts get the same result, documents that cannot be read are no errors of the model and cost nothing."""
    more = _asked(briefs.where("doc_id = 0")).withColumn("gold_id", F.lit("again"))
    bad = spark.createDataFrame([("null", None, None), ("empty", "", "X")], "gold_id string, text string, doc_type_id string")
    rows = _asked(briefs).unionByName(more).unionByName(bad)
    found, fresh = Run.run_method(rows, "llm-1", None, _brief_recordings(briefs))
    got = {r.gold_id: r for r in found.collect()}
    assert len(got) == 13 and got["again"].pred_span == got["0"].pred_span is not None
    assert (got["null"].error, got["empty"].error, got["null"].cost_usd) == ("no_text", "no_text", None)
    assert got["3"].error.startswith("no recorded response") and got["4"].error == "stopped at max_tokens" and got["4"].cost_usd is None
    assert fresh.count() == 6  # four kinds of twice five answer well, the repeated text once
    routed = {r.gold_id: r for r in Run.run_method(rows, "routed-1", None, _brief_recordings(briefs))[0].collect()}
    assert routed["null"].trigger is None and routed["null"].error == "no_text"


def test_offline_and_empty(spark, briefs):
    errors = {r.error for r in Run.run_method(_asked(briefs), "routed-1")[0].collect()}
    assert errors == {"offline: not in cache"}
    assert Run.run_method(_asked(briefs).limit(0), "routed-1", None, _brief_recordings(briefs))[0].count() == 0


def test_documents_are_prepared_once(spark, briefs, monkeypatch):
    """However many methods read them; what they read is a written table."""
    few, calls, prepare = briefs.where("doc_id < 2"), [], X.prepared
    monkeypatch.setattr(X, "prepared", lambda *a: calls.append(a) or prepare(*a))
    texts = few.select(F.col("doc_id").cast("string").alias("gold_id"), "text")
    run, _ = Run.run_eval(_brief_gold(few), texts, ("rules_v2", "llm-1"))
    assert len(calls) == 1 and run.per_doc.count() == 4


def test_config_of_a_method(monkeypatch):
    before = {n: M.config_sha(n) for n in M.METHODS}
    assert len(set(before.values())) == len(before)
    monkeypatch.setitem(M.METHODS, "llm-1", M.Model(X.PROMPTS["llm-1"], "other"))
    assert M.config_sha("routed-1") != before["routed-1"] and M.config_sha("routed-2") == before["routed-2"]
    with pytest.raises(KeyError, match="unknown method"):
        M.method("nothing")


def test_smoke_command(spark, briefs, tmp_path, capsys):
    """No baseline: 1; made, then met: 0; recordings that lose an answer: 1."""
    few = briefs.where("doc_id in (0, 5)")
    files.write_lines(_brief_gold(few), str(tmp_path / "gold"))
    few.select(F.col("doc_id").cast("string").alias("gold_id"), "text").write.parquet(str(tmp_path / "texts"))
    recorded = _brief_recordings(few).drop("line")
    files.write_lines(recorded, str(tmp_path / "all"))
    files.write_lines(recorded.where("model = 'small'").limit(1), str(tmp_path / "one"))
    argv = lambda name, *more: ["smoke", *(str(tmp_path / n) for n in ("gold", "texts", name, "baseline")), "--methods", "llm-1", *more]
    assert cli.main(argv("all")) == 1 and "no baseline" in capsys.readouterr().err
    assert cli.main(argv("all", "--update-baseline")) == 0
    assert cli.main(argv("all", "--summary-out", str(tmp_path / "gate.md"))) == 0
    assert "Gate: pass" in (tmp_path / "gate.md").read_text()
    assert cli.main(argv("one")) == 1 and "REGRESSION" in capsys.readouterr().out


def test_wire_schema_has_no_references():
    made = wire_schema("wire_2")
    cite = made["properties"]["record_citations"]["items"]
    assert cite["properties"]["pages"] == {"type": "array", "items": {"type": "string"}} and cite["additionalProperties"] is False
    assert made["required"] == list(made["properties"]) and "$ref" not in json.dumps(made)
    assert made["properties"]["confidence"]["enum"] == ["high", "medium", "low"]
    assert made["properties"]["facts_start_anchor"] == {"anyOf": [{"type": "string"}, {"type": "null"}]}


def test_manifest_of_this_machine(tmp_path):
    assert files.git_state(str(tmp_path)) == (None, None)
    record = files.manifest_here({"a": 1}, "now", str(tmp_path))
    assert record["commit"] == "unknown" and record["dirty"] is None and record["versions"]["pyspark"] and files.versions(("no-such-package",))["no-such-package"] == "not installed"
