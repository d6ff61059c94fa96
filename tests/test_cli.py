"""The commands end to end on small files."""

import json

import pytest
from pyspark.sql import functions as F

from casequarry import __main__ as cli
from casequarry.operators import judge as J
from casequarry.schemas import ddl, schema

BODY = "The parties met in March and the work went on. " * 20
BRIEF = f"STATEMENT OF FACTS\n{BODY}\nARGUMENT\nWe argue that the ruling was sound. " + "It was. " * 400


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cli")
    words = ["lease", "rent", "tenant", "court", "appeal", "order"]
    rows = []
    for i in range(40):
        text = " ".join(words[(i + j) % 6] for j in range(4)) + f" number{i}"
        rows.append((i, "b", text, json.dumps([f"c{i % 6}", f"d{i % 3}"]), "UNKNOWN"))
    made = spark.createDataFrame(rows, "search_result_id bigint, build_id string, facts_text_masked string, targets_case_ids string, doc_type_id string")
    made.write.parquet(str(folder / "rows"))
    from casequarry.operators import dataset as D

    ids = D.load_dataset(made).select("row_id", "search_result_id")
    ids.select("row_id", F.array(*(F.when(F.col("search_result_id") % 6 == n, 1.0).otherwise(0.1).cast("float") for n in range(6))).alias("vector")).write.parquet(str(folder / "vectors"))
    return folder


@pytest.mark.parametrize("model", ["popularity", "tfidf", "dense", "hybrid", "rerank"])
def test_eval(data, capsys, model):
    assert cli.main(["eval", str(data / "rows"), "--model", model, "--vectors", str(data / "vectors"), "--k", "10"]) == 0
    assert "| all | all | 10 |" in capsys.readouterr().out


def test_ablation(data, capsys):
    assert cli.main(["eval", str(data / "rows"), "--model", "ablation", "--vectors", str(data / "vectors"), "--k", "10"]) == 0
    out = capsys.readouterr().out
    assert all(name in out for name in ("tfidf_10000_200", "hybrid_0.3", "hybrid_0.7"))


def test_bad_use(data):
    for argv in (["eval", "x", "--model", "dense"], ["gold", "x", "--labels", "y"], ["nothing"]):
        with pytest.raises(SystemExit) as e:
            cli.main(argv)
        assert e.value.code == 2


def test_downstream(spark, data, capsys):
    spans = [("rules_v2", 1, "lease rent tenant", 0, 17), ("llm", 1, "lease rent tenant", 0, 5), ("llm", 2, "order", None, None), ("rules_v2", 2, "order", 0, 5)]
    spark.createDataFrame(spans, "method string, row_id bigint, text string, start int, end int").write.parquet(str(data / "spans"))
    assert cli.main(["downstream", str(data / "rows"), str(data / "spans")]) == 0
    out = capsys.readouterr().out
    assert "| llm | 2 | 1 | 2 |" in out and "## Pairs" in out


def test_xeval_gold_and_gate(spark, data, capsys):
    label = {"rating": "correct", "has_facts": True, "gold_span": [18, 18 + len(BODY)], "notes": "", "labeled_at": "", "labeler": "human"}
    gold = [{"gold_id": "a", "status": "labeled", "source": "s", "label": label, "doc_chars": len(BRIEF)}, {"gold_id": "b", "status": "pending", "source": "s", "doc_chars": 10}]
    (data / "gold").mkdir()
    (data / "gold" / "g.json").write_text("\n".join(map(json.dumps, gold)))
    spark.createDataFrame([("a", BRIEF), ("b", "x")], "gold_id string, text string").write.parquet(str(data / "texts"))
    assert cli.main(["xeval", str(data / "gold"), str(data / "texts"), str(data / "runs" / "r1")]) == 0
    summary = json.loads((data / "runs" / "r1" / "summary.json").read_text())
    assert summary["summaries"]["rules_v2"]["iou_mean"] > 0.9
    (data / "labels").mkdir()
    (data / "labels" / "l.json").write_text(json.dumps({"gold_id": "b", "rating": "incorrect", "has_facts": False, "labeler": "me"}))
    assert cli.main(["gold", str(data / "gold"), "--labels", str(data / "labels"), "--out", str(data / "gold2")]) == 0
    assert "| status | labeled | 2 |" in capsys.readouterr().out


def test_judge(spark, data, capsys):
    rows = spark.createDataFrame([("a", "UNKNOWN", BRIEF, [18, 200], [0, 5])], "gold_id string, doc_type_id string, text string, span_a array<int>, span_b array<int>")
    rows.write.parquet(str(data / "judged"))
    key = J.requests(rows, J.Judge(), ("rules_v2", "llm")).first()["key"]
    reply = {"document_kind": "brief", "is_brief_with_facts": True, "candidate_a": {"rating": "correct"}, "candidate_b": {"rating": "incorrect"}, "preferred": "A", "confidence": "high"}
    assert {"key", "text"} <= {f.name for f in schema("response").fields} and ddl("judge_wire")
    (data / "replies").mkdir()
    (data / "replies" / "r.json").write_text(json.dumps({"key": key, "text": json.dumps(reply)}))
    assert cli.main(["judge", str(data / "judged"), str(data / "replies"), str(data / "verdicts")]) == 0
    assert "| preferred | all | A | 1 |" in capsys.readouterr().out


def test_build(spark, data):
    (data / "hits").mkdir()
    hits = [{"id": 1, "filepath_local": "a.pdf", "short_description": "Opening brief"}, {"id": 2, "short_description": "Opening brief"}]
    (data / "hits" / "h.json").write_text("\n".join(map(json.dumps, hits)))
    spark.createDataFrame([(1, BRIEF, 2)], "id bigint, text string, page_count int").write.parquet(str(data / "read"))
    spark.createDataFrame([], schema("citation_cache")).write.parquet(str(data / "cache"))
    assert cli.main(["build", str(data / "hits"), str(data / "read"), str(data / "cache"), str(data / "built"), "--storage", "https://f"]) == 0
    assert spark.read.parquet(str(data / "built" / "rows")).first().search_result_id == 1
    assert spark.read.json(str(data / "built" / "failures")).first().reason == "no_pdf_url"
