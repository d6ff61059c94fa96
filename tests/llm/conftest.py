import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

WORDS = [f"w{i}" for i in range(400)]
#: Ids, texts and columns whose names clash with the operators' own.
EDGES = [
    (1, None, "en", "s1"),
    (2, "", "en", "s1"),
    (3, " \t\n ", None, None),
    (4, "Hello There\nshared line\n  SHARED line \n", "en", "s2"),
    (4, "Hello There\nshared line\n  SHARED line \n", "en", "s2"),
    (5, "hello there\nSHARED LINE\n  shared line \n", "en", None),
    (None, "no id here, token=abcdefgh1 Token: 'short' PASSWORD=\"hunter2hunter2\"", "fr", "s2"),
    (6, "été " * 3000, "fr", "s3"),
    (7, "x", None, "s3"),
    (8, "AKIA" + "A1" * 8 + " é " + "0123456789abcdef" * 2 + " secret = abc.def/ghi+jkl==", "de", "s1"),
]
EXTRA = "row string, h string, t string, fp string, norm string, doc string, n_words string, label string, k string, source_size string, cands string, pos string"


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(*r, *["extra"] * len(EXTRA.split(","))) for r in EDGES]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, {EXTRA}")


@pytest.fixture(scope="module")
def empty(edges):
    return edges.where("false")


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def tables(sf):
    import duckdb

    return lambda sql: duckdb.sql(sql.replace("documents", f"'{sf}/documents.parquet'").replace("benchmark", f"'{sf}/benchmark.parquet'").replace("labels", f"'{sf}/labels.parquet'")).fetchall()
