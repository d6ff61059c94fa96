"""Documents whose ends look like parts of headings, and whose lengths differ from the table's."""

import duckdb
import pytest
from oracle import check
from pyspark.sql import functions as F

from casequarry.functions import spans as S
from casequarry.functions import validators as V
from casequarry.plans import text_queries

FILLER = "The parties met in the spring and signed the lease after long talks. "
ENDS = [("", ""), ("\n", "\n"), ("17\n", ""), ("", "\n17"), ("", "\n1000017"), ("", "\nIl."), (" \n\n", " \n \n"), ("", " more"), ("12", "\n ")]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    texts = [a + FILLER * n + b for a, b in ENDS for n in (0, 1, 12, 300)] + ["", "e", "ab", "abc", "abcd"]
    made = [(i, t, "en", "s", max(0, len(t) + d)) for i, (t, d) in enumerate((t, d) for t in texts for d in (0, -3, 5, 900))] + [(9999, FILLER, "en", "s", None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", made)
    con.execute(f"COPY documents TO '{folder}/documents.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", ["facts_spans", "first_sections", "heading_roles", "marked_candidates"])
def test_query_on_odd_documents(spark, odd, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{odd}/documents.parquet'")
    check(text_queries.QUERIES[name](spark, odd), con, text_queries.ORACLE_SQL[name])


def test_a_heading_is_its_own_line():
    text = "TITLE PAGE\n\n  STATEMENT OF FACTS \n\n3\nIt rained.\n\n1000017\nARGUMENT: \n\nWe argue."
    found = S.headings(text)[0]
    assert [text[h.start : h.end] for h in found] == ["  STATEMENT OF FACTS ", "ARGUMENT: "]
    assert [h.text for h in found] == ["STATEMENT OF FACTS", "ARGUMENT"]


def test_empty_spans_open_before_they_close(spark):
    at = lambda a, b: (F.lit(a), F.lit(b))
    made = [V.marked(F.lit("abcd"), {"A": a, "B": b}) for a, b in ((at(0, 0), at(0, 4)), (at(0, 4), at(4, 4)), (at(2, 2), at(2, 2)))]
    got = spark.range(1).select(*made).first()
    assert list(got) == ["\n⟦A⟧  ⟦/A⟧\n\n⟦B⟧ abcd ⟦/B⟧\n", "\n⟦A⟧ abcd ⟦/A⟧\n\n⟦B⟧  ⟦/B⟧\n", "ab\n⟦A⟧  ⟦/A⟧\n\n⟦B⟧  ⟦/B⟧\ncd"]
