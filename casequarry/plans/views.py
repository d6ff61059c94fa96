"""Derived inputs: legal-looking tables built from the driver's tables.

Each view is one SQL text that Spark and DuckDB both run; ``{name}`` stands for a table or
another view.  The raw documents hold no citations, headings or stamps, so the views
wrap them in known text, which makes expected results computable from the columns.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)

HEAD = "BRIEF FOR THE APPELLANT"
FACTS, ARGUMENT = "STATEMENT OF FACTS", "ARGUMENT"
TAIL = "We contend the ruling below was sound. "

VIEWS = {
    # An order's parts as its target cases.
    "targets": "SELECT DISTINCT l_orderkey AS row_id, CAST(l_partkey AS STRING) AS case_id FROM {lineitem}",
    # Coarser targets, so that rankings hit often.
    "brands": "SELECT DISTINCT l_orderkey AS row_id, p_brand AS case_id FROM {lineitem} JOIN {part} ON l_partkey = p_partkey",
    "brand_rows": """
        SELECT o_orderkey AS row_id, o_orderpriority AS doc_type_id, n AS label_cardinality,
               CASE WHEN n <= 1 THEN '1' WHEN n <= 3 THEN '2-3' WHEN n <= 7 THEN '4-7' ELSE '8+' END AS label_cardinality_bin
        FROM {orders} JOIN (SELECT row_id, count(*) AS n FROM {brands} GROUP BY row_id) sized ON o_orderkey = row_id""",
    # Documents with the parts of the order of the same number as targets.
    "text_rows": """
        SELECT doc_id AS row_id, text, n AS label_cardinality,
               CASE WHEN n <= 1 THEN '1' WHEN n <= 3 THEN '2-3' WHEN n <= 7 THEN '4-7' ELSE '8+' END AS label_cardinality_bin
        FROM {documents} JOIN (SELECT row_id, count(*) AS n FROM {targets} GROUP BY row_id) sized ON doc_id = row_id""",
    "vector_rows": "SELECT doc_id AS row_id, text, '1' AS label_cardinality_bin FROM {documents} JOIN {embeddings} ON doc_id = vec_id",
    "vector_targets": "SELECT vec_id AS row_id, CAST(label AS STRING) AS case_id FROM {embeddings}",
    # Line breaks, hyphen breaks and blanks to normalise.
    "messy": """
        SELECT doc_id, replace(replace(replace(text, ', ', '-' || chr(10)), '. ', '.  ' || chr(9) || chr(13) || chr(10) || chr(10) || chr(10) || ' '),
                               ' de ', '   de' || chr(13)) AS text
        FROM {documents}""",
    # Pages as a bad text layer shows them.
    "scans": """
        SELECT doc_id, doc_id % 7 AS page_count,
               CASE doc_id % 6
                 WHEN 0 THEN text
                 WHEN 1 THEN '   ' || chr(10)
                 WHEN 2 THEN repeat('/i255 /i17 q31 ', 40)
                 WHEN 3 THEN 'Case 1:21-cv-00123 Document 45 Filed 01/02/2021 Page 3 of 9 PageID 77' || chr(10) || 'Page 3 of 9 PageID #: 77' || chr(10) || lang
                 WHEN 4 THEN 'Case: 20-1234 Document: 9 Page: 1 Filed: 01/02/2020' || chr(10) || text
                 ELSE repeat('12 34 5678 ', 20) || source END AS text
        FROM {documents}""",
    # A brief: title, facts, argument.
    "briefs": f"""
        SELECT doc_id, 'UNKNOWN' AS doc_type_id, text AS body,
               '{HEAD}' || chr(10) || '{FACTS}' || chr(10) || text || chr(10) || '{ARGUMENT}' || chr(10)
               || repeat('{TAIL}', CAST(floor(length(text) / 30.0) AS INT) + 20) AS text
        FROM {{documents}}""",
    # Briefs of eight forms: merged, soft, with contents, factual and other introductions, authorities, short, without headings.
    "forms": """
        SELECT doc_id, doc_id % 8 AS form, CASE doc_id % 8 WHEN 3 THEN 'DISTRICT_COURT' ELSE 'FEDERAL_APPELLATE' END AS doc_type_id,
               CASE doc_id % 8
                 WHEN 0 THEN 'STATEMENT OF THE CASE' || chr(10) || body || chr(10) || 'STATEMENT OF FACTS' || chr(10) || body || chr(10) || 'ARGUMENT' || chr(10) || claim
                 WHEN 1 THEN 'FACTS OF THIS DISPUTE' || chr(10) || body || chr(10) || 'DISCUSSION OF CLAIMS' || chr(10) || claim
                 WHEN 2 THEN 'TABLE OF CONTENTS' || chr(10) || 'STATEMENT OF FACTS ........ 4' || chr(10) || 'ARGUMENT ........ 9' || chr(10) || 'A note.' || chr(10)
                   || 'STATEMENT OF FACTS' || chr(10) || body || chr(10) || 'ARGUMENT' || chr(10) || claim
                 WHEN 3 THEN 'INTRODUCTION' || chr(10) || body || chr(10) || 'ARGUMENT' || chr(10) || claim
                 WHEN 4 THEN 'INTRODUCTION' || chr(10) || body || chr(10) || 'ARGUMENT' || chr(10) || claim
                 WHEN 5 THEN 'TABLE OF AUTHORITIES' || chr(10) || 'Roe v. Doe, 1 F.3d 2' || chr(10) || 'OPENING REMARKS' || chr(10) || body || chr(10) || 'ARGUMENT' || chr(10) || claim
                 WHEN 6 THEN 'STATEMENT OF FACTS' || chr(10) || 'It rained.' || chr(10) || 'ARGUMENT' || chr(10) || claim
                 ELSE body END AS text
        FROM (SELECT doc_id, repeat('The parties met in March and the work went on. ', CAST(40 + doc_id % 11 AS INT)) AS body,
                     repeat('We argue that the ruling was sound. ', CAST(60 + doc_id % 7 AS INT)) AS claim FROM {documents}) made""",
    # Briefs of known facts, no two alike.
    "dockets": """
        SELECT doc_id, head || body || chr(10) || 'ARGUMENT' || chr(10) || repeat('We argue that the ruling was sound. ', CAST(60 + doc_id % 7 AS INT)) AS text,
               CAST(length(head) AS INT) AS s, CAST(length(head || body) AS INT) AS e
        FROM (SELECT doc_id, 'Docket ' || doc_id || chr(10) || 'STATEMENT OF FACTS' || chr(10) AS head,
                     'The parties of case ' || doc_id || ' met in March. ' || repeat('The work went on as they had agreed. ', CAST(40 + doc_id % 11 AS INT)) || 'They parted in June.' AS body
              FROM {documents}) made""",
    # A text of known places and two anchors in eight forms.
    "anchors": """
        SELECT doc_id, doc_id % 8 AS form,
               'Intro text here. On May 1, the "first anchor" begins now and goes on for long. ' || repeat('word ', CAST(doc_id % 50 AS INT)) || 'So the final anchor words end right here. Bye.' AS text,
               CASE doc_id % 8 WHEN 1 THEN 'on may 1,  the “first anchor”  BEGINS' WHEN 2 THEN 'Nothing like it stands there' WHEN 3 THEN 'On May 1, the "first anchor" begins now and wholly other words'
                 WHEN 5 THEN 'So the final anchor' ELSE 'On May 1, the "first anchor" begins' END AS first_anchor,
               CASE doc_id % 8 WHEN 4 THEN NULL WHEN 5 THEN 'On May 1, the "first' WHEN 6 THEN '"first anchor" begins now' WHEN 7 THEN 'and never the final anchor words end right here.'
                 ELSE 'the final anchor words end right here.' END AS last_anchor
        FROM {documents}""",
    # One citing sentence for each line item.
    "cited": """
        SELECT l_orderkey * 10 + l_linenumber AS row_id, 100 + l_partkey % 400 AS volume, 1 + l_suppkey AS page, l_linenumber AS n,
               'The panel agreed. Roe v. Doe, ' || (100 + l_partkey % 400) || ' F. 3d ' || (1 + l_suppkey) || ' (9th Cir. 2001), so held.'
               || CASE WHEN l_linenumber % 3 = 0 THEN ' Id. at ' || l_linenumber || '.' ELSE '' END
               || CASE WHEN l_linenumber % 4 = 0 THEN ' Compare 28 U.S.C. § 1331.' ELSE '' END AS text
        FROM {lineitem}""",
    "cite_cache": """
        SELECT normalized, CASE WHEN h % 3 = 0 THEN 'c' || (h % 50) END AS resolved_id,
               CASE WHEN h % 3 = 0 THEN 'resolved' ELSE 'unresolved' END AS resolution_status, 1.0 AS confidence,
               CASE WHEN h % 11 = 0 THEN 'resolver-0' ELSE 'resolver-1' END AS resolver_version
        FROM (SELECT DISTINCT volume || ' F.3d ' || page AS normalized, volume * 7 + page AS h FROM {cited}) c
        WHERE h % 5 <> 4""",
    # A service's request log.
    "request_log": """
        SELECT event_id, CAST(ts AS STRING) AS ts, CASE event_id % 3 WHEN 0 THEN 'rules_v2' WHEN 1 THEN 'llm-a' ELSE 'llm-b' END AS method,
               CAST(user_id AS STRING) AS client, CAST(floor(value * 8) AS DOUBLE) / 8 AS latency_s,
               CASE WHEN event_id % 3 <> 0 THEN CAST(floor(value) AS DOUBLE) / 128 END AS cost_usd,
               CASE WHEN event_id % 4 <> 0 THEN event_id % 5 = 0 END AS escalated,
               CASE WHEN event_id % 7 <> 0 THEN event_id % 2 = 0 END AS span_found, event_id % 6 <> 0 AS validation_ok,
               CASE WHEN event_id % 2 = 0 THEN 'empty_facts' ELSE '' END AS flag_1,
               CASE WHEN event_id % 5 = 0 THEN 'unsupported_citation:' || event_id ELSE '' END AS flag_2,
               CASE WHEN event_type = 'error' OR event_id % 17 = 0 THEN 'Timeout in ' || event_type END AS error
        FROM {events}""",
    # Extractions of two methods against references, with flat spans.
    "evals": """
        SELECT CAST(doc_id AS STRING) AS gold_id, m AS method, CASE WHEN doc_id % 5 = 0 THEN 'no_facts_span' ELSE 'audit_set' END AS source, lang AS stratum_lang,
               doc_id % 3 <> 0 AS is_gold, CASE WHEN doc_id % 4 <> 1 THEN doc_id % 6 <> 0 END AS gold_has_facts,
               CASE WHEN doc_id % 6 <> 0 THEN n_chars % 97 END AS r_start, CASE WHEN doc_id % 6 <> 0 THEN n_chars % 97 + n_chars + 1 END AS r_end,
               CASE WHEN (doc_id + k) % 5 <> 0 THEN n_chars % 89 + k END AS p_start, CASE WHEN (doc_id + k) % 5 <> 0 THEN n_chars % 89 + n_chars + 2 - (doc_id + k) % 9 END AS p_end,
               CASE doc_id % 4 WHEN 0 THEN 'correct' WHEN 1 THEN 'partially_correct' WHEN 2 THEN 'incorrect' END AS human_rating,
               CASE WHEN doc_id % 23 = k THEN 'timeout' END AS error, (doc_id + k) % 3 <> 0 AS validation_ok,
               CASE WHEN (doc_id + k) % 7 = 0 THEN 'empty_facts' ELSE '' END AS flag_1,
               CASE WHEN (doc_id + k) % 8 = 0 THEN 'unsupported_citation:' || doc_id ELSE '' END AS flag_2,
               CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id % 10 AS DOUBLE) / 10 END AS citation_fidelity, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id % 10 AS DOUBLE) / 10 END AS citation_support,
               CAST(doc_id % 6 AS INT) AS n_citations, CAST(doc_id % 2 AS INT) AS n_nonverbatim_citations, CAST(doc_id % 3 AS INT) AS n_parties, CAST(doc_id % 8 AS INT) AS n_key_events,
               CAST(doc_id % 5 AS INT) AS n_record_cites, CAST(doc_id % 4 AS INT) AS n_case_cites, (doc_id + k) % 2 = 0 AS has_posture,
               CASE WHEN doc_id % 3 = 0 THEN 'merged_2_sections' ELSE '' END AS note_1, CASE WHEN k = 0 THEN 'high' ELSE 'low' END AS pred_confidence,
               CASE WHEN k = 1 THEN CAST(doc_id % 100 AS DOUBLE) / 100 END AS cost_usd, CAST(doc_id % 50 AS DOUBLE) / 4 AS latency_s
        FROM {documents} CROSS JOIN (SELECT 'rules_v2' AS m, 0 AS k UNION ALL SELECT 'llm-a' AS m, 1 AS k) methods""",
    # Search hits with short descriptions.
    "hits": """
        SELECT o_orderkey AS id,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE
                 CASE o_orderkey % 20 WHEN 0 THEN 'Appellant Opening Brief' WHEN 1 THEN 'Reply Brief' WHEN 2 THEN 'Brief of Amicus Curiae' WHEN 3 THEN 'Order on brief'
                   WHEN 4 THEN 'Motion for leave to file brief' WHEN 5 THEN 'Answering Brief of Respondent' WHEN 6 THEN 'Petition for Certiorari, brief' WHEN 7 THEN 'Claim construction brief'
                   WHEN 8 THEN ' notice of brief' WHEN 9 THEN 'District court brief' WHEN 10 THEN 'Brief and Appendix' WHEN 11 THEN 'Letter' WHEN 12 THEN 'BRIEF FOR APPELLEE'
                   WHEN 13 THEN 'Supreme Court merits brief' WHEN 14 THEN 'Memorandum brief' ELSE 'Brief ' || o_orderpriority END END AS short_description,
               CASE WHEN o_orderkey % 2 = 0 THEN 'Opening brief in the court of appeals' ELSE 'Exhibit list' END AS description,
               CASE o_orderkey % 8 WHEN 0 THEN 'ca9' WHEN 1 THEN 'scotus' WHEN 2 THEN 'cand' WHEN 3 THEN 'First Circuit' WHEN 4 THEN 'calctapp' WHEN 5 THEN 'texas supreme' END AS court,
               CASE WHEN o_orderkey % 8 = 7 THEN 'nysd' END AS court_id
        FROM {orders}""",
}


def _names(text: str) -> list[str]:
    return sorted({name for _, name, _, _ in Formatter().parse(text) if name})


def sql(text: str) -> str:
    """The text for an engine that has the base tables under their names; views are put in place."""
    return text.format(**{n: n if n in TABLES else f"({sql(VIEWS[n])}) AS {n}_view" if n in VIEWS else n for n in _names(text)})


def view_sql(name: str) -> str:
    return sql(VIEWS[name])


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer tasks than cores, dealt out over all of them; larger scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def view(spark: SparkSession, sf_dir: str, name: str, wide: bool = False) -> DataFrame:
    """A base table or a view over them; ``wide`` spreads the base tables for costly expressions."""
    if name in TABLES:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return spread(table) if wide else table
    text = VIEWS[name]
    return spark.sql(text, **{n: view(spark, sf_dir, n, wide) for n in _names(text)})
