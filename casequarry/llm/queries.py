"""Registered queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry.llm import common as C
from casequarry.llm import conversations, decontaminate, exactdedup, langid, lexical, linededup, mixing, ngrams, passages, quality, secrets, simhash, toxicity


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(C.tables(spark, sf_dir, "documents"), C.tables(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _by_fold(docs: DataFrame, modulus: int, held: int) -> tuple[DataFrame, Column]:
    """Documents that a model may learn from, and the held-out flag."""
    held_out = C.remainder(F.col("doc_id"), modulus) == held
    return docs.where(~held_out), held_out.alias("held_out")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = C.tables(spark, sf_dir, "documents"), C.tables(spark, sf_dir, "labels")
    learn, held_out = _by_fold(docs, 3, 1)
    model = toxicity.fit(learn.select("doc_id", "text"), labels.where(C.remainder(F.col("doc_id"), 3) != 1), "toxic")
    scored = docs.select("doc_id", held_out, toxicity.scorer(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_common_lines(C.tables(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.repeated_passages(C.tables(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.concat_ws(":", "start", "end").alias("span"),
        "partner_id",
        F.concat_ws(":", "partner_start", "partner_end").alias("partner_span"),
        (F.col("equal") / F.greatest(F.col("end") - F.col("start"), F.col("partner_end") - F.col("partner_start"))).alias("identity"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(C.tables(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.tables(spark, sf_dir, "documents")
    learn, held_out = _by_fold(docs, 4, 2)
    predict = langid.predictor(langid.fit(learn))
    said = docs.select("doc_id", held_out, predict(F.col("text")).alias("p"))
    return said.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.ambiguous").alias("ambiguous"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(C.tables(spark, sf_dir, "documents"), keep="largest")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = C.tables(spark, sf_dir, "documents"), C.tables(spark, sf_dir, "labels")
    learn, held_out = _by_fold(docs, 5, 0)
    model = quality.fit(learn.select("doc_id", "text"), labels.where(C.remainder(F.col("doc_id"), 5) != 0), "quality")
    scored = docs.select("doc_id", held_out, quality.scorer(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of two commits: texts without their last line under the first two rules, then the texts as they are under all.

    The second scan takes the blobs that the ledger lacks, and of those it has only the new rule.
    """
    docs = C.tables(spark, sf_dir, "documents")
    _, *earlier = secrets.RULES
    path = C.new_path(spark)
    secrets.scan_into(docs.withColumn("text", secrets.reduced(F.col("text"))), path, tuple(earlier))
    secrets.scan_into(docs, path, secrets.RULES)
    found = secrets.spans_by_path(docs, path).withColumn("spans", secrets.span_list())
    return found.select(
        "doc_id",
        *(F.size(r.name).cast("bigint").alias(f"n_{r.name}") for r in secrets.RULES),
        F.sha2("spans", 256).alias("base_sha256"),
        "spans",
    )


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(C.tables(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = conversations.prefix_trie(conversations.branched(C.tables(spark, sf_dir, "conversations")))
    return nodes.select(*nodes.columns[:-1], F.coalesce(F.lower(F.hex("ends")), F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(C.tables(spark, sf_dir, "documents"), C.tables(spark, sf_dir, "benchmark"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.tables(spark, sf_dir, "documents")
    return ngrams.scores(docs, C.remainder(F.col("doc_id"), 5) == 1)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_toxicity,
        op3_line_dedup,
        op4_passages,
        op5_simhash,
        op6_language,
        op7_exact_dedup,
        op8_quality,
        op9_secrets,
        op10_mix,
        op11_conversation_trie,
        op12_lexical_search,
        op13_lm_score,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _secret_sql() -> str:
    """Pieces between and of the matches of each rule; their running lengths are the places."""
    parts = []
    for order, r in enumerate(secrets.RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""SELECT doc_id, '{r.name}' AS kind, {order} AS nth, {r.least} AS least, string_split_regex(t, '{pattern}') AS gaps,
         regexp_extract_all(t, '{pattern}', 0) AS wholes, regexp_extract_all(t, '{pattern}', {r.group}) AS said FROM texts""")
    return " UNION ALL ".join(parts)


#: Unsigned CRC-32 of a decimal number, bit by bit.
_CRC = """xor(list_reduce([4294967295] || list_transform(string_split({}::VARCHAR, ''), lambda c: ord(c)::BIGINT),
  lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": rf"""
WITH texts AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS said
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, greatest(0, len(w) - least(10, len(w)) + 1) + 1)) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM wanted),
windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS said
  FROM (SELECT doc_id, w, n, unnest(range(1, greatest(0, len(w) - n + 1) + 1)) AS i FROM texts CROSS JOIN sizes)
), hits AS (SELECT doc_id, i, n, item FROM windows JOIN wanted USING (n, said)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS said FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(said, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op9_secrets": f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), raw AS ({_secret_sql()}),
pieces AS (SELECT doc_id, kind, nth, least, i, length(gaps[i]) AS gap, length(wholes[i]) AS whole, length(said[i]) AS size
           FROM (SELECT *, unnest(range(1, len(wholes) + 1)) AS i FROM raw)),
placed AS (SELECT *, sum(gap + whole) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM pieces),
kept AS (SELECT doc_id, kind, nth, (stop - whole)::BIGINT AS start, stop::BIGINT AS stop FROM placed WHERE size >= least),
told AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS b, count(*) FILTER (WHERE kind = 'hex') AS c,
                string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nth) AS spans FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN told USING (doc_id)
""",
    "op3_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, line, pos,
         {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k
  FROM lines
), common AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT doc_id, line, pos, k IN (SELECT k FROM common) AS gone FROM keyed
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op7_exact_dedup": f"""
WITH norm AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM norm WINDOW w AS (PARTITION BY t)
""",
    "op10_mix": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, 3 * source_size AS lim,
         [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight
  FROM sources
), levels AS (
  SELECT *, lim / weight AS turn,
         (sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / weight, source IS NULL, source
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (ORDER BY lim / weight, source IS NULL, source
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed
), goals AS (
  SELECT source, source_size,
         least(lim::DOUBLE, coalesce(weight * max(level) FILTER (WHERE level <= turn) OVER (), lim::DOUBLE)) AS target
  FROM levels
), ranked AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(s.source, '(null)')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) AS r
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       (least(floor(rate * r + u) - floor(rate * (r - 1) + u), 3) * size)::BIGINT AS taken
FROM ranked
""",
    "op11_conversation_trie": f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), left(coalesce(text, ''), 32), md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC.format("conv_id")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, t.i AS place, k, strlen(t) AS size FROM convs c JOIN turns t ON t.conv_id = c.base AND t.i <= c.h
  UNION ALL
  SELECT c.conv_id, t.i + 9, k, strlen(t) FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.h
), prefixes AS (
  SELECT conv_id, row_number() OVER w AS d, size, md5(string_agg(k, '') OVER w) AS node FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY place)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), placed AS (SELECT *, lag(node) OVER w AS parent, lead(node) OVER w IS NULL AS final FROM prefixes WINDOW w AS (PARTITION BY conv_id ORDER BY d)),
nodes AS (
  SELECT node, d, parent, min(conv_id) AS least, count(*) AS n, min(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE final), '')) AS ends
  FROM placed GROUP BY node, d, parent
), kids AS (SELECT parent AS node, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY parent),
below AS (
  SELECT p.node, sum((n.n - 1) * n.size) AS saved, count(*) FILTER (WHERE kids IS NULL) AS leaves
  FROM nodes n JOIN prefixes p ON p.conv_id = n.least AND p.d <= n.d LEFT JOIN kids k ON k.node = n.node GROUP BY p.node
)
SELECT n.least AS conv_id, n.d AS depth, p.least AS parent_conv_id, n.n AS n_convs, coalesce(kids, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves,
       saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.parent = p.node LEFT JOIN kids k ON k.node = n.node JOIN below b ON b.node = n.node
""",
    "op12_lexical_search": rf"""
WITH texts AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
total AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS docs, sum(len(w))::BIGINT AS words FROM texts),
posted AS (SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, len(w) AS n, unnest(w) AS term FROM texts) GROUP BY ALL),
rarity AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM posted CROSS JOIN total GROUP BY term, docs),
asked AS (
  SELECT no, item_id, term, count(*) AS qtf
  FROM (SELECT no, item_id, unnest({_TERMS.format(_LOWER.format("coalesce(text, '')"))}) AS term FROM (SELECT *, row_number() OVER () AS no FROM (SELECT DISTINCT item_id, text FROM benchmark)))
  GROUP BY ALL
), scored AS (
  SELECT no, item_id, d, doc_id, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN posted USING (term) JOIN rarity USING (term) CROSS JOIN total GROUP BY no, item_id, d, doc_id
)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 20
""",
}
