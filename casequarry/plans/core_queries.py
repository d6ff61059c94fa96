"""Queries of dataset building and ranking evaluation, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry.operators import dataset as D
from casequarry.operators import ranking_eval as E
from casequarry.operators import retrieval as R
from casequarry.plans.views import view, view_sql
from casequarry.tables import parted, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLE_SQL[function.__name__] = oracle
        return function

    return add


# SQL of the split: places in each bin by MD5, then by the fractions.
def split_sql(rows: str) -> str:
    return f"""
  SELECT *, CASE WHEN place <= greatest(1, floor(size * 0.7 + 1e-9)) THEN 'train'
                 WHEN place <= greatest(1, floor(size * 0.7 + 1e-9)) + floor(size * 0.15 + 1e-9) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY label_cardinality_bin ORDER BY md5('42|' || row_id)) AS place,
               count(*) OVER (PARTITION BY label_cardinality_bin) AS size FROM {rows}) placed"""


_BRANDS = f"""
WITH truth AS ({view_sql("brands")}), named AS ({view_sql("brand_rows")}), assigned AS ({split_sql("named")}),
popular AS (
  SELECT case_id, count(*) AS votes, row_number() OVER (ORDER BY count(*) DESC, case_id) AS rank
  FROM truth JOIN assigned USING (row_id) WHERE split = 'train' GROUP BY case_id QUALIFY rank <= 50
), asked AS (SELECT * FROM assigned WHERE split = 'test'),
ranking AS (SELECT a.row_id AS query_id, p.rank, p.case_id FROM asked a CROSS JOIN popular p),
typed AS (
  SELECT doc_type_id, case_id, row_number() OVER (PARTITION BY doc_type_id ORDER BY count(*) DESC, case_id) AS rank
  FROM truth JOIN assigned USING (row_id) WHERE split = 'train' GROUP BY doc_type_id, case_id QUALIFY rank <= 50
), ranking_b AS (SELECT a.row_id AS query_id, t.rank, t.case_id FROM asked a JOIN typed t USING (doc_type_id)),
ks AS (SELECT unnest([1, 3, 5, 10, 20, 50]) AS k)"""


def scored_sql(ranking: str, name: str, asked: str = "asked", truth: str = "truth") -> str:
    """Per query and k: recall, mrr and ndcg."""
    return f"""
{name} AS (
  SELECT a.*, k,
         coalesce(h.hits, 0) / CAST(t.n_true AS DOUBLE) AS recall, coalesce(1.0 / h.first, 0.0) AS mrr,
         coalesce(h.gain, 0.0) / list_sum(list_transform(range(1, least(t.n_true, k) + 1), lambda r: 1.0 / log2(r + 1))) AS ndcg
  FROM {asked} a CROSS JOIN ks
  JOIN (SELECT row_id, count(*) AS n_true FROM {truth} GROUP BY row_id) t ON t.row_id = a.row_id
  LEFT JOIN (
    SELECT query_id, k AS at, count(*) AS hits, min(rank) AS first, sum(1.0 / log2(rank + 1)) AS gain
    FROM {ranking} JOIN {truth} ON query_id = row_id AND {truth}.case_id = {ranking}.case_id CROSS JOIN ks WHERE rank <= k GROUP BY query_id, k
  ) h ON h.query_id = a.row_id AND h.at = k
  WHERE a.row_id IN (SELECT query_id FROM {ranking})
)"""


def _brand_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Truth, training targets and test queries; the split is counted once."""
    truth = view(spark, sf_dir, "brands")
    assigned = written(D.split(view(spark, sf_dir, "brand_rows")))
    train = truth.join(assigned.where("split = 'train'").select("row_id", "doc_type_id"), "row_id")
    return truth, train, assigned.where("split = 'test'").drop("split")


def _brand_ranking(spark: SparkSession, sf_dir: str, k: int = 50) -> tuple[DataFrame, DataFrame, DataFrame]:
    truth, train, asked = _brand_inputs(spark, sf_dir)
    return R.popular_for(asked, R.popularity(train, k)), asked, truth


def _typed_ranking(train: DataFrame, asked: DataFrame, k: int = 50) -> DataFrame:
    """Popularity within the query's document type."""
    counts = train.groupBy("doc_type_id", "case_id").agg(F.count("*").cast("double").alias("score"))
    best = R.top(counts, "doc_type_id", [F.desc("score"), F.asc("case_id")], k)
    return asked.select(F.col("row_id").alias("query_id"), "doc_type_id").join(best, "doc_type_id").select("query_id", "rank", "case_id", "score")


@query(f"""
SELECT CASE WHEN n <= 1 THEN '1' WHEN n <= 3 THEN '2-3' WHEN n <= 7 THEN '4-7' ELSE '8+' END AS bin,
       count(*) AS n_rows, sum(n)::BIGINT AS n_targets, sum((n >= 1)::INT)::BIGINT AS n_kept
FROM (SELECT o_orderkey, count(t.case_id) AS n FROM orders LEFT JOIN ({view_sql("targets")}) t ON o_orderkey = t.row_id GROUP BY o_orderkey) sized
GROUP BY 1""")
def cardinality_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = view(spark, sf_dir, "targets").groupBy("row_id").agg(F.count("*").alias("n"))
    rows = view(spark, sf_dir, "orders").join(sizes, F.col("o_orderkey") == F.col("row_id"), "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    return rows.groupBy(D.cardinality_bin(F.col("n")).alias("bin")).agg(
        F.count("*").alias("n_rows"), F.sum("n").alias("n_targets"), F.count_if(F.col("n") >= 1).alias("n_kept")
    )


@query(f"""
WITH named AS ({view_sql("brand_rows")}), assigned AS ({split_sql("named")})
SELECT label_cardinality_bin, split, count(*) AS n FROM assigned GROUP BY 1, 2""")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.split(view(spark, sf_dir, "brand_rows")).groupBy("label_cardinality_bin", "split").agg(F.count("*").alias("n"))


@query(f"""
WITH named AS ({view_sql("brand_rows")}), assigned AS ({split_sql("named")})
SELECT row_id, label_cardinality_bin, split FROM assigned""")
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.split(view(spark, sf_dir, "brand_rows")).select("row_id", "label_cardinality_bin", "split")


@query("""
SELECT doc_id, substr(sha256(doc_id || '|' || source || '|' || substr(text, 1, 2000)), 1, 16) AS row_id, substr(sha1(text), 1, 16) AS doc_sha1
FROM documents""")
def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = view(spark, sf_dir, "documents")
    return docs.select("doc_id", D.row_id(F.col("doc_id"), F.col("source"), F.col("text")).alias("row_id"), D.text_sha1(F.col("text")).alias("doc_sha1"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber) = 1""")
def dedup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return D.keep_best(rows, F.col("l_orderkey"), [F.desc("l_quantity"), F.asc("l_linenumber")])


def _minhash_sql() -> str:
    """Minima of the MD5 marks of each text's shingles, one column a seed; texts of equal minima are one group."""
    marks = ", ".join(f"substr(md5('{n}:' || s), 1, 8) AS m{n}" for n in range(D.HASHES))
    least = ", ".join(f"min(m{n}) AS m{n}" for n in range(D.HASHES))
    joined = " || ".join(f"m{n}" for n in range(D.HASHES))
    return f"""
WITH cases AS (SELECT row_id, count(*) AS n FROM ({view_sql("targets")}) t GROUP BY row_id),
clean AS (SELECT doc_id, trim(lower(coalesce(text, '')), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM documents),
cut AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, length(t) - {D.SHINGLE - 2}), lambda i: substr(t, i, {D.SHINGLE})))) AS s FROM clean WHERE length(t) >= {D.SHINGLE}),
marks AS (SELECT s, {marks} FROM (SELECT DISTINCT s FROM cut)),
minima AS (SELECT doc_id, {least} FROM cut JOIN marks USING (s) GROUP BY doc_id),
named AS (SELECT doc_id, md5({joined}) AS mark FROM minima)
SELECT doc_id AS search_result_id, coalesce(n, 0)::INT AS n_targets
FROM documents LEFT JOIN named USING (doc_id) LEFT JOIN cases ON cases.row_id = doc_id
QUALIFY row_number() OVER (PARTITION BY coalesce(mark, 'none') ORDER BY coalesce(n, 0) DESC, doc_id) = 1"""


@query(_minhash_sql())
def minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = view(spark, sf_dir, "targets").groupBy("row_id").agg(F.array_sort(F.collect_set("case_id")).alias("targets"))
    docs = view(spark, sf_dir, "documents").join(cases, F.col("doc_id") == F.col("row_id"), "left")
    rows = docs.select(
        F.col("doc_id").alias("search_result_id"), F.col("text").alias("facts_text_masked"), F.coalesce("targets", F.array().cast("array<string>")).alias("targets")
    )
    return D.deduplicate(rows).select("search_result_id", F.size("targets").alias("n_targets"))


@query(f"""{_BRANDS}
SELECT rank, case_id, votes::DOUBLE AS score FROM popular""")
def popularity_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.popularity(_brand_inputs(spark, sf_dir)[1], 50).select(F.col("rank").cast("bigint").alias("rank"), "case_id", "score")


_STRATA = """
SELECT CASE WHEN grouping(label_cardinality_bin) = 0 THEN 'label_cardinality_bin' WHEN grouping(doc_type_id) = 0 THEN 'doc_type_id' ELSE 'all' END AS stratum,
       CASE WHEN grouping(label_cardinality_bin) = 0 THEN label_cardinality_bin WHEN grouping(doc_type_id) = 0 THEN doc_type_id ELSE 'all' END AS value,
       k, count(*) AS n_queries, round(avg(recall), 6) AS recall, round(avg(mrr), 6) AS mrr, round(avg(ndcg), 6) AS ndcg
FROM scored GROUP BY GROUPING SETS ((k), (k, label_cardinality_bin), (k, doc_type_id))"""


@query(f"{_BRANDS}, {scored_sql('ranking', 'scored')} {_STRATA}")
def popularity_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth, train, asked = _brand_inputs(spark, sf_dir)
    ranking = R.popularity(train, 50)
    return E.stratified(E.per_query(ranking, asked, truth), ("label_cardinality_bin", "doc_type_id"))


@query(f"{_BRANDS}, {scored_sql('ranking_b', 'scored')} {_STRATA}")
def typed_popularity_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth, train, asked = _brand_inputs(spark, sf_dir)
    return E.stratified(E.per_query(_typed_ranking(train, asked), asked, truth), ("label_cardinality_bin", "doc_type_id"))


@query(f"""{_BRANDS}
SELECT CASE WHEN rank = 1 THEN '1' WHEN rank <= 3 THEN '2-3' WHEN rank <= 5 THEN '4-5' ELSE '6-10' END AS position, count(*) AS n_hits
FROM ranking JOIN truth ON query_id = row_id AND truth.case_id = ranking.case_id WHERE rank <= 10 GROUP BY 1""")
def error_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranking, _, truth = _brand_ranking(spark, sf_dir)
    return E.hit_positions(ranking, truth)


@query(f"""{_BRANDS}
SELECT label_cardinality_bin, count(*) AS n_queries, count(*) FILTER (WHERE h.query_id IS NULL) AS n_zero_hit,
       round(count(*) FILTER (WHERE h.query_id IS NULL) / count(*), 6) AS zero_hit_rate
FROM asked LEFT JOIN (
  SELECT DISTINCT query_id FROM ranking JOIN truth ON query_id = row_id AND truth.case_id = ranking.case_id WHERE rank <= 10
) h ON h.query_id = asked.row_id GROUP BY 1""")
def failures_by_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranking, asked, truth = _brand_ranking(spark, sf_dir)
    return E.failures(ranking, asked, truth)


@query(f"""{_BRANDS}
SELECT t.case_id AS case_id, count(*) AS n_queries, count(*) FILTER (WHERE r.rank IS NULL) AS n_missed,
       round(count(*) FILTER (WHERE r.rank IS NULL) / count(*), 6) AS miss_rate
FROM (SELECT truth.row_id, truth.case_id FROM truth JOIN asked USING (row_id)) t
LEFT JOIN ranking r ON r.query_id = t.row_id AND r.case_id = t.case_id AND r.rank <= 10
GROUP BY t.case_id HAVING count(*) >= 2 ORDER BY miss_rate DESC, n_queries DESC, t.case_id LIMIT 20""")
def hardest_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranking, asked, truth = _brand_ranking(spark, sf_dir)
    return E.hardest_targets(ranking, asked, truth)


@query(f"""{_BRANDS}, {scored_sql('ranking', 'a')}, {scored_sql('ranking_b', 'b')}
SELECT count(*) FILTER (WHERE a.recall > coalesce(b.recall, 0) + 1e-9) AS a_wins, count(*) FILTER (WHERE coalesce(b.recall, 0) > a.recall + 1e-9) AS b_wins,
       count(*) FILTER (WHERE abs(a.recall - coalesce(b.recall, 0)) <= 1e-9) AS ties, count(*) AS total,
       round(count(*) FILTER (WHERE a.recall > coalesce(b.recall, 0) + 1e-9) / greatest(1, count(*)), 6) AS a_win_rate
FROM (SELECT * FROM a WHERE k = 10) a LEFT JOIN (SELECT * FROM b WHERE k = 10) b USING (row_id)""")
def model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth, train, asked = _brand_inputs(spark, sf_dir)
    first = E.per_query(R.popularity(train, 50), asked, truth)
    return E.head_to_head(first, E.per_query(_typed_ranking(train, asked), asked, truth))


@query(f"""{_BRANDS}, {scored_sql('ranking_b', 'model')}, {scored_sql('ranking', 'popularity')},
m AS (SELECT round(avg(recall), 6) AS v FROM model WHERE k = 10), p AS (SELECT round(avg(recall), 6) AS v FROM popularity WHERE k = 10)
SELECT m.v > p.v AS beats_popularity, round(m.v, 4) AS model_recall_at_k, round(p.v, 4) AS popularity_recall_at_k,
       CASE WHEN p.v > 0 THEN round((m.v - p.v) / p.v, 4) WHEN m.v > 0 THEN 'inf'::DOUBLE ELSE 0.0 END AS relative_improvement, 10 AS reference_k
FROM m, p""")
def popularity_dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth, train, asked = _brand_inputs(spark, sf_dir)
    popular = E.evaluate(E.per_query(R.popularity(train, 50), asked, truth))
    return E.dominance(E.evaluate(E.per_query(_typed_ranking(train, asked), asked, truth)), popular)


@query("SELECT lang, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY lang")
def train_minus_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casequarry.operators.downstream import without_gold

    docs = view(spark, sf_dir, "documents").withColumnRenamed("doc_id", "search_result_id")
    gold = view(spark, sf_dir, "labels").select(F.col("doc_id").alias("search_result_id"))
    return without_gold(docs, gold).groupBy("lang").agg(F.count("*").alias("n"))


@query("""
WITH mine AS (SELECT l_orderkey AS o, list_distinct(list(l_partkey)) AS a, list_distinct(list(l_suppkey)) AS b FROM lineitem GROUP BY 1)
SELECT o AS row_id, len(list_intersect(a, b))::INT AS tp, len(list_filter(a, lambda x: NOT list_contains(b, x)))::INT AS fp,
       len(list_filter(b, lambda x: NOT list_contains(a, x)))::INT AS fn FROM mine""")
def target_set_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = view(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("row_id")).agg(F.collect_set("l_partkey").alias("a"), F.collect_set("l_suppkey").alias("b"))
    return sets.select(
        "row_id", F.size(F.array_intersect("a", "b")).alias("tp"), F.size(F.array_except("a", "b")).alias("fp"), F.size(F.array_except("b", "a")).alias("fn")
    )


# SQL of the lexical model.
_STOP = ", ".join(f"'{w}'" for w in R.STOP_WORDS)


def tfidf_sql(rows: str, features: int, name: str = "sims") -> str:
    """Similarities (query_id, train_id, sim) of test rows with training rows of ``rows`` (row_id, text, split)."""
    return f"""
{name}_tokens AS (
  SELECT row_id, split, term, count(*) AS tf FROM (SELECT row_id, split, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {rows})
  WHERE term NOT IN ({_STOP}) GROUP BY 1, 2, 3
), {name}_vocab AS (
  SELECT term, ln((1.0 + (SELECT count(*) FROM {rows} WHERE split = 'train')) / (1.0 + count(*))) + 1.0 AS idf
  FROM {name}_tokens WHERE split = 'train' GROUP BY term ORDER BY sum(tf) DESC, term LIMIT {features}
), {name}_raw AS (SELECT row_id, split, term, (1.0 + ln(tf)) * idf AS w FROM {name}_tokens JOIN {name}_vocab USING (term)),
{name}_unit AS (SELECT row_id, split, term, w / sqrt(sum(w * w) OVER (PARTITION BY row_id)) AS w FROM {name}_raw),
{name} AS (
  SELECT q.row_id AS query_id, t.row_id AS train_id, round(sum(q.w * t.w), 6) AS sim
  FROM {name}_unit q JOIN {name}_unit t USING (term) WHERE q.split = 'test' AND t.split = 'train' GROUP BY 1, 2
)"""


def votes_sql(sims: str, truth: str, n: int, k: int, name: str) -> str:
    return f"""
{name} AS (
  SELECT query_id, case_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, case_id) AS rank
  FROM (
    SELECT query_id, case_id, round(sum(sim), 6) AS score
    FROM (SELECT * FROM {sims} QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, train_id) <= {n}) near
    JOIN {truth} ON {truth}.row_id = near.train_id WHERE sim > 0 GROUP BY 1, 2
  ) summed QUALIFY rank <= {k}
)"""


_TEXTS = f"WITH truth AS ({view_sql('targets')}), named AS ({view_sql('text_rows')}), assigned AS ({split_sql('named')}), asked AS (SELECT row_id FROM assigned WHERE split = 'test'), ks AS (SELECT unnest([1, 3, 5, 10, 20, 50]) AS k)"
_OUT = "SELECT query_id, rank, case_id, score FROM ranking"


def _text_inputs(spark: SparkSession, sf_dir: str, name: str = "text_rows") -> tuple[DataFrame, DataFrame]:
    rows = view(spark, sf_dir, name, wide=True)
    with parted(spark, view(spark, sf_dir, "documents").count()):
        assigned = written(D.split(rows))
    return assigned.where("split = 'train'").select("row_id", "text"), assigned.where("split = 'test'").select("row_id", "text")


def _shown(ranking: DataFrame) -> DataFrame:
    return ranking.select("query_id", F.col("rank").cast("bigint").alias("rank"), "case_id", "score")


@query(f"{_TEXTS}, {tfidf_sql('assigned', 10_000)}, {votes_sql('sims', 'truth', 50, 10, 'ranking')} {_OUT}")
def tfidf_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, asked = _text_inputs(spark, sf_dir)
    return _shown(R.tfidf(train, asked, view(spark, sf_dir, "targets"), k=10))


_MEANS = "SELECT k, count(*) AS n_queries, round(avg(recall), 6) AS recall, round(avg(mrr), 6) AS mrr, round(avg(ndcg), 6) AS ndcg FROM scored GROUP BY k"


@query(f"{_TEXTS}, {tfidf_sql('assigned', 10_000)}, {votes_sql('sims', 'truth', 100, 50, 'ranking')}, {scored_sql('ranking', 'scored')} {_MEANS}")
def tfidf_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, asked = _text_inputs(spark, sf_dir)
    truth = view(spark, sf_dir, "targets")
    return E.evaluate(E.per_query(R.tfidf(train, asked, truth, k=50, n_retrieve=100), asked.select("row_id"), truth))


def _ablation_sql() -> str:
    parts, ends = [_TEXTS], []
    for size in R.ABLATION_FEATURES:
        parts.append(tfidf_sql("assigned", size, f"s{size}"))
        for n in R.ABLATION_NEIGHBOURS:
            parts.append(votes_sql(f"s{size}", "truth", n, 50, f"r{size}_{n}"))
            parts.append(scored_sql(f"r{size}_{n}", f"m{size}_{n}"))
            ends.append(f"SELECT 'tfidf_{size}_{n}' AS model, round(avg(recall), 6) AS recall, round(avg(mrr), 6) AS mrr, round(avg(ndcg), 6) AS ndcg FROM m{size}_{n} WHERE k = 10")
    return ", ".join(parts) + " UNION ALL ".join(ends)


def _model_means(rankings: DataFrame, truth: DataFrame) -> DataFrame:
    """Means at ten of rankings named in ``model``."""
    queries = rankings.select("model", "query_id").distinct().select(F.concat_ws("|", "model", "query_id").alias("row_id"), "model", F.col("query_id").alias("q"))
    keyed = rankings.withColumn("query_id", F.concat_ws("|", "model", "query_id"))
    wanted = queries.join(truth.withColumnRenamed("row_id", "q"), "q").select("row_id", "case_id")
    means = E.per_query(keyed, queries.select("row_id", "model"), wanted, (10,)).groupBy("model")
    return means.agg(*(F.round(F.avg(m), 6).alias(m) for m in ("recall", "mrr", "ndcg")))


@query(_ablation_sql())
def tfidf_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, asked = _text_inputs(spark, sf_dir)
    truth = view(spark, sf_dir, "targets")
    return _model_means(R.ablation(train, asked, truth), truth)


_VECTORS = f"""WITH truth AS ({view_sql('vector_targets')}), named AS ({view_sql('vector_rows')}), assigned AS ({split_sql('named')}),
vectors AS (SELECT row_id, split, embedding::DOUBLE[] AS v FROM assigned JOIN embeddings ON row_id = vec_id),
dense AS (
  SELECT q.row_id AS query_id, t.row_id AS train_id, round(list_cosine_similarity(q.v, t.v), 6) AS sim
  FROM vectors q CROSS JOIN vectors t WHERE q.split = 'test' AND t.split = 'train'
)"""


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Training and test rows with text, and their vectors."""
    vectors = view(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("vector"))
    train, asked = _text_inputs(spark, sf_dir, "vector_rows")
    return train, asked, vectors.join(train.select("row_id"), "row_id"), vectors.join(asked.select("row_id"), "row_id")


@query(f"{_VECTORS}, {votes_sql('dense', 'truth', 50, 10, 'ranking')} {_OUT}")
def dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, train, asked = _vectors(spark, sf_dir)
    return _shown(R.dense(train, asked, view(spark, sf_dir, "vector_targets"), k=10))


_HYBRID = """
hybrid AS (
  SELECT query_id, train_id, round(0.5 * lex + 0.5 * den + 1e-9, 6) AS sim FROM (
    SELECT query_id, train_id,
      CASE WHEN max(lex) OVER w - min(lex) OVER w < 1e-9 THEN 0.0 ELSE (lex - min(lex) OVER w) / (max(lex) OVER w - min(lex) OVER w) END AS lex,
      CASE WHEN max(den) OVER w - min(den) OVER w < 1e-9 THEN 0.0 ELSE (den - min(den) OVER w) / (max(den) OVER w - min(den) OVER w) END AS den
    FROM (SELECT d.query_id, d.train_id, d.sim AS den, coalesce(s.sim, 0.0) AS lex FROM dense d LEFT JOIN sims s USING (query_id, train_id)) both_
    WINDOW w AS (PARTITION BY query_id)) stretched
)"""


def _both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with text and vector."""
    train, asked, train_vectors, asked_vectors = _vectors(spark, sf_dir)
    return train.join(train_vectors, "row_id"), asked.join(asked_vectors, "row_id")


@query(f"{_VECTORS}, {tfidf_sql('assigned', 10_000)}, {_HYBRID}, {votes_sql('hybrid', 'truth', 50, 10, 'ranking')} {_OUT}")
def hybrid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(R.hybrid(*_both(spark, sf_dir), view(spark, sf_dir, "vector_targets"), k=10))


def _hybrid_ablation_sql() -> str:
    parts, ends = [f"{_VECTORS}, {tfidf_sql('assigned', 10_000)}, asked AS (SELECT row_id FROM assigned WHERE split = 'test'), ks AS (SELECT 10 AS k)"], []
    for i, alpha in enumerate(R.ABLATION_ALPHAS):
        mixed = _HYBRID.replace("hybrid AS", f"hybrid{i} AS").replace("0.5 * lex + 0.5 * den", f"{alpha} * lex + {1 - alpha} * den")
        parts += [mixed, votes_sql(f"hybrid{i}", "truth", 50, 50, f"r{i}"), scored_sql(f"r{i}", f"m{i}")]
        ends.append(f"SELECT 'hybrid_{alpha}' AS model, round(avg(recall), 6) AS recall, round(avg(mrr), 6) AS mrr, round(avg(ndcg), 6) AS ndcg FROM m{i}")
    return ", ".join(parts) + " UNION ALL ".join(ends)


@query(_hybrid_ablation_sql())
def hybrid_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = view(spark, sf_dir, "vector_targets")
    rankings = R.hybrid_ablation(*_both(spark, sf_dir), truth)
    return _model_means(rankings, truth)


_RERANK = """
first AS (SELECT query_id, train_id FROM sims WHERE sim > 0 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, train_id) <= 100),
again AS (SELECT dense.* FROM dense JOIN first USING (query_id, train_id))"""


@query(f"{_VECTORS}, {tfidf_sql('assigned', 10_000)}, {_RERANK}, {votes_sql('again', 'truth', 100, 10, 'ranking')} {_OUT}")
def rerank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(R.rerank(*_both(spark, sf_dir), view(spark, sf_dir, "vector_targets"), k=10))
