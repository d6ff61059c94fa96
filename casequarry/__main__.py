"""``python -m casequarry COMMAND``: eval, extract, xeval, judge, downstream, gold, build, dashboard, gate, smoke.

Exit code 1: a check failed or there is nothing to compare with; 2: bad use.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casequarry.functions import citations as Cites
from casequarry.operators import build as B
from casequarry.operators import dataset as D
from casequarry.operators import downstream as Down
from casequarry.operators import extraction as X
from casequarry.operators import gold as Gold
from casequarry.operators import judge as J
from casequarry.operators import observability as Obs
from casequarry.operators import ranking_eval as E
from casequarry.operators import retrieval as R
from casequarry.operators import run_eval as Run
from casequarry.operators.methods import METHODS
from casequarry.operators import span_eval as Ev
from casequarry.plans import reports
from casequarry.schemas import ddl
from casequarry.session import session
from casequarry.sources import files


def _eval(spark, args) -> int:
    """Retrieval over a pipeline dataset: split, leak check, a model, metrics by stratum."""
    rows = D.load_dataset(spark.read.parquet(args.data), min_targets=args.min_targets).persist()  # read by every model and metric
    if not Cites.leaks(rows).isEmpty():
        print("unmasked citations in masked texts", file=sys.stderr)
        return 1
    targets = rows.select("row_id", F.explode("targets").alias("case_id"))
    texts = rows.select("row_id", F.col("facts_text_masked").alias("text"), "split", "label_cardinality_bin", "doc_type_id")
    train, asked = texts.where("split = 'train'"), texts.where("split = 'test'")
    known = targets.join(train.select("row_id"), "row_id")
    strata = asked.select("row_id", "label_cardinality_bin", "doc_type_id")
    if args.model == "ablation":
        rankings = R.ablation(train, asked, known, args.k)
        if args.vectors:
            rankings = rankings.unionByName(R.hybrid_ablation(*_with_vectors(spark, args, train, asked), known, args.k))
        rankings = rankings.withColumn("query_id", F.concat_ws("|", "model", "query_id")).persist()
        named = rankings.select("model", F.col("query_id").alias("row_id")).distinct()
        wanted = named.join(targets.withColumnRenamed("row_id", "q"), F.col("row_id") == F.concat_ws("|", "model", "q")).select("row_id", "case_id")
        means = E.per_query(rankings, named, wanted).groupBy("model", "k").agg(F.count("*").alias("n_queries"), *(F.round(F.avg(m), 6).alias(m) for m in ("recall", "mrr", "ndcg")))
        print(reports.report("Ablation", {"Metrics": means}, {"Metrics": ["model", "k"]}))
        return 0
    if args.model == "popularity":
        ranking = R.popularity(known, args.k)
    elif args.model == "tfidf":
        ranking = R.tfidf(train, asked, known, args.k, args.neighbours, args.features)
    elif args.model == "dense":
        ranking = R.dense(_vectors(spark, args, train), _vectors(spark, args, asked), known, args.k, args.neighbours)
    elif args.model == "hybrid":
        ranking = R.hybrid(*_with_vectors(spark, args, train, asked), known, args.k, args.neighbours, args.alpha)
    else:
        ranking = R.rerank(*_with_vectors(spark, args, train, asked), known, args.k, args.neighbours, args.features)
    print(reports.retrieval_report(E.stratified(E.per_query(ranking, strata, targets), ("label_cardinality_bin", "doc_type_id"))))
    return 0


def _vectors(spark, args, rows: DataFrame) -> DataFrame:
    """(row_id, vector) of rows from a table of that form; ids compare as strings."""
    return spark.read.parquet(args.vectors).select(F.col("row_id").cast("string").alias("row_id"), "vector").join(rows.select("row_id"), "row_id")


def _with_vectors(spark, args, train: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(rows.withColumn("row_id", F.col("row_id").cast("string")).join(_vectors(spark, args, rows), "row_id", "left") for rows in (train, asked))


def _xeval(spark, args) -> int:
    gold, texts = files.strict_lines(spark, args.gold, "gold"), spark.read.parquet(args.texts)
    recorded = spark.read.schema(ddl("response")).json(args.responses).withColumn("line", F.monotonically_increasing_id()) if args.responses else None
    run, _ = Run.run_eval(gold, texts, tuple(args.methods.split(",")), args.subset, args.labeled_by, args.limit, responses=recorded)
    Run.save(run, args.out, {"run_id": args.out.rstrip("/").rsplit("/", 1)[-1], "subset": args.subset, "n_docs": run.per_doc.select("gold_id").distinct().count()})
    return 0


def _judge(spark, args) -> int:
    """Verdicts by recorded replies on spans (gold_id, doc_type_id, text, span_a, span_b)."""
    recorded = spark.read.schema(ddl("response")).json(args.replies).withColumn("line", F.monotonically_increasing_id())
    cache = spark.read.parquet(args.cache) if args.cache else None
    verdicts, _ = J.run(spark.read.parquet(args.data), J.Judge(model=args.model), tuple(args.methods.split(",")), recorded, cache)
    files.write_dataset(verdicts.withColumn("model", F.lit(args.model)), args.out, "model")
    print(reports.judge_report(Gold.verdict_summary(spark.read.parquet(args.out))))
    return 0


def _downstream(spark, args) -> int:
    """Spans (method, row_id, text, start, end) as queries against a dataset, by method and paired with the first."""
    rows = D.load_dataset(spark.read.parquet(args.data), min_targets=args.min_targets).persist()  # read by every method
    spans = spark.read.parquet(args.spans)
    told = spans.select("method", F.col("row_id").cast("string").alias("row_id"), Cites.masked(Down.span_text(F.col("text"), F.col("start"), F.col("end"))).alias("text"), F.coalesce(F.col("end") > F.col("start"), F.lit(False)).alias("span_found"))
    gold = told.select(F.col("row_id").alias("search_result_id")).distinct()
    train = Down.without_gold(rows.where("split = 'train'").withColumn("search_result_id", F.col("search_result_id").cast("string")), gold)
    targets = rows.select(F.col("search_result_id").cast("string").alias("row_id"), F.explode("targets").alias("case_id"))
    known = train.select(F.col("search_result_id").alias("row_id"), F.col("facts_text_masked").alias("text"))
    scores = Down.retrieval_scores(known, targets, told.select("method", F.lit("narrative").alias("builder"), "row_id", "text"), targets, args.k)
    means = Down.retrieval_means(Down.per_document(told.drop("text"), scores))
    print(reports.downstream_report(means, Down.paired(scores, "method", args.base)))
    return 0


def _gold(spark, args) -> int:
    gold = files.strict_lines(spark, args.data, "gold")
    if args.labels:
        labels = spark.read.schema("gold_id string, rating string, has_facts boolean, gold_span array<int>, notes string, labeler string, labeled_at string").json(args.labels)
        files.write_lines(Gold.set_label(gold, labels), args.out)
        gold = files.strict_lines(spark, args.out, "gold")
    print(reports.gold_report(Gold.stats(gold)))
    return 0


def _build(spark, args) -> int:
    """Pipeline rows and failures from hits (JSON lines), texts (id, text, page_count) and a citation cache."""
    classified = B.classify(files.strict_lines(spark, args.data, "search_hit"), spark.read.parquet(args.texts), args.site, args.storage)
    cache = spark.read.schema(ddl("citation_cache")).parquet(args.cache)
    B.rows(classified, cache, args.build_id).write.mode("overwrite").parquet(f"{args.out}/rows")
    files.write_failures(B.failures(classified), f"{args.out}/failures")
    return 0


def _extract(spark, args) -> int:
    texts = files.texts(spark, args.data).select(F.col("path").alias("doc_id"), "text", F.lit(args.doc_type).alias("doc_type_id"))
    done = X.extract_documents(texts, args.method)
    files.write_lines(done.drop("doc_text"), args.out)
    return 0


def _dashboard(spark, args) -> int:
    log = files.request_log(spark, args.data)
    history = Obs.run_history(files.run_summaries(spark, args.runs)) if args.runs else None
    print(reports.dashboard(Obs.summarize_requests(log), history, Obs.top_values(log)))
    return 0


def _gate(spark, args) -> int:
    now = Ev.summarize(files.strict_lines(spark, args.data, "doc_eval"), "method")
    text, ok = reports.gate_report(Ev.gate(now, spark.read.parquet(args.baseline)))
    print(text)
    return 0 if ok else 1


def _smoke(spark, args) -> int:
    """Methods replayed from recorded responses over all gold records, compared with a kept baseline (JSON)."""
    limits = Ev.THRESHOLDS | {"iou_mean": args.iou_drop, "citation_fidelity_mean": args.fidelity_drop, "citation_support_mean": args.fidelity_drop}
    gold, texts = files.strict_lines(spark, args.gold, "gold"), spark.read.parquet(args.texts)
    recorded = spark.read.schema(ddl("response")).json(args.responses).withColumn("line", F.monotonically_increasing_id())
    known = not args.update_baseline and files.exists(spark, args.baseline)
    kind = f"method string, {', '.join(f'{m} double' for m in limits)}"
    baseline = spark.read.schema(kind).json(args.baseline) if known else None
    now, checks = Run.smoke_gate(gold, texts, recorded, tuple(args.methods.split(",")), baseline, limits)
    text, ok = reports.gate_report(checks, known or args.update_baseline)
    print(text)
    if args.summary_out:
        files.write_text(spark, text, args.summary_out)
    if args.update_baseline:
        files.write_lines(Ev.baseline_from(now, limits), args.baseline)
    elif not known:
        print(f"no baseline at {args.baseline}: make one with --update-baseline", file=sys.stderr)
        return 1
    return 0 if ok else 1


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="casequarry")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("eval")
    one.add_argument("data")
    one.add_argument("--model", choices=(*R.MODELS, "ablation"), default="tfidf")
    one.add_argument("--vectors")
    one.add_argument("--alpha", type=float, default=0.5)
    for name, value in (("--k", 50), ("--neighbours", 100), ("--features", 10_000), ("--min-targets", 1)):
        one.add_argument(name, type=int, default=value)
    one = commands.add_parser("extract")
    one.add_argument("data")
    one.add_argument("out")
    one.add_argument("--method", default="rules_v2", choices=sorted(X.EXTRACTORS))
    one.add_argument("--doc-type", default="UNKNOWN")
    one = commands.add_parser("xeval")
    for name in ("gold", "texts", "out"):
        one.add_argument(name)
    one.add_argument("--methods", default="rules_v2")
    one.add_argument("--responses")
    one.add_argument("--subset", default="labeled", choices=("labeled", "all", "smoke"))
    one.add_argument("--labeled-by", default="any", choices=("any", "human", "judge"))
    one.add_argument("--limit", type=int)
    one = commands.add_parser("judge")
    for name in ("data", "replies", "out"):
        one.add_argument(name)
    one.add_argument("--methods", default="rules_v2,llm")
    one.add_argument("--model", default="judge")
    one.add_argument("--cache")
    one = commands.add_parser("downstream")
    for name in ("data", "spans"):
        one.add_argument(name)
    one.add_argument("--base", default="rules_v2")
    for name, value in (("--k", 10), ("--min-targets", 1)):
        one.add_argument(name, type=int, default=value)
    one = commands.add_parser("gold")
    one.add_argument("data")
    one.add_argument("--labels")
    one.add_argument("--out")
    one = commands.add_parser("build")
    for name in ("data", "texts", "cache", "out"):
        one.add_argument(name)
    for name, value in (("--site", ""), ("--storage", ""), ("--build-id", "")):
        one.add_argument(name, default=value)
    one = commands.add_parser("dashboard")
    one.add_argument("data")
    one.add_argument("--runs")
    one = commands.add_parser("gate")
    one.add_argument("data")
    one.add_argument("baseline")
    one = commands.add_parser("smoke")
    for name in ("gold", "texts", "responses", "baseline"):
        one.add_argument(name)
    one.add_argument("--methods", default=",".join(METHODS))
    one.add_argument("--update-baseline", action="store_true")
    one.add_argument("--iou-drop", type=float, default=Ev.THRESHOLDS["iou_mean"])
    one.add_argument("--fidelity-drop", type=float, default=Ev.THRESHOLDS["citation_fidelity_mean"])
    one.add_argument("--summary-out")
    args = parser.parse_args(argv)
    if args.command == "eval" and args.model in ("dense", "hybrid", "rerank") and not args.vectors:
        parser.error(f"--model {args.model} needs --vectors")
    if args.command == "gold" and args.labels and not args.out:
        parser.error("--labels needs --out")
    run = {
        "eval": _eval,
        "extract": _extract,
        "xeval": _xeval,
        "judge": _judge,
        "downstream": _downstream,
        "gold": _gold,
        "build": _build,
        "dashboard": _dashboard,
        "gate": _gate,
        "smoke": _smoke,
    }[args.command]
    return run(session(), args)


if __name__ == "__main__":
    sys.exit(main())
