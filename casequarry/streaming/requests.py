"""Request logs as streams: daily summaries, the accepted-only rate limit, budgets and the cache."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casequarry.operators.running import running
from casequarry.schemas import schema
from casequarry.sources.files import exists
from casequarry.sources.versioned import BucketedTable
from casequarry.streaming.stateful import Limiter, hourly_stream, keyed_state


def read_log(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A growing folder of JSON lines; malformed lines are dropped and ``at`` is the parsed time."""
    reader = spark.readStream.schema(schema("request_log")).option("mode", "DROPMALFORMED")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_time(reader.json(path))


def with_time(log: DataFrame) -> DataFrame:
    return log.withColumn("at", F.try_to_timestamp("ts"))


def daily(log: DataFrame, late: str = "1 day") -> DataFrame:
    """Per day and method: requests, errors, found spans and cost; later than ``late`` is left out of streams.

    The same code summarises a closed log in batch, so both can be compared.
    """
    failed = F.coalesce(F.col("error"), F.lit("")) != ""
    timed = log.withWatermark("at", late) if log.isStreaming else log
    return (
        timed.groupBy(F.window("at", "1 day").alias("w"), "method")
        .agg(
            F.count("*").alias("n"),
            F.count_if(failed).alias("n_errors"),
            F.count_if(~failed & F.coalesce(F.col("span_found"), F.lit(False))).alias("n_span_found"),
            F.sum(F.when(~failed, F.col("cost_usd"))).alias("cost_usd_total"),
        )
        .select(F.col("w.start").alias("day"), "method", "n", "n_errors", "n_span_found", "cost_usd_total")
    )


def drain(stream: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Run a stream over everything that is there and return its result table, which the driver holds: for summaries and tests."""
    with keyed_state(stream.sparkSession):
        query = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return stream.sparkSession.table(name)


def limited(log: DataFrame, limit: int) -> DataFrame:
    """Adds ``allowed`` to (client, at, ...) in batch: each task reads its clients in order of time.

    A client's requests depend on each other, so they stay in one task; it keeps at most
    ``limit`` times and never a client's whole log.
    """
    order = [c for c in log.columns if c not in ("client", "at")]
    seconds = F.col("at").cast("timestamp").cast("double")
    dealt = log.withColumn("_s", seconds).repartition(F.col("client")).sortWithinPartitions("client", "_s", *order)
    columns = log.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, limiter = object(), Limiter(limit)
        for rows in batches:
            allowed = []
            for who, at in zip(rows["client"], rows["_s"], strict=True):
                if who != client:
                    client, limiter = who, Limiter(limit)
                allowed.append(limiter.allow(at))
            yield rows[columns].assign(allowed=allowed)

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in log.schema)
    return dealt.mapInPandas(run, f"{out}, allowed boolean")


def budgeted(chunks: DataFrame, per_build: int, per_hour: int, per_day: int = 25_000) -> DataFrame:
    """Adds ``allowed`` to chunks (chunk, hour, n): what fits its hour's ceiling, until the running total first exceeds the build's or the day's.

    An hour's chunks are met in order, one after another as a stream, and each that leaves no room is refused alone.  The total is a
    running sum by ranges of ``chunk``; the chunk that does not fit it and all later ones are refused.  Neither total is ever reset.
    """

    def hours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hour, left = object(), 0
        for rows in batches:
            fits = []
            for h, n in zip(rows["hour"], rows["n"], strict=True):
                if h != hour:
                    hour, left = h, per_hour
                fits.append(n <= left)
                left -= n if n <= left else 0
            yield rows.assign(fits=fits)

    dealt = chunks.select("chunk", "hour", "n").repartition("hour").sortWithinPartitions("hour", "chunk")
    return _cut(dealt.mapInPandas(hours, "chunk bigint, hour string, n bigint, fits boolean"), min(per_build, per_day))


def _cut(chunks: DataFrame, ceiling: int) -> DataFrame:
    """(chunk, hour, n, allowed): of what fits its hour, the chunks up to where the running sum passes the ceiling."""
    spent = running(chunks, ["chunk"], F.when(F.col("fits"), F.col("n")).otherwise(0), "_spent", only_below=ceiling + 1)
    within = F.coalesce(F.col("_spent") <= ceiling, F.lit(False))
    return spent.select("chunk", "hour", "n", (F.col("fits") & within).alias("allowed"))


def budgeted_stream(chunks: DataFrame, folder: str, checkpoint: str, per_build: int, per_hour: int, per_day: int = 25_000, late: str = "1 hour") -> DataFrame:
    """``budgeted`` over a stream of (chunk, n, at) whose numbers rise with the hours, written by micro-batch under ``folder`` and read back.

    Hours are decided by keyed state when the watermark has passed them.  What earlier micro-batches have spent is the sum of
    their tables, so the total needs no state of one key; a repeated micro-batch rewrites its own table.
    """
    spark = chunks.sparkSession
    kind = "chunk bigint, hour string, n bigint, allowed boolean, batch bigint, cut boolean"

    def spend(batch: DataFrame, number: int) -> None:
        before = batch.sparkSession.read.schema(kind).parquet(f"{folder}/batch=*").where(F.col("batch") < number) if number and exists(batch.sparkSession, f"{folder}/batch=*") else batch.sparkSession.createDataFrame([], kind)
        ceiling = min(per_build, per_day)
        past = before.agg(F.coalesce(F.sum(F.when(F.col("allowed"), F.col("n"))), F.lit(0)).alias("spent"), F.coalesce(F.bool_or("cut"), F.lit(False)).alias("cut")).first()
        done = _cut(batch, -1 if past.cut else ceiling - past.spent)
        asked = batch.select(F.col("chunk").alias("c"), "fits")
        # Once a chunk of an hour that had room was refused, the total is spent for good.
        marked = done.join(asked, F.col("chunk") == F.col("c")).withColumn("cut", F.col("fits") & ~F.col("allowed"))
        marked.select("chunk", "hour", "n", "allowed", F.lit(number).cast("bigint").alias("batch"), "cut").write.mode("overwrite").parquet(f"{folder}/batch={number}")

    with keyed_state(spark):
        query = hourly_stream(chunks, per_hour, late).writeStream.outputMode("append").foreachBatch(spend).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema(kind).parquet(f"{folder}/batch=*").select("chunk", "hour", "n", "allowed")


def drift_checks(evals: DataFrame, baseline: DataFrame, folder: str, checkpoint: str, thresholds: dict[str, float] | None = None) -> None:
    """After each micro-batch of evaluation rows, gate checks of all rows so far against a baseline, as one folder a batch.

    The rows are kept under ``folder``/rows by batch, so a repeated batch rewrites its own part.
    """
    from casequarry.operators import span_eval as Ev

    def check(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")
        rows = batch.sparkSession.read.parquet(f"{folder}/rows").where(F.col("batch") <= number)
        Ev.gate(Ev.summarize(rows, "method"), baseline, thresholds).write.mode("overwrite").parquet(f"{folder}/checks/batch={number}")

    evals.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def new_documents(stream: DataFrame, id_col: str, time_col: str = "at", late: str = "7 days") -> DataFrame:
    """Each document id once within the watermark."""
    return stream.withWatermark(time_col, late).dropDuplicatesWithinWatermark([id_col])


def fill_cache_stream(decided: DataFrame, folder: str, checkpoint: str, at: str, buckets: int = 64) -> BucketedTable:
    """Upsert resolver decisions of a stream into a bucketed cache; a micro-batch rewrites the buckets of its own citations and no others."""
    from casequarry.operators.resolve import fill_cache

    table = BucketedTable(decided.sparkSession, folder, "normalized", schema("citation_cache"), buckets)

    def upsert(batch: DataFrame, number: int) -> None:
        # Of several decisions about a citation the surest stays, then the least id, so that reruns agree.
        place = F.row_number().over(W.partitionBy("normalized").orderBy(F.col("confidence").desc_nulls_last(), F.col("resolved_id").asc_nulls_last(), "excluded_reason"))
        newest = batch.withColumn("_n", place).where("_n = 1").drop("_n")
        BucketedTable(batch.sparkSession, folder, "normalized", schema("citation_cache"), buckets).upsert(number, newest, lambda old, new: fill_cache(old, new, at))

    decided.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return table
