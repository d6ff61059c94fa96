"""Queries that run streams to their end, or batch forms of stateful operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry.plans.views import view, view_sql
from casequarry.streaming import requests as S
from casequarry.tables import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "request_log")
    return rows.withColumn("flags", F.filter(F.array("flag_1", "flag_2"), lambda x: x != ""))


def daily_requests_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request log written as JSON lines, read as a stream and summarised by day and method."""
    folder = new_path(spark)
    _log(spark, sf_dir).write.json(f"{folder}/log")
    name = f"daily_{uuid.uuid4().hex}"
    done = S.drain(S.daily(S.read_log(spark, f"{folder}/log"), "60 days"), name, f"{folder}/state")
    return done.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "method", "n", "n_errors", "n_span_found", F.round("cost_usd_total", 4).alias("cost_usd_total"))


def rate_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of the events table against 2 a minute for each user."""
    log = view(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("client"), F.col("ts").alias("at"), "event_id")
    return S.limited(log, 2).select("event_id", "allowed")


QUERIES |= {f.__name__: f for f in (daily_requests_stream, rate_limited)}
ORACLE_SQL["daily_requests_stream"] = f"""
SELECT substr(ts, 1, 10) AS day, method, count(*) AS n, count(error) AS n_errors, count(*) FILTER (WHERE error IS NULL AND span_found) AS n_span_found,
       round(sum(cost_usd) FILTER (WHERE error IS NULL), 4) AS cost_usd_total
FROM ({view_sql("request_log")}) r GROUP BY ALL"""
# At most two accepted in a minute: a request is accepted unless the second last accepted one is within it.
ORACLE_SQL["rate_limited"] = """
WITH RECURSIVE placed AS (
  SELECT event_id, user_id, epoch_us(ts) / 1e6 AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events
), walk AS (
  SELECT event_id, user_id, n, true AS allowed, s AS last, NULL::DOUBLE AS before FROM placed WHERE n = 1
  UNION ALL
  SELECT p.event_id, p.user_id, p.n, w.before IS NULL OR p.s - w.before > 60, CASE WHEN w.before IS NULL OR p.s - w.before > 60 THEN p.s ELSE w.last END,
         CASE WHEN w.before IS NULL OR p.s - w.before > 60 THEN w.last ELSE w.before END
  FROM walk w JOIN placed p ON p.user_id = w.user_id AND p.n = w.n + 1
)
SELECT event_id, allowed FROM walk"""
