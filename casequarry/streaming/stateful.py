"""Stateful processors: rows wait as list state until the watermark has passed them, and a timer meets them in order.

Nothing that arrives within the watermark can change what was decided, so a stream's result is that of the batch operator
whatever the order of arrival.  State goes with the timer that no later row can need.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started within use the state store that list state and timers need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


class Limiter:
    """Accepts a request if fewer than ``limit`` accepted ones lie within the last ``window`` seconds; a limit of 0 or less accepts all."""

    def __init__(self, limit: int, accepted: list[float] | None = None, window: float = 60.0):
        self.limit, self.accepted, self.window = limit, deque(accepted or []), window

    def allow(self, at: float) -> bool:
        if self.limit <= 0:
            return True
        while self.accepted and at - self.accepted[0] > self.window:
            self.accepted.popleft()
        if len(self.accepted) >= self.limit:
            return False
        self.accepted.append(at)
        return True


def spent_in_order(sizes: list[int], ceiling: int) -> list[bool]:
    """Which of an hour's chunks fit its ceiling: each in turn, as long as what was spent leaves room for it."""
    left, out = ceiling, []
    for n in sizes:
        out.append(n <= left)
        left -= n if n <= left else 0
    return out


class _Ordered(StatefulProcessor):
    """Keeps rows (values after the key) until a timer says that all earlier ones are there."""

    def __init__(self, fields: str):
        self.fields = fields

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.fields)

    def keep(self, rows: Iterator[pd.DataFrame], columns: list[str], due: Callable[[pd.DataFrame], pd.Series]) -> None:
        timers: set[int] = set()
        for part in rows:
            self.waiting.appendList([tuple(r) for r in part[columns].itertuples(index=False, name=None)])
            timers |= set(due(part).astype("int64"))
        for t in timers:
            self.handle.registerTimer(int(t))

    def close(self) -> None:
        pass


class _Limited(_Ordered):
    """A client's requests; its accepted times are state until the window after the last of them has passed."""

    def __init__(self, limit: int, window: float):
        super().__init__("s double")
        self.limit, self.window = limit, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.accepted = handle.getListState("accepted", "s double")

    def handleInputRows(self, key, rows, timerValues):
        self.keep(rows, ["s"], lambda part: (part["s"] * 1000).round())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() / 1000
        seen = sorted(r[0] for r in self.waiting.get())
        due, later = [s for s in seen if s <= now], [s for s in seen if s > now]
        limiter = Limiter(self.limit, [r[0] for r in self.accepted.get()], self.window)
        allowed = [limiter.allow(s) for s in due]
        self.waiting.put([(s,) for s in later]) if later else self.waiting.clear()
        kept = [s for s in limiter.accepted if now - s <= self.window or later]
        self.accepted.put([(s,) for s in kept]) if kept else self.accepted.clear()
        if kept and not later:  # nothing else would take them away
            self.handle.registerTimer(int(1000 * (max(kept) + self.window)) + 1)
        if due:
            yield pd.DataFrame({"client": key[0], "s": due, "allowed": allowed})


def limited_stream(log: DataFrame, limit: int, late: str = "7 days", window: float = 60.0) -> DataFrame:
    """(client, s, allowed) of a stream of (client, at): the batch limiter's decisions, each once the watermark has passed the request."""
    timed = log.select("client", F.col("at").cast("timestamp").alias("at")).withWatermark("at", late)
    rows = timed.select("client", "at", F.col("at").cast("double").alias("s"))
    return rows.groupBy("client").transformWithStateInPandas(
        statefulProcessor=_Limited(limit, window), outputStructType="client string, s double, allowed boolean", outputMode="Append", timeMode="EventTime"
    )


class _Hour(_Ordered):
    """An hour's chunks, decided together once no more can come."""

    def __init__(self, per_hour: int):
        super().__init__("chunk bigint, n bigint")
        self.per_hour = per_hour

    def handleInputRows(self, key, rows, timerValues):
        self.keep(rows, ["chunk", "n"], lambda part: part["end_ms"])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        chunks = sorted((r[0], r[1]) for r in self.waiting.get())
        self.waiting.clear()
        if chunks:
            numbers, sizes = zip(*chunks, strict=True)
            yield pd.DataFrame({"chunk": numbers, "hour": key[0], "n": sizes, "fits": spent_in_order(list(sizes), self.per_hour)})


def hourly_stream(chunks: DataFrame, per_hour: int, late: str = "1 hour") -> DataFrame:
    """(chunk, hour, n, fits) of a stream of (chunk, n, at): state by UTC hour, decided when the watermark passes the hour's end."""
    timed = chunks.withWatermark("at", late)
    start = F.date_trunc("hour", "at")
    rows = timed.select("chunk", "n", "at", F.date_format(start, "yyyy-MM-dd'T'HH").alias("hour"), (F.unix_millis(start) + 3_600_000).alias("end_ms"))
    return rows.groupBy("hour").transformWithStateInPandas(
        statefulProcessor=_Hour(per_hour), outputStructType="chunk bigint, hour string, n bigint, fits boolean", outputMode="Append", timeMode="EventTime"
    )
