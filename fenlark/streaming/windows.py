"""Event-time windows, the same for batch and streaming frames, and a circuit breaker with state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _timed(df: DataFrame, late: str | None) -> DataFrame:
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    return df.withWatermark("ts", late) if late and df.isStreaming else df


def tumbling(df: DataFrame, length: str, late: str | None = "1 hour") -> DataFrame:
    g = _timed(df, late).groupBy(F.window("ts", length), "event_type").agg(F.count("*").alias("n"))
    return g.select(F.col("window.start").alias("start"), "event_type", "n")


def sliding(df: DataFrame, length: str, step: str, late: str | None = "1 hour") -> DataFrame:
    g = _timed(df, late).groupBy(F.window("ts", length, step), "event_type").agg(F.count("*").alias("n"))
    return g.select(F.col("window.start").alias("start"), "event_type", "n")


def sessions(df: DataFrame, gap: str, late: str | None = "1 hour") -> DataFrame:
    g = _timed(df, late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("session_window.start").alias("start"), "n")


def distinct_events(df: DataFrame, key: str, late: str = "1 hour") -> DataFrame:
    """First occurrences of the key within the watermark."""
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    return df.withWatermark("ts", late).dropDuplicatesWithinWatermark([key]) if df.isStreaming else df.dropDuplicates([key])


def circuit_breaker(df: DataFrame, failures: int = 3, rest_s: float = 60.0, late: str = "1 hour", keep_s: float = 86_400.0) -> DataFrame:
    """(user_id, ts, state) at each change: CLOSED to OPEN after so many failures in a row, HALF_OPEN
    after the rest, from there CLOSED by a success and OPEN by a failure. Streaming frames only.

    A key's rows of a micro-batch are put in order before they are worked through, whatever Arrow batches
    they come in. A key without rows for keep_s of event time is forgotten.
    """

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        now, run, opened = state.get if state.exists else ("CLOSED", 0, 0.0)
        rows, out = pd.concat(list(batches)), []
        for ts, kind in rows.sort_values(["ts", "event_type"])[["ts", "event_type"]].itertuples(index=False):
            at, was = ts.timestamp(), now
            if now == "OPEN" and at - opened >= rest_s:
                now = "HALF_OPEN"
            if kind == "error":
                run += 1
                if now == "HALF_OPEN" or (now == "CLOSED" and run >= failures):
                    now, opened = "OPEN", at
            elif now != "OPEN":
                now, run = "CLOSED", 0
            if now != was:
                out.append((key[0], ts, now))
        state.update((now, run, opened))
        last = int(rows["ts"].max().timestamp() * 1000)
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + int(keep_s * 1000))
        yield pd.DataFrame(out, columns=["user_id", "ts", "state"])

    df = df.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return df.groupBy("user_id").applyInPandasWithState(step, "user_id long, ts timestamp, state string", "now string, run int, opened double", "append", GroupStateTimeout.EventTimeTimeout)
