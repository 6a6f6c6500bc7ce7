"""Circuit breakers and token buckets by event time: what a key's calls lead to, the same for streams and tables."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.scratch import written

CHANGES = "key string, ts timestamp, state string"
_START = ("CLOSED", 0, 0)
BLOCK = 20_000  # calls of a key that one task works through
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def followed(state: tuple, calls: Iterator[tuple[int, bool]], failures: int, rest: int, upto: int | None) -> tuple[tuple, list[tuple[int, str]]]:
    """The state after calls (microseconds, failed) in order, and the changes on the way, those of the time until `upto` included.

    So many failures in a row open a breaker; what comes while it is open isn't a call. After the rest it is
    half open, at that very time; from there a success closes and a failure opens it.
    """
    now, run, opened = state
    out = []
    for at, failed in calls:
        if now == "OPEN" and at >= opened + rest:
            now = "HALF_OPEN"
            out.append((opened + rest, now))
        if now == "OPEN":
            continue
        was = now
        run = run + 1 if failed else 0
        if failed and (now == "HALF_OPEN" or run >= failures):
            now, opened = "OPEN", at
        elif not failed:
            now = "CLOSED"
        if now != was:
            out.append((at, now))
    if now == "OPEN" and (upto is None or upto >= opened + rest):
        now = "HALF_OPEN"
        out.append((opened + rest, now))
    return (now, run, opened), out


def _frame(key: str, changes: list[tuple[int, str]]) -> pd.DataFrame:
    return pd.DataFrame({"key": [key] * len(changes), "ts": pd.to_datetime([c[0] for c in changes], unit="us"), "state": [c[1] for c in changes]})


class Breaker(StatefulProcessor):
    """A breaker a key. Calls wait in state until the watermark has passed them, and so come in order whatever
    micro-batches brought them; timers wake the key for them, for the end of a rest, and to be forgotten."""

    def __init__(self, failures: int, rest: int, keep: int):
        self.failures, self.rest, self.keep = failures, rest, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", "state string, run int, opened long, last long")
        self.calls = handle.getListState("calls", "at long, failed boolean")

    def handleInputRows(self, key, rows, timerValues):
        new = [(int(t.value // 1000), bool(f)) for x in rows for t, f in zip(x["ts"], x["failed"], strict=True)]
        self.calls.appendList(new)
        self.handle.registerTimer(max(at for at, _ in new) // 1000 + 1)
        yield from self._worked(key[0], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._worked(key[0], timerValues.getCurrentWatermarkInMs())

    def _worked(self, key: str, watermark: int) -> Iterator[pd.DataFrame]:
        upto = watermark * 1000
        *state, last = self.now.get() if self.now.exists() else (*_START, 0)
        held = sorted(self.calls.get()) if self.calls.exists() else []
        due = [c for c in held if c[0] <= upto]
        state, out = followed(tuple(state), ((at, failed) for at, failed in due), self.failures, self.rest, upto)
        if due:
            last = due[-1][0]
            left = [tuple(c) for c in held if c[0] > upto]
            if left:
                self.calls.put(left)
            else:
                self.calls.clear()
        if last and len(held) == len(due) and state[0] == "CLOSED" and upto >= last + self.keep:
            self.now.clear()
        else:
            self.now.update((*state, last))
            wake = [(state[2] + self.rest) // 1000 + 1] if state[0] == "OPEN" else []
            for t in [*wake, *([(last + self.keep) // 1000 + 1] if due else [])]:
                self.handle.registerTimer(t)
        if out:
            yield _frame(key, out)


def breaker_changes(calls: DataFrame, failures: int = 3, rest_s: float = 60.0, late: str = "1 hour", keep_s: float = 86_400.0) -> DataFrame:
    """(key, ts, state) at each change of a key's breaker, from calls (key, ts, failed).

    For a stream, state is kept by transformWithState in RocksDB, calls later than `late` are left out and a
    closed key without calls for keep_s is forgotten. For a table the calls are sorted by key and time and
    worked through as they stream by, so that no key is held; time goes on after the last call.
    Rows without key or time take no part, a null `failed` is a success, other columns are ignored.
    """
    rest = int(rest_s * 1_000_000)
    calls = calls.select(F.col("key").cast("string").alias("key"), F.col("ts").cast("timestamp").alias("ts"), F.coalesce(F.col("failed"), F.lit(False)).alias("failed")).where("key is not null and ts is not null")
    if calls.isStreaming:
        calls.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
        return calls.withWatermark("ts", late).groupBy("key").transformWithStateInPandas(Breaker(failures, rest, int(keep_s * 1_000_000)), CHANGES, "append", "EventTime")

    def work(batches):
        key, state, calls_of = None, _START, []
        schema = pa.schema([("key", pa.string()), ("at", pa.int64()), ("state", pa.string())])

        def rows(k, changes):
            return pa.RecordBatch.from_arrays([pa.array([k] * len(changes), pa.string()), pa.array([c[0] for c in changes], pa.int64()), pa.array([c[1] for c in changes], pa.string())], schema=schema)

        for batch in batches:
            keys = batch.column("key").to_pylist()
            each = list(zip(batch.column("at").to_pylist(), batch.column("failed").to_pylist(), strict=True))
            low = 0
            for high in range(1, len(keys) + 1):
                if high < len(keys) and keys[high] == keys[low]:
                    continue
                if keys[low] != key:
                    if key is not None:
                        yield rows(key, followed(state, (), failures, rest, None)[1])
                    key, state = keys[low], _START
                calls_of = each[low:high]
                state, out = followed(state, calls_of, failures, rest, calls_of[-1][0])
                yield rows(key, out)
                low = high
        if key is not None:
            yield rows(key, followed(state, (), failures, rest, None)[1])

    ordered = calls.select("key", F.unix_micros("ts").alias("at"), "failed").repartition("key").sortWithinPartitions("key", "at", "failed")
    return ordered.mapInArrow(work, "key string, at long, state string").select("key", F.timestamp_micros("at").alias("ts"), "state")


# token buckets


def _after(pieces: list[tuple], more: int, cost: int, full: int) -> list[tuple]:
    """Pieces (low, high, at, slope) of a function of the first credit, `at` its value at low, after `more` credit came in, of
    which what reaches the brim is the brim, and one call: where the credit is enough, its cost goes."""
    parts = []
    for low, high, at, slope in pieces:
        at = min(at + more, full)
        slope = slope if at < full else 0
        # from the cut on, credits are at the brim, or else enough
        for edge, to in ((full, (full - cost if full >= cost else full, 0)), (cost, (0, slope))):
            cut = low + edge - at
            if slope and at < edge < at + high - low:
                parts.append((cut, high, *to))
                high = cut
        parts.append((low, high, at - cost if at >= cost else at, slope))
    out = []
    for low, high, at, slope in sorted(parts):
        # neighbours that do the same are one
        if out and out[-1][3] == slope and out[-1][2] + slope * (low - out[-1][0]) == at:
            out[-1] = (out[-1][0], high, *out[-1][2:])
        else:
            out.append((low, high, at, slope))
    return out


def composed(times: np.ndarray, cost: int, full: int) -> np.ndarray:
    """What a block of calls makes of the credit that its first call finds: intervals of credit, each with a shift or a fixed result.

    While every credit is under one token and calls come within a token's time, a credit is under one token after each
    call, so that only what came in modulo a token counts: such calls are one step.
    """
    wide = [*(np.flatnonzero(np.diff(times) > cost) + 1).tolist(), len(times)]
    times = times.tolist()
    pieces, last, i = [(0, full + 1, 0, 1)], times[0], 0
    while i < len(times):
        pieces, last, i = _after(pieces, min(times[i] - last, full), cost, full), times[i], i + 1
        end = wide[bisect_left(wide, i)]
        if end > i and 2 * cost <= full and max(at + slope * (high - low - 1) for low, high, at, slope in pieces) < cost:
            pieces, last, i = _after(pieces, (times[end - 1] - last) % cost, cost, full), times[end - 1], end
    return np.array([(low, high, at - low if slope else 0, -1 if slope else at) for low, high, at, slope in pieces], np.int64)


def admitted(calls: DataFrame, capacity: int, every_s: float, block: int = BLOCK) -> DataFrame:
    """(key, id, ts, admitted) of calls (key, id, ts): a token bucket a key, full at first, refilled by one token in every_s seconds.

    Calls are taken by time, then id. A token is so many microseconds of credit, so that all is exact. Calls are
    dealt by ranges of key and time and cut in blocks; what a block makes of any credit is a function
    of few pieces, and a key's functions, a row a block, are applied one after the other. With the credit
    that each block then finds, its calls are worked through: a hot key is many tasks' work. Rows without
    key or time take no part; rows of equal key, time and id are calls of their own.
    """
    cost, full = int(every_s * 1_000_000), int(every_s * 1_000_000) * capacity
    rows = calls.select(F.col("key").cast("string").alias("key"), "id", F.col("ts").cast("timestamp").alias("ts")).where("key is not null and ts is not null").withColumn("at", F.unix_micros("ts"))
    ranged = rows.repartitionByRange("key", "at", "id").sortWithinPartitions("key", "at", "id").withColumn("_p", F.spark_partition_id())
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema) + ", block long, place int"

    def cut(batches):
        key, number, place = None, -1, 0
        for batch in batches:
            keys, p = batch.column("key").to_pylist(), batch.column("_p").to_pylist()
            out, at = [], []
            for k, part in zip(keys, p, strict=True):
                if k != key or place + 1 >= block:
                    key, number, place = k, number + 1, -1
                place += 1
                out.append((part << 32) | number)
                at.append(place)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64()), pa.array(at, pa.int32())], names=[*batch.schema.names, "block", "place"])

    blocks = written(ranged.mapInArrow(cut, kinds).drop("_p"))

    def function(key: tuple, table: pa.Table) -> pa.Table:
        times = np.sort(table.column("at").to_numpy())
        pieces = composed(times, cost, full)
        named = pa.array(pieces.ravel(), pa.int64())
        return pa.table({"block": key, "key": table.column("key")[:1].combine_chunks(), "first": pa.array(times[:1]), "last": pa.array(times[-1:]), "pieces": pa.ListArray.from_arrays(pa.array([0, len(named)], pa.int32()), named)})

    def credits(batches):
        key = last = credit = None
        for batch in batches:
            out = []
            for k, first, end, flat in zip(*(batch.column(c).to_pylist() for c in ("key", "first", "last", "pieces")), strict=True):
                credit = full if k != key else min(full, credit + first - last)
                out.append(credit)
                pieces = np.array(flat, np.int64).reshape(-1, 4)
                _, _, shift, fixed = pieces[np.searchsorted(pieces[:, 0], credit, "right") - 1].tolist()
                credit, key, last = (fixed if fixed >= 0 else credit + shift), k, end
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.int64())], names=["block", "credit"])

    functions = blocks.groupBy("block").applyInArrow(function, "block long, key string, first long, last long, pieces array<long>")
    found = functions.repartition("key").sortWithinPartitions("key", "first", "block").mapInArrow(credits, "block long, credit long")

    def worked(batches):
        last_block = last = credit = None
        for batch in batches:
            out = []
            for b, at, start in zip(*(batch.column(c).to_pylist() for c in ("block", "at", "credit")), strict=True):
                credit = start if b != last_block else min(full, credit + at - last)
                last_block, last = b, at
                out.append(credit >= cost)
                credit -= cost * out[-1]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("id"), batch.column("ts"), pa.array(out, pa.bool_())], names=["key", "id", "ts", "admitted"])

    each = blocks.join(found, "block").repartition("block").sortWithinPartitions("block", "place")
    return each.mapInArrow(worked, f"key string, id {rows.schema['id'].dataType.simpleString()}, ts timestamp, admitted boolean")
