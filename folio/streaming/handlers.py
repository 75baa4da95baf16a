"""Log handlers over streams: what a handler writes, with the state of its filters held per key until it can change nothing more.

Records wait in the state until the watermark has passed them and are then taken in the order of their times, so the result is that of operators/logs.handled() on the same records, whatever order they
came in; only records behind the watermark are lost. Duplicates are told per key: once the watermark is past the stretch in which a repeat would be dropped, the key's state goes. Sampling and rates are of the whole
handler: one key that keeps three numbers, and sees what the duplicates' filter lets through. Needs the RocksDB state store (spark.sql.streaming.stateStore.providerClass)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from folio.operators import logs

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TIMES = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
OUT = "ts timestamp, tie long, line string"


def _ms(us: int) -> int:
    """The first millisecond that is not before a time."""
    return -(-us // 1000)


class InOrder(StatefulProcessor):
    """Hands each key's records, once the watermark has passed them, to mark(us, state) -> (kept, state) in the order of time and tie."""

    #: The numbers that the key's state holds.
    FIELDS = "last long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "us long, tie long, line string")
        self.state = handle.getValueState("state", self.FIELDS)

    def mark(self, us: int, state: tuple | None) -> tuple[bool, tuple]:
        raise NotImplementedError

    def done(self, state: tuple) -> int | None:
        """The time from which the state changes nothing, if there is one."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            held = list(zip(part["us"].tolist(), part["tie"].tolist(), part["line"].tolist()))
            self.rows.appendList(held)
            first = min([us for us, _, _ in held] + ([] if first is None else [first]))
        if first is not None:
            self.handle.registerTimer(_ms(first))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted((tuple(r) for r in self.rows.get()), key=lambda r: r[:2]) if self.rows.exists() else []
        state = tuple(self.state.get()) if self.state.exists() else None
        out, rest = [], []
        for us, tie, line in held:
            if us > now:
                rest.append((us, tie, line))
                continue
            kept, state = self.mark(us, state)
            if kept:
                out.append((us, tie, line))
        end = self.done(state) if state else None
        if state is None or (not rest and end is not None and end <= now):
            self.state.clear()
        else:
            self.state.update(state)
        if rest:
            self.rows.put(rest)
            self.handle.registerTimer(max(_ms(rest[0][0]), now // 1000 + 1))
        else:
            self.rows.clear()
            if state and end is not None and end > now:
                self.handle.registerTimer(_ms(end))
        if out:
            ts, ties, lines = zip(*out)
            yield pd.DataFrame({"ts": pd.to_datetime(list(ts), unit="us", utc=True), "tie": ties, "line": lines})

    def close(self) -> None:
        pass


class Repeats(InOrder):
    """Drops a record if less than `ttl` microseconds have passed since the last kept one of its key."""

    def __init__(self, ttl: int):
        self.ttl = ttl

    def mark(self, us, state):
        kept = state is None or us - state[0] >= self.ttl
        return kept, (us,) if kept else state

    def done(self, state):
        return state[0] + self.ttl


class Thinned(InOrder):
    """Every n-th record, then `most` in each window, for those of the two that are asked for."""

    FIELDS = "seen long, start long, n long"

    def __init__(self, every: int | None, window: int | None, most: int):
        self.every, self.window, self.most = every, window, most

    def mark(self, us, state):
        seen, start, n = state or (0, None, 0)
        seen += 1
        if self.every and seen % self.every:
            return False, (seen, start, n)
        if self.window is None:
            return True, (seen, start, n)
        if start is None or us - start > self.window:
            start, n = us, 0
        return n < self.most, (seen, start, n + 1)


def handled(
    records: DataFrame, handler: str, ts: str, tie: str, late: str, context: dict[str, str] | None = None, salt: str = "", ttl: float = logs.TTL, every: int = logs.EVERY, window: float = logs.WINDOW, most: int = logs.MOST
) -> DataFrame:
    """What a handler writes of a stream of records with a time `ts` and a whole number `tie` that orders equal times. Records more than `late` behind the latest may be lost; those without a time are."""
    micro = lambda seconds: int(round(seconds * 1e6))
    x = logs.admitted(records.where(F.col(ts).isNotNull()))
    filters = logs.HANDLERS[handler]
    for name in filters[: filters.index("duplicate")]:
        x = logs.with_context(x, context or {}) if name == "context" else logs.redacted(x, salt)
    fields = x.schema
    key = F.to_json(F.struct("logger", "level", "message", "code"))
    packed = x.select(F.col(ts).cast("timestamp").alias("ts"), key.alias("key"), F.coalesce(F.col(tie).cast("long"), F.lit(0)).alias("tie"), F.to_json(F.struct(*x.columns), {"timestampFormat": TIMES, "timestampNTZFormat": TIMES.removesuffix("XXX")}).alias("line"))
    waiting = packed.withWatermark("ts", late).withColumn("us", F.unix_micros("ts"))
    y = waiting.groupBy("key").transformWithStateInPandas(Repeats(micro(ttl)), OUT, "append", "eventTime", eventTimeColumnName="ts")
    if "sampling" in filters or "ratelimit" in filters:
        thin = Thinned(every if "sampling" in filters else None, micro(window) if "ratelimit" in filters else None, most)
        y = y.withColumns({"us": F.unix_micros("ts"), "key": F.lit("")}).groupBy("key").transformWithStateInPandas(thin, OUT, "append", "eventTime", eventTimeColumnName="ts")
    return y.select(F.from_json("line", fields, {"timestampFormat": TIMES, "timestampNTZFormat": TIMES.removesuffix("XXX")}).alias("r")).select("r.*")
