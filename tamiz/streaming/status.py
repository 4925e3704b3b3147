"""Change detection on streams of (key, status, ts): a row whenever a key is new or its status differs from the one before it in event time.

Rows wait in the key's state until the watermark has passed their time, and are then judged in the order of (ts, place), whatever
batch brought them. So a row that comes late, but within ``delay``, takes its place among the others, and the stream's rows are those of
a batch over all that was not too late. Keys whose status is closed leave the state ``keep`` after it, by a timer; one that comes back is new."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "key string, previous string, status string, ts timestamp"


def _ms(ts: pd.Timestamp) -> int:
    """Milliseconds, rounded up: a timer at them fires after the row's own time."""
    return -(-pd.Timestamp(ts).value // 1_000_000)


class Changes(StatefulProcessor):
    """``last``: the status judged last, and when; ``waiting``: rows that the watermark has not passed."""

    def __init__(self, closed: tuple[str, ...], keep_ms: int):
        self.closed, self.keep_ms = closed, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "status string, ms long")
        self.waiting = handle.getListState("waiting", "ts timestamp, place long, status string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            new = list(frame[["ts", "place", "status"]].itertuples(index=False, name=None))
            self.waiting.appendList([(pd.Timestamp(ts).to_pydatetime(), int(place), status) for ts, place, status in new])
            for ms in {_ms(ts) for ts, *_ in new}:
                self.handle.registerTimer(ms)
        yield pd.DataFrame(columns=["key", "previous", "status", "ts"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        held = [tuple(x) for x in self.waiting.get()]
        due, rest = [x for x in held if _ms(x[0]) <= now], [x for x in held if _ms(x[0]) > now]
        status, since = self.last.get() if self.last.exists() else (None, None)
        known, out = self.last.exists(), []
        for ts, _, new in sorted(due, key=lambda x: (x[0], x[1])):
            if not known or new != status:
                out.append((key[0], status, new, ts))
            status, since, known = new, _ms(ts), True
        if due:
            self.last.update((status, since))
            self.waiting.put(rest) if rest else self.waiting.clear()
            if status in self.closed:
                self.handle.registerTimer(since + self.keep_ms)
        elif known and status in self.closed and now >= since + self.keep_ms:
            self.last.clear()
        yield pd.DataFrame(out, columns=["key", "previous", "status", "ts"])


def changes(stream: DataFrame, delay: str = "1 hour", closed: tuple[str, ...] = ("Concluded", "Completed"), keep_days: int = 30) -> DataFrame:
    """(key, previous, status, ts) of a stream (key, status, ts, place); ``place`` orders rows of one time. The state lies in RocksDB."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    processor = Changes(tuple(closed), keep_days * 86_400_000)
    return stream.withWatermark("ts", delay).groupBy("key").transformWithStateInPandas(processor, OUT, "Append", "EventTime")
