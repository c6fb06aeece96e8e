"""Arrival-time windows that close by the clock (SM9).

The original dashboards counted what had arrived in the last 60 seconds and
wrote the counts every 5 seconds, whether or not anything new had come.  An
aggregation in event time cannot do that: its watermark, and so its windows,
stand still while no record arrives.  Here a stateful processor keeps per
machine one row per slide and sets a processing-time timer for the end of the
current one.  When it fires, the window that ends there is written and slides
that no later window needs are dropped; as long as any is left, the timer is
set again, so an idle machine's windows run down to its last one and then its
state is gone.

Counts are those of the original: page views are records, visitors the
distinct users of each slide (its micro-batch), summed over the window; a
record without a user is a page view and no visitor.  A machine's records are
dealt over ``SHARDS`` keys by user, so a busy machine is spread over tasks;
``merge_shards`` adds their rows up.
"""

from __future__ import annotations

import datetime as dtm
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SHARDS = 8
OUTPUT = T.StructType([
    T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
    T.StructField("mid", T.StringType()), T.StructField("shard", T.IntegerType()),
    T.StructField("pv", T.LongType()), T.StructField("uv", T.LongType()),
])


def _time(ms: int) -> dtm.datetime:
    return dtm.datetime.fromtimestamp(ms / 1000, dtm.timezone.utc)


def next_end(now: int, slide: int) -> int:
    """End of the slide that holds ``now`` (all in milliseconds)."""
    return (now // slide + 1) * slide


class ArrivalWindows(StatefulProcessor):
    """State per (machine, shard): page views and visitors per slide, and the
    users seen in the current one."""

    def __init__(self, window_ms: int, slide_ms: int):
        if window_ms % slide_ms:
            raise ValueError("a window is a whole number of slides")
        self.window, self.slide = window_ms, slide_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        end = T.StructType([T.StructField("end", T.LongType())])
        self.counts = handle.getMapState("counts", end, T.StructType([T.StructField("pv", T.LongType()), T.StructField("uv", T.LongType())]))
        self.users = handle.getMapState("users", T.StructType([T.StructField("uid", T.StringType())]), end)
        self.timer = handle.getValueState("timer", end)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        end = next_end(timerValues.getCurrentProcessingTimeInMs(), self.slide)
        pv = uv = 0
        for row in rows:
            pv += row["n"]
            uid = row["uid"]
            if uid is not None:
                seen = self.users.getValue((uid,)) if self.users.containsKey((uid,)) else None
                if seen is None or seen[0] != end:
                    self.users.updateValue((uid,), (end,))
                    uv += 1
        before = self.counts.getValue((end,)) if self.counts.containsKey((end,)) else (0, 0)
        self.counts.updateValue((end,), (before[0] + pv, before[1] + uv))
        if not self.timer.exists():
            self.timer.update((end,))
            self.handle.registerTimer(end)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        # the clock may have passed several ends since the last batch
        last = max(now, timerValues.getCurrentProcessingTimeInMs() // self.slide * self.slide)
        slides = {k[0]: v for k, v in self.counts.iterator()}
        out: list[Row] = []
        end = now
        while end <= last and any(e > end - self.window for e in slides):
            inside = [v for e, v in slides.items() if end - self.window < e <= end]
            if inside:
                out.append(Row(window_start=_time(end - self.window), window_end=_time(end), mid=key[0], shard=key[1],
                               pv=sum(v[0] for v in inside), uv=sum(v[1] for v in inside)))
            end += self.slide
        for e in slides:
            if e <= end - self.window:  # no window from `end` on needs it
                self.counts.removeKey((e,))
        for uid, seen in list(self.users.iterator()):
            if seen[0] < end:
                self.users.removeKey(uid)
        if any(e > end - self.window for e in slides):
            self.timer.update((end,))
            self.handle.registerTimer(end)
        else:
            self.timer.clear()
        return iter(out)

    def close(self) -> None:
        pass


def arrival_counts(records: DataFrame, window_seconds: int = 60, slide_seconds: int = 5, shards: int = SHARDS) -> DataFrame:
    """Stream of (window_start, window_end, mid, shard, pv, uv) rows by time of
    arrival; a window's rows come when it ends, with or without new records.
    Needs the RocksDB state store (``jobs.STREAMING_CONF``)."""
    dealt = records.select("mid", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int").alias("shard"), "uid", F.lit(1).cast("bigint").alias("n"))
    return dealt.groupBy("mid", "shard").transformWithState(
        ArrivalWindows(1000 * window_seconds, 1000 * slide_seconds), OUTPUT, "append", "processingTime")


def merge_shards(rows: DataFrame) -> DataFrame:
    """One row per (window, machine): a batch step, inside ``foreachBatch``."""
    return rows.groupBy("window_start", "window_end", "mid").agg(F.sum("pv").alias("pv"), F.sum("uv").alias("uv"))
