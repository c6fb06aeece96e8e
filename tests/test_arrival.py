"""Arrival-time windows: they close by the clock, with or without records."""

import datetime as dtm
import os
import time

import pytest

from encore.streaming import arrival as A
from encore.streaming import jobs

SCHEMA = "ts timestamp, mid string, uid string, songid string, songname string"


class Clock:
    def __init__(self):
        self.now = 0

    def getCurrentProcessingTimeInMs(self):
        return self.now


class Expiry(Clock):
    def getExpiryTimeInMs(self):
        return self.now


class Held(dict):
    """A map or value state in memory."""

    def containsKey(self, k):
        return k in self

    def getValue(self, k):
        return self[k]

    def updateValue(self, k, v):
        self[k] = v

    def removeKey(self, k):
        self.pop(tuple(k))

    def iterator(self):
        return iter(list(self.items()))

    def exists(self):
        return "v" in self

    def update(self, v):
        self["v"] = v


class Handle:
    def __init__(self):
        self.timers = []

    def getMapState(self, *_):
        return Held()

    getValueState = getMapState

    def registerTimer(self, at):
        self.timers.append(at)


def play(arrivals, checks, window=60, slide=5):
    """Rows of the processor for arrivals (second, user) of one machine, with
    a batch at every second in ``checks``."""
    p, handle, clock, out = A.ArrivalWindows(window * 1000, slide * 1000), Handle(), Clock(), []
    p.init(handle)
    for now in checks:
        clock.now = now * 1000
        rows = [dict(uid=u, n=1) for s, u in arrivals if s == now]
        if rows:
            assert not list(p.handleInputRows(("m", 0), iter(rows), clock))
        for at in [t for t in handle.timers if t <= clock.now]:
            handle.timers.remove(at)
            info = Expiry()
            info.now = at
            out += [(r[1].timestamp(), r[4], r[5]) for r in p.handleExpiredTimer(("m", 0), clock, info)]
    return out, p, handle


def brute(arrivals, until, window=60, slide=5):
    out = []
    for end in range(slide, until + 1, slide):
        inside = [(s // slide, u) for s, u in arrivals if end - window <= s < end]
        if inside:
            out.append((float(end), len(inside), len({x for x in inside if x[1] is not None})))
    return out


def test_every_slide_is_written_until_the_last_window():
    arrivals = [(1, "a"), (1, "a"), (3, "b"), (7, "a"), (7, None), (31, "c")]
    out, p, handle = play(arrivals, range(200))
    assert out == brute(arrivals, 199)
    assert not p.counts and not p.users and not p.timer.exists() and not handle.timers  # the state is gone


@pytest.mark.parametrize("step", [1, 2, 9, 40])
def test_slow_batches_write_the_windows_they_missed(step):
    arrivals = [(s, f"u{s % 3}") for s in range(0, 120, step)] + [(300 - 300 % step, "z")]
    out, *_ = play(arrivals, range(0, 600, step))
    assert out == brute(arrivals, 599 // step * step)


def test_state_starts_again_after_an_idle_time():
    arrivals = [(2, "a"), (100, "a"), (101, "b")]
    out, *_ = play(arrivals, range(300))
    assert out == brute(arrivals, 299)


def test_a_window_closes_without_a_later_record(spark, scratch):
    """One file, then silence: every window that holds its records is written."""
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    t = dtm.datetime(2024, 1, 1)
    rows = [(t, "m1", u, "1", "s") for u in ("a", "b", "a", None)] + [(t, "m2", "a", "1", "s")]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(src)
    got = {}
    query = jobs.start_arrival_pv_uv(
        jobs.file_records(spark, src, spark.createDataFrame([], SCHEMA).schema), out, window_seconds=6, slide_seconds=2,
        trigger={"processingTime": "500 milliseconds"}, checkpoint_root=os.path.join(scratch, "ck"),
        write=lambda rows, batch_id: got.__setitem__(batch_id, rows.collect()))
    deadline = time.time() + 150
    while time.time() < deadline and sum(map(len, got.values())) < 6 and query.isActive:
        time.sleep(0.5)
    query.stop()
    assert query.exception() is None
    rows = [r for batch in got.values() for r in batch]
    ends = sorted({r["window_end"] for r in rows})
    assert len(ends) == 3 and all(b - a == dtm.timedelta(seconds=2) for a, b in zip(ends, ends[1:], strict=False))
    assert {(r["mid"], r["pv"], r["uv"]) for r in rows} == {("m1", 4, 2), ("m2", 1, 1)} and len(rows) == 6
