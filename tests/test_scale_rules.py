"""Shapes that must hold at any size: tasks by rows, one scan, bounded state on disk."""

import datetime as dtm
import os

from pyspark.sql import functions as F

from encore.operators import content
from encore.operators.ranking import global_row_number
from encore.plans import registry
from encore.sources import client_log
from encore.streaming import windows as W
from encore.streaming.sinks import KEEP, KeyedUpsertSink, TopKReplaceSink, committed_batches

from .conftest import SF_SMALL


def test_ranking_tasks_follow_the_rows(spark):
    frame = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for setting in ("4", "2000"):
            spark.conf.set("spark.sql.shuffle.partitions", setting)
            out = global_row_number(frame, ["g"], [F.desc("v")], "rk")
            assert out.rdd.getNumPartitions() <= 4
            assert out.agg(F.sum("rk")).first()[0] == 2 * 500 * 501 // 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_range_features_read_the_log_once_and_split_hot_users(spark, monkeypatch):
    plans, keep = [], content.materialize
    monkeypatch.setattr(content, "materialize", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), keep(df))[1])
    plan = registry.song_features_all_days(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") == 0 and [p.count("events.parquet") for p in plans] == [1]
    # the counts are combined before the first shuffle
    assert plans[0].index("partial_count") > plans[0].index("Exchange")


def test_range_features_with_no_user_and_user_0_as_half_of_a_song(spark):
    rows = [("s", None if i % 4 == 0 else "0" if i % 4 == 1 else str(i), str(i), f"202401{i % 9 + 10}") for i in range(400)]
    log = spark.createDataFrame(rows, "SONGID string, UID string, ORDER_ID string, data_dt string")
    got = {r.data_dt: r for r in content.song_horizon_series(log, "20240110", "20240118").collect()}
    for day, r in got.items():
        seven = [x for x in rows if f"{int(day) - 7:08d}" <= x[3] <= day]
        assert r.SING_CNT == sum(x[3] == day for x in rows) and r.RCT_7_SING_CNT == len(seven)
        assert r.RCT_7_USR_CNT == len({x[1] for x in seven if x[1] is not None})


def test_records_without_a_user_are_views_and_no_visitors(spark):
    at = dtm.datetime(2024, 1, 1)
    rows = [(at, "m", "u"), (at, "m", None), (at + dtm.timedelta(seconds=1), "m", "u"), (at, "k", None)]
    recs = spark.createDataFrame(rows, "ts timestamp, mid string, uid string")
    both = {(r.mid, r.pv, r.uv) for r in W.pv_uv_counts(recs, panes=True).collect()}
    assert both == {("m", 3, 1), ("k", 1, 0)}
    for panes in (False, True):
        assert {(r.mid, r.uv) for r in W.uv_exact_counts(recs, panes=panes).collect()} == {("m", 1), ("k", 0)}
    assert {(r.mid, r.uv) for r in W.uv_batch_counts(recs).collect()} == {("m", 1), ("k", 0)}


def test_stream_twins_differ(spark):
    pv, exact, batch = (f(spark, SF_SMALL) for f in (registry.pv_sliding, registry.uv_exact, registry.uv_batch5s))
    key = ["window_start", "window_end", "mid"]
    joined = pv.join(exact.withColumnRenamed("uv", "exact"), key).join(batch.withColumnRenamed("uv", "batch"), key)
    n = joined.agg(*[F.count_if(F.expr(x)) for x in ("pv != exact", "exact != batch", "pv != batch")]).first()
    assert min(n) > 0


def test_old_boards_and_deltas_go(spark, scratch):
    sink = KeyedUpsertSink(os.path.join(scratch, "kv"), ["mid"], compact_every=2)
    end = dtm.datetime(2024, 1, 1)
    for i in range(12):
        sink(spark.createDataFrame([("m", i, end + dtm.timedelta(seconds=i))], "mid string, pv int, window_end timestamp"), i)
        sink(spark.createDataFrame([], "mid string, pv int, window_end timestamp"), i + 1) if i == 5 else None
    assert sink.read_current(spark).select("mid", "pv").collect()[0] == ("m", 11)
    assert len(committed_batches(spark, os.path.join(scratch, "kv", "snapshot"))) <= KEEP
    assert len(committed_batches(spark, os.path.join(scratch, "kv", "delta"))) < 2
    board = TopKReplaceSink(os.path.join(scratch, "board"))
    for i in range(6):
        board(spark.createDataFrame([(end, end, "a", i + 1)], "window_start timestamp, window_end timestamp, songname string, times int"), i)
    assert committed_batches(spark, os.path.join(scratch, "board")) == [3, 4, 5]


def test_compaction_waits_for_no_row(spark, scratch):
    """A batch without rows compacts what waits."""
    sink = KeyedUpsertSink(os.path.join(scratch, "kv"), ["mid"], compact_every=1)
    rows = spark.createDataFrame([("m", 1, dtm.datetime(2024, 1, 1))], "mid string, pv int, window_end timestamp")
    sink(rows, 0)
    sink(rows.limit(0), 1)
    sink(rows, 0)  # a replay of what the snapshot holds
    assert committed_batches(spark, os.path.join(scratch, "kv", "delta")) == []
    assert sink.read_current(spark).count() == 1


def test_log_write_follows_the_bytes(spark, scratch):
    lines = spark.range(3000).select(F.lit("20240101").alias("data_dt"), F.when(F.col("id") % 100 == 0, "b").otherwise("a").alias("req_type"),
                                     F.concat(F.lit("x"), F.sha2(F.col("id").cast("string"), 256)).alias("payload"))
    client_log.write_demultiplexed(lines, scratch)
    back = spark.read.parquet(scratch)
    assert back.count() == 3000 and back.inputFiles() and len(back.inputFiles()) <= 4
