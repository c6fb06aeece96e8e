"""Streaming counts: golden rows, stream == batch twin, idempotent sinks."""

import datetime as dtm
import os

from pyspark.sql import functions as F

from encore.sources import driver_tables as dt
from encore.streaming import jobs
from encore.streaming import windows as W
from encore.streaming.sinks import KeyedUpsertSink, read_latest

from .conftest import SF_SMALL

T0 = dtm.datetime(2024, 1, 1, 0, 0, 0)


def _records(spark, rows):
    data = [(T0 + dtm.timedelta(seconds=s), m, u, "1", "song-1") for s, m, u in rows]
    return spark.createDataFrame(data, "ts timestamp, mid string, uid string, songid string, songname string")


def test_golden_pv_uv(spark):
    recs = _records(spark, [(0, "m1", "u1"), (1, "m1", "u1"), (6, "m1", "u1"), (7, "m1", "u2")])
    start = F.col("window_start") == F.lit(T0).cast("timestamp_ntz")
    pv = W.pv_counts(recs).where(start).collect()
    uvb = W.uv_batch_counts(recs).where(start).collect()
    uvx = W.uv_exact_counts(recs).where(start).collect()
    assert [r.pv for r in pv] == [4]
    assert [r.uv for r in uvb] == [3]
    assert [r.uv for r in uvx] == [2]


def _stream_equals_batch(spark, scratch, name, fn):
    recs = dt.play_records(dt.load(spark, SF_SMALL, "events"))
    src = os.path.join(scratch, "in")
    recs.repartition(4).write.parquet(src)
    # a sentinel far past the last event closes every window under append mode
    last = recs.agg(F.max("ts")).first()[0]
    sentinel = spark.createDataFrame(
        [(last + dtm.timedelta(hours=1), "zz", "zz", "0", "song-0")], recs.schema
    )
    sentinel.write.mode("append").parquet(src)
    stream = jobs.file_records(spark, src, recs.schema, max_files_per_trigger=2)
    q = (
        fn(stream, watermark="0 seconds").writeStream.outputMode("append").format("memory").queryName(name)
        .option("checkpointLocation", os.path.join(scratch, "ck"))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    streamed = {tuple(r) for r in spark.table(name).where(F.col("mid") != "zz").collect()}
    batch = {tuple(r) for r in fn(recs).collect()}
    assert streamed == batch
    assert len(batch) > 1000


def test_stream_pv_equals_batch(spark, scratch):
    _stream_equals_batch(spark, scratch, "pv_stream", W.pv_counts)


def test_stream_paned_pv_equals_batch(spark, scratch):
    _stream_equals_batch(spark, scratch, "pv_paned_stream", lambda r, **kw: W.pv_counts(r, panes=True, **kw))


def test_stream_uv_batch_equals_batch(spark, scratch):
    _stream_equals_batch(spark, scratch, "uvb_stream", W.uv_batch_counts)


def test_stream_uv_exact_equals_batch(spark, scratch):
    _stream_equals_batch(spark, scratch, "uvx_stream", W.uv_exact_counts)


def test_keyed_upsert_idempotent(spark, scratch):
    sink = KeyedUpsertSink(os.path.join(scratch, "pv"), ["mid"], compact_every=2)
    schema = "mid string, pv long, window_end long"
    b0 = spark.createDataFrame([("m1", 5, 1), ("m2", 7, 1)], schema)
    b1 = spark.createDataFrame([("m1", 9, 2)], schema)
    b2 = spark.createDataFrame([("m3", 1, 3), ("m1", 4, 1)], schema)  # m1 row is late
    sink(b0, 0)
    sink(b1, 1)  # compaction point
    sink(b0, 0)  # replay of an old batch
    sink(b2, 2)
    sink(b2, 2)  # replay of the last batch
    got = sorted(tuple(r) for r in sink.read_current(spark).collect())
    assert got == [("m1", 9, 2), ("m2", 7, 1), ("m3", 1, 3)]


def test_hot_song_job_end_to_end(spark, scratch):
    recs = dt.play_records(dt.load(spark, SF_SMALL, "events"))
    src = os.path.join(scratch, "in")
    recs.write.parquet(src)
    last = recs.agg(F.max("ts")).first()[0]
    spark.createDataFrame([(last + dtm.timedelta(hours=1), "zz", "zz", "0", "zz")], recs.schema) \
        .write.mode("append").parquet(src)
    stream = jobs.file_records(spark, src, recs.schema)
    q = jobs.start_hot_songs(stream, os.path.join(scratch, "board"), watermark="0 seconds",
                             trigger={"availableNow": True}, checkpoint_root=os.path.join(scratch, "ck"))
    q.awaitTermination(300)
    board = read_latest(spark, os.path.join(scratch, "board"))
    assert board is not None and board.count() > 0
    from encore.streaming.sinks import current_board

    now = current_board(spark, os.path.join(scratch, "board"))
    assert now.select("window_end").distinct().count() == 1
    assert board.agg(F.max("rank")).first()[0] <= 30
    # append mode emits every window once: all boards together equal the batch twin
    every = spark.read.parquet(os.path.join(scratch, "board")).drop("batch_id").where(F.col("songname") != "zz")
    batch = W.top_songs(W.song_counts(recs))
    assert sorted(map(tuple, every.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_parse_records_drops_malformed(spark):
    raw = spark.createDataFrame(
        [(T0, '{"mid":"m1","uid":"u1","songid":"1","songname":"a"}'), (T0, "{mid:m1}"), (T0, "not json")],
        "timestamp timestamp, value string",
    )
    assert [r.mid for r in W.parse_records(raw).collect()] == ["m1"]
    assert W.malformed_records(raw).count() == 2


def test_pv_uv_job_end_to_end(spark, scratch):
    from pyspark.sql import Window

    recs = dt.play_records(dt.load(spark, SF_SMALL, "events"))
    src = os.path.join(scratch, "in")
    recs.repartition(3).write.parquet(src)
    last = recs.agg(F.max("ts")).first()[0]
    spark.createDataFrame([(last + dtm.timedelta(hours=1), "zz", "zz", "0", "zz")], recs.schema) \
        .write.mode("append").parquet(src)
    stream = jobs.file_records(spark, src, recs.schema, max_files_per_trigger=2)
    out = os.path.join(scratch, "kv")
    queries = jobs.start_pv_uv(stream, out, watermark="0 seconds", trigger={"availableNow": True},
                               checkpoint_root=os.path.join(scratch, "ck"))
    for q in queries:
        q.awaitTermination(300)

    def latest(df, value):
        w = Window.partitionBy("mid").orderBy(F.desc("window_end"))
        return {(r.mid, r.window_end, r[value]) for r in
                df.withColumn("_r", F.row_number().over(w)).where("_r = 1").collect()}

    for name, twin, value in (("pv", W.pv_counts(recs), "pv"), ("uv", W.uv_exact_counts(recs), "uv")):
        table = KeyedUpsertSink(os.path.join(out, name), ["mid"]).read_current(spark)
        got = {(r.mid, r.window_end, r[value]) for r in table.where(F.col("mid") != "zz").collect()}
        assert got == latest(twin, value)


def test_restart_from_checkpoint(spark, scratch):
    """Stop after part of the input, add the rest, restart on the same
    checkpoint: the keyed table equals one uninterrupted run (the batch twin)."""
    from pyspark.sql import Window

    recs = dt.play_records(dt.load(spark, SF_SMALL, "events"))
    cut = recs.agg(F.expr("percentile_approx(unix_micros(ts), 0.5)")).first()[0]
    early = recs.where(F.expr(f"unix_micros(ts) <= {cut}"))
    late = recs.where(F.expr(f"unix_micros(ts) > {cut}"))
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "kv", "ck"))
    early.write.parquet(src)

    def run():
        stream = jobs.file_records(spark, src, recs.schema)
        for q in jobs.start_pv_uv(stream, out, watermark="0 seconds", trigger={"availableNow": True},
                                  checkpoint_root=ck):
            q.awaitTermination(300)

    run()
    last = recs.agg(F.max("ts")).first()[0]
    late.write.mode("append").parquet(src)
    spark.createDataFrame([(last + dtm.timedelta(hours=1), "zz", "zz", "0", "zz")], recs.schema) \
        .write.mode("append").parquet(src)
    run()
    w = Window.partitionBy("mid").orderBy(F.desc("window_end"))
    twin = W.pv_counts(recs).withColumn("_r", F.row_number().over(w)).where("_r = 1")
    want = {(r.mid, r.window_end, r.pv) for r in twin.collect()}
    table = KeyedUpsertSink(os.path.join(out, "pv"), ["mid"]).read_current(spark)
    got = {(r.mid, r.window_end, r.pv) for r in table.where(F.col("mid") != "zz").collect()}
    assert got == want


def test_uv_approx_close_to_exact(spark):
    recs = dt.play_records(dt.load(spark, SF_SMALL, "events"))
    exact = {(r.window_start, r.mid): r.uv for r in W.uv_exact_counts(recs).collect()}
    approx = {(r.window_start, r.mid): r.uv for r in W.uv_approx_counts(recs).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - v) <= max(1, 0.1 * v) for k, v in exact.items())


def test_paned_counts_equal_direct(spark):
    recs = dt.play_records(dt.load(spark, SF_SMALL, "events"))
    for fn in (W.pv_counts, W.uv_exact_counts, W.song_counts):
        paned = sorted(map(tuple, fn(recs, panes=True).collect()))
        direct = sorted(map(tuple, fn(recs, panes=False).collect()))
        assert paned == direct, fn.__name__


def test_stream_paned_uv_equals_batch(spark, scratch):
    _stream_equals_batch(spark, scratch, "uvx_paned_stream", lambda r, **kw: W.uv_exact_counts(r, panes=True, **kw))


def test_arrival_time_windows(spark, scratch):
    recs = dt.play_records(dt.load(spark, SF_SMALL, "events"))
    src = os.path.join(scratch, "in")
    recs.write.parquet(src)
    stream = W.by_arrival(jobs.file_records(spark, src, recs.schema))
    q = (
        W.pv_counts(stream, window="10 seconds", slide="10 seconds", watermark="0 seconds")
        .writeStream.outputMode("update").format("memory").queryName("arrival_pv")
        .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    out = spark.table("arrival_pv")
    assert out.agg(F.sum("pv")).first()[0] == recs.count()
    assert out.select("window_start").distinct().count() == 1


def test_hot_songs_by_id_keeps_same_titles_apart(spark):
    data = [(T0, "m", "u", "1", "same"), (T0, "m", "u", "2", "same"), (T0, "m", "u", "2", "same")]
    recs = spark.createDataFrame(data, "ts timestamp, mid string, uid string, songid string, songname string")
    by_name = {r.songname: r.times for r in W.song_counts(recs).where(F.col("window_start") == F.lit(T0).cast("timestamp_ntz")).collect()}
    by_id = {r.songid: r.times for r in W.song_counts(recs, key="songid").where(F.col("window_start") == F.lit(T0).cast("timestamp_ntz")).collect()}
    assert by_name == {"same": 3} and by_id == {"1": 1, "2": 2}


def test_upsert_ages_out_idle_keys(spark, scratch):
    sink = KeyedUpsertSink(os.path.join(scratch, "kv"), ["mid"], compact_every=1, expire_before=lambda: 5)
    schema = "mid string, pv long, window_end long"
    sink(spark.createDataFrame([("m1", 1, 3), ("m2", 2, 6)], schema), 0)
    sink(spark.createDataFrame([("m3", 4, 7)], schema), 1)
    assert sorted(r.mid for r in read_latest(spark, os.path.join(scratch, "kv", "snapshot")).collect()) == ["m2", "m3"]


def test_log_ingest_stream_equals_batch(spark, scratch):
    from encore.sources import client_log

    events = dt.load(spark, SF_SMALL, "events")
    landing = os.path.join(scratch, "landing")
    dt.client_log_lines(events).repartition(3).write.text(landing)
    req_path, play_path = os.path.join(scratch, "requests"), os.path.join(scratch, "plays")
    for q in jobs.start_log_ingest(spark, landing, req_path, play_path, trigger={"availableNow": True},
                                   checkpoint_root=os.path.join(scratch, "ck")):
        q.awaitTermination(300)
    batch_reqs = client_log.split_requests(client_log.read_client_log(spark, landing))
    streamed_reqs = spark.read.parquet(req_path)
    assert sorted(map(tuple, streamed_reqs.select(*batch_reqs.columns).collect())) == \
        sorted(map(tuple, batch_reqs.collect()))
    batch_plays = client_log.decode_play_requests(batch_reqs)
    streamed_plays = spark.read.parquet(play_path)
    assert sorted(map(tuple, streamed_plays.select(*batch_plays.columns).collect())) == \
        sorted(map(tuple, batch_plays.collect()))


def test_pv_uv_combined_equals_separate(spark):
    recs = dt.play_records(dt.load(spark, SF_SMALL, "events"))
    for panes in (False, True):
        both = {(r.window_start, r.mid): (r.pv, r.uv) for r in W.pv_uv_counts(recs, panes=panes).collect()}
        pv = {(r.window_start, r.mid): r.pv for r in W.pv_counts(recs).collect()}
        uv = {(r.window_start, r.mid): r.uv for r in W.uv_exact_counts(recs).collect()}
        assert both == {k: (pv[k], uv[k]) for k in pv}


def _cut_in_two(spark, scratch):
    """The records as files of an earlier and a later half, a few days' worth of
    windows apart from the end by a last record that closes them all."""
    recs = dt.play_records(dt.load(spark, SF_SMALL, "events"))
    cut = recs.agg(F.expr("percentile_approx(unix_micros(ts), 0.5)")).first()[0]
    last = recs.agg(F.max("ts")).first()[0]
    end = spark.createDataFrame([(last + dtm.timedelta(hours=1), "zz", "zz", "0", "zz")], recs.schema)
    src = os.path.join(scratch, "in")
    recs.where(F.expr(f"unix_micros(ts) <= {cut}")).coalesce(1).write.parquet(src)
    return recs, src, lambda: recs.where(F.expr(f"unix_micros(ts) > {cut}")).unionByName(end).coalesce(1).write.mode("append").parquet(src)


def test_lost_checkpoint_resumes_from_the_outputs(spark, scratch):
    """Half of the records, then the checkpoint is lost (a new folder), then
    the rest, then a plain restart: every window is written exactly once and
    equals the batch twin, also the windows that were open at the loss."""
    recs, src, add_rest = _cut_in_two(spark, scratch)
    out = os.path.join(scratch, "kv")

    def run(checkpoint):
        stream = jobs.file_records(spark, src, recs.schema)
        for q in jobs.start_pv_uv(stream, out, watermark="0 seconds", trigger={"availableNow": True}, checkpoint_root=os.path.join(scratch, checkpoint)):
            q.awaitTermination(300)

    run("first")
    written = spark.read.parquet(os.path.join(out, "pv", "delta")).agg(F.max("window_end")).first()[0]
    add_rest()
    run("second")
    run("second")
    twin = W.pv_uv_counts(recs).where(F.col("mid") != "zz")
    for table, value in (("pv", "pv"), ("uv", "uv")):
        rows = spark.read.parquet(os.path.join(out, table, "delta")).where(F.col("mid") != "zz")
        got = sorted((r.window_end, r.mid, r[value]) for r in rows.collect())
        assert got == sorted((r.window_end, r.mid, r[value]) for r in twin.collect())
        assert any(e > written for e, _, _ in got) and any(e <= written for e, _, _ in got)


def test_board_resumes_from_its_snapshots(spark, scratch):
    recs, src, add_rest = _cut_in_two(spark, scratch)
    board = os.path.join(scratch, "board")

    def run(checkpoint):
        stream = jobs.file_records(spark, src, recs.schema)
        jobs.start_hot_songs(stream, board, watermark="0 seconds", trigger={"availableNow": True},
                             checkpoint_root=os.path.join(scratch, checkpoint)).awaitTermination(300)

    run("first")
    add_rest()
    run("second")
    every = spark.read.parquet(board).drop("batch_id").where(F.col("songname") != "zz")
    batch = W.top_songs(W.song_counts(recs))
    assert sorted(map(tuple, every.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_a_table_that_is_behind_catches_up(spark, scratch):
    """A batch that reached only the first of two tables before the loss."""
    from encore.streaming.sinks import PvUvSink

    path = os.path.join(scratch, "kv")
    sink = PvUvSink(path)
    rows = [(T0, T0 + dtm.timedelta(seconds=60 + 5 * i), "m1", 10 + i, i) for i in range(3)]
    schema = "window_start timestamp_ntz, window_end timestamp_ntz, mid string, pv long, uv long"
    sink(spark.createDataFrame(rows[:1], schema), 0)
    sink.pv(spark.createDataFrame(rows[1:2], schema).drop("uv"), 1)  # then it stops
    again = PvUvSink(path)
    position, first = again.position(spark)
    assert position == str(rows[0][1]) and first == 2
    again.resume_after(position, first)
    again(spark.createDataFrame(rows, schema), 0)
    for table, value in ((again.pv, "pv"), (again.uv, "uv")):
        every = spark.read.parquet(os.path.join(table.path, "delta"))
        column = 3 if value == "pv" else 4
        assert sorted((r.window_end, r[value]) for r in every.collect()) == [(x[1], x[column]) for x in rows]


def test_idle_machines_leave_table_and_snapshots(spark, scratch):
    """By the newest window of the table, in what is read and what is kept."""
    from encore.streaming.sinks import PvUvSink

    sink = PvUvSink(os.path.join(scratch, "kv"), compact_every=3, expire_after="INTERVAL 10 MINUTES")
    schema = "window_start timestamp_ntz, window_end timestamp_ntz, mid string, pv long, uv long"

    def batch(i, minute, *mids):
        sink(spark.createDataFrame([(T0, T0 + dtm.timedelta(minutes=minute), m, 1, 1) for m in mids], schema), i)
        return sorted(r.mid for r in sink.pv.read_current(spark).collect())

    assert batch(0, 1, "idle", "a") == ["a", "idle"]
    assert batch(1, 11, "a") == ["a", "idle"]
    assert batch(2, 12, "b") == ["a", "b"]  # the snapshot is written here
    kept = read_latest(spark, os.path.join(scratch, "kv", "pv", "snapshot"))
    assert sorted(r.mid for r in kept.collect()) == ["a", "b"]
    assert batch(3, 13, "idle") == ["a", "b", "idle"]  # and it may come back


def test_started_jobs_age_their_tables(spark, scratch):
    recs = _records(spark, [(0, "idle", "u"), (3 * 86400, "m", "u"), (4 * 86400, "zz", "u")])
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "kv")
    recs.coalesce(1).write.parquet(src)
    for q in jobs.start_pv_uv(jobs.file_records(spark, src, recs.schema), out, watermark="0 seconds", trigger={"availableNow": True},
                              checkpoint_root=os.path.join(scratch, "ck")):
        q.awaitTermination(300)
    table = KeyedUpsertSink(os.path.join(out, "pv"), ["mid"], expire_after=jobs.KEEP_IDLE).read_current(spark)
    assert [r.mid for r in table.collect()] == ["m"]


def test_updating_bucket_visitors_equal_the_chained_form(spark):
    recs = dt.play_records(dt.load(spark, SF_SMALL, "events"))
    assert sorted(map(tuple, W.uv_batch_counts_updating(recs).collect())) == sorted(map(tuple, W.uv_batch_counts(recs).collect()))


def _uv_stream(spark, scratch, mode):
    recs = dt.play_records(dt.load(spark, SF_SMALL, "events"))
    src = os.path.join(scratch, "in")
    end = recs.agg(F.max("ts")).first()[0] + dtm.timedelta(hours=1)
    last = spark.createDataFrame([(end, "zz", "zz", "0", "zz")], recs.schema)
    recs.unionByName(last).repartitionByRange(4, "ts").write.parquet(src)
    stream = jobs.file_records(spark, src, recs.schema, max_files_per_trigger=1)
    rows: list = []
    q = (
        W.uv_batch_counts_updating(stream, watermark="1000 days").writeStream.outputMode(mode)
        .foreachBatch(lambda b, i: rows.extend((i, *r) for r in b.collect()))
        .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    return recs, rows


def test_bucket_visitors_in_update_mode(spark, scratch):
    """Open windows are written as they grow; the last count of each equals the batch."""
    recs, rows = _uv_stream(spark, scratch, "update")
    last = {(r[1], r[3]): r for r in sorted(rows) if r[3] != "zz"}
    assert sorted(r[1:] for r in last.values()) == sorted(map(tuple, W.uv_batch_counts(recs).collect()))
    assert len(rows) > len(last)


def test_bucket_visitors_in_append_mode(spark, scratch):
    _stream_equals_batch(spark, scratch, "uvb_once_stream", lambda r, watermark=None: W.uv_batch_counts_updating(
        r, watermark=watermark and "10 seconds"))
