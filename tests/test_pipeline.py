"""Daily pipeline: end to end, idempotent re-runs, partition isolation."""

import os

from pyspark.sql import functions as F

from encore.plans.daily import Warehouse, raw_from_driver, run_day
from encore.sinks import write_partition
from encore.sources import client_log
from encore.sources import driver_tables as dt

from .conftest import SF_SMALL


def _snapshot(spark, path):
    df = spark.read.parquet(path)
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_partition_overwrite_keeps_other_dates(spark, scratch):
    path = os.path.join(scratch, "t")
    mk = lambda v, d: spark.createDataFrame([(v, d)], "v string, data_dt string")
    write_partition(mk("a", "20240101"), path)
    write_partition(mk("b", "20240102"), path)
    write_partition(mk("c", "20240101"), path)
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert got == [("b", "20240102"), ("c", "20240101")]
    assert dict(spark.read.parquet(path).dtypes)["data_dt"] == "string"


def test_run_two_days_and_rerun(spark, scratch):
    wh = Warehouse(os.path.join(scratch, "wh"))
    raw = raw_from_driver(spark, SF_SMALL)
    run_day(spark, wh, raw, "20240129")
    run_day(spark, wh, raw, "20240130")
    first = {k: _snapshot(spark, wh.path(k)) for k in ("song_rsi", "mac_loc", "mac_stat", "region", "merchant")}
    marts = _snapshot(spark, os.path.join(wh.root, "marts", "tm_song_rsi"))
    run_day(spark, wh, raw, "20240130")
    again = {k: _snapshot(spark, wh.path(k)) for k in first}
    assert first == again
    assert marts == _snapshot(spark, os.path.join(wh.root, "marts", "tm_song_rsi"))
    days = {r[0] for r in spark.read.parquet(wh.path("song_rsi")).select("data_dt").distinct().collect()}
    assert days == {"20240129", "20240130"}
    locs = spark.read.parquet(wh.path("mac_loc")).where(F.col("data_dt") == "20240130")
    assert locs.groupBy("MID").count().where("count > 1").count() == 0
    top = spark.read.parquet(os.path.join(wh.root, "marts", "tm_song_rsi"))
    assert top.agg(F.max("RSI_RANK")).first()[0] <= 30


def test_client_log_demux_write(spark, scratch):
    lines = dt.client_log_lines(dt.load(spark, SF_SMALL, "events"))
    path = os.path.join(scratch, "raw")
    reqs = client_log.split_requests(lines)
    client_log.write_demultiplexed(reqs, path)
    back = spark.read.parquet(path)
    assert set(back.columns) == {"payload", "data_dt", "req_type"}
    assert back.count() == reqs.count()
    plays = client_log.decode_play_requests(back)
    assert plays.where(F.col("SONGID").isNull()).count() == 0


def test_text_log_round_trip(spark, scratch):
    path = os.path.join(scratch, "log")
    dt.client_log_lines(dt.load(spark, SF_SMALL, "events")).write.text(path)
    lines = client_log.read_client_log(spark, path)
    plays = client_log.decode_play_requests(client_log.split_requests(lines))
    events = dt.load(spark, SF_SMALL, "events")
    assert plays.count() == events.where(F.col("event_type").isin("view", "click", "purchase")).count()


def test_tab_text_export(spark):
    plays = dt.play_log(dt.load(spark, SF_SMALL, "events"))
    row = client_log.to_tab_text(plays).first()
    assert len(row.value.split("\t")) == 10


def test_delimited_ods_round_trip(spark, scratch):
    from encore.sources import schemas
    from encore.sources.tables import read_delimited

    plays = dt.play_log(dt.load(spark, SF_SMALL, "events")).withColumn(
        "SONGNAME", F.when(F.col("ORDER_ID").endswith("7"), F.lit(None)).otherwise(F.col("SONGNAME"))
    )
    path = os.path.join(scratch, "ods")
    client_log.to_tab_text(plays).write.partitionBy("data_dt").text(path)
    back = read_delimited(spark, path, schemas.PLAY_LOG)
    assert dict(back.dtypes)["data_dt"] == "string"
    cols = [f.name for f in schemas.PLAY_LOG.fields]
    assert sorted(map(tuple, back.select(*cols).collect())) == sorted(map(tuple, plays.select(*cols).collect()))


def test_unparsable_payloads_reported(spark):
    rows = [("20240101120000&m&MINIK_CLIENT_SONG_PLAY_OPERATE_REQ&{songid:5}&v&u",),
            ('20240101120000&m&MINIK_CLIENT_SONG_PLAY_OPERATE_REQ&{"songid":5}&v&u',)]
    reqs = client_log.split_requests(spark.createDataFrame(rows, "value string"))
    assert client_log.decode_play_requests(reqs).count() == 1
    assert [tuple(r) for r in client_log.unparsable_play_requests(reqs).collect()] == [("20240101", 1)]


def test_scale_conf_sizes():
    from encore.session import scale_conf

    conf = scale_conf(100 * (1 << 40), executor_cores=8, executors=1000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert int(scale_conf(1 << 30, 8, 10)["spark.sql.shuffle.partitions"]) == 160


def test_backfill_equals_daily_runs(spark, scratch):
    from encore.plans.daily import backfill, run_content, run_machines, run_revenue, run_users

    raw = raw_from_driver(spark, SF_SMALL)
    bulk = Warehouse(os.path.join(scratch, "bulk"))
    backfill(spark, bulk, raw, "20240128", "20240130")
    daily = Warehouse(os.path.join(scratch, "daily"))
    for day in ("20240128", "20240129", "20240130"):
        run_content(spark, daily, raw, day)
        run_machines(spark, daily, raw, day)
        run_users(spark, daily, raw, day)
        run_revenue(spark, daily, day)
    for key in ("song_features", "song_rsi", "singer_rsi", "mac_loc", "cnsm", "mac_stat", "region", "merchant"):
        assert _snapshot(spark, bulk.path(key)) == _snapshot(spark, daily.path(key)), key
    days = lambda wh: {r[0] for r in spark.read.parquet(wh.path("usr")).select("data_dt").distinct().collect()}
    assert {"20240128", "20240129", "20240130"} <= days(bulk)


def test_ingest_lands_play_log(spark, scratch):
    from encore.plans.daily import run_ingest

    events = dt.load(spark, SF_SMALL, "events")
    log_path = os.path.join(scratch, "landing")
    dt.client_log_lines(events).write.text(log_path)
    wh = Warehouse(os.path.join(scratch, "wh"))
    report = run_ingest(spark, wh, log_path)
    assert report.count() == 0
    landed = spark.read.parquet(wh.path("play_log"))
    expected = dt.play_log(events.where(F.col("event_type").isin("view", "click", "purchase")))
    assert sorted(map(tuple, landed.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))


def test_approximate_content_mode(spark, scratch):
    from encore.plans.daily import backfill_sketches, run_content

    raw = raw_from_driver(spark, SF_SMALL)
    exact, approx = Warehouse(os.path.join(scratch, "exact")), Warehouse(os.path.join(scratch, "approx"))
    run_content(spark, exact, raw, "20240130")
    backfill_sketches(spark, approx, raw, "20231231", "20240129")
    run_content(spark, approx, raw, "20240130", approx_distinct=True)
    assert _snapshot(spark, approx.path("song_features")) == _snapshot(spark, exact.path("song_features"))
    assert _snapshot(spark, approx.path("song_rsi")) == _snapshot(spark, exact.path("song_rsi"))


def test_gzip_log_round_trip(spark, scratch):
    path = os.path.join(scratch, "gz")
    dt.client_log_lines(dt.load(spark, SF_SMALL, "events")).write.option("compression", "gzip").text(path)
    assert any(name.endswith(".gz") for name in os.listdir(path))
    plays = client_log.decode_play_requests(client_log.split_requests(client_log.read_client_log(spark, path)))
    events = dt.load(spark, SF_SMALL, "events")
    assert plays.count() == events.where(F.col("event_type").isin("view", "click", "purchase")).count()
