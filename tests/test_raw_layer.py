"""From client-log text to the top 30 through written tables only."""

import os

import pytest
from pyspark.sql import functions as F

from encore.__main__ import main
from encore.plans import daily
from encore.plans.registry import BUSINESS_DAY
from encore.session import materialize
from encore.sources import driver_tables as dt
from encore.sources.jdbc import import_table
from encore.sources.raw_tables import RAW_LAYER, read_raw, write_raw

from .conftest import SF_SMALL


def _write_layer(spark, root, fmt):
    raw = daily.raw_from_driver(spark, SF_SMALL)
    for field in RAW_LAYER:
        if field != "play_log":
            write_raw(getattr(raw, field), root, field, fmt)
    return raw


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_log_text_to_top_30(spark, scratch, fmt):
    landing, root, wh_dir = (os.path.join(scratch, x) for x in ("landing", "raw", "wh"))
    _write_layer(spark, root, fmt)
    events = dt.load(spark, SF_SMALL, "events")
    machines = dt.machine_count(spark, SF_SMALL)
    dt.client_log_lines(events, machines).write.text(landing)
    main(["ingest", "--log", landing, "--warehouse", wh_dir])
    main(["daily", "--date", BUSINESS_DAY, "--warehouse", wh_dir, "--raw-dir", root, "--raw-format", fmt, "--jobs", "content"])
    board = spark.read.parquet(os.path.join(wh_dir, "marts", "tm_song_rsi"))
    assert board.count() > 0 and board.agg(F.max("RSI_RANK")).first()[0] <= 30

    from encore.operators import content

    plays = dt.play_log(events.where("event_type in ('view', 'click', 'purchase')"), machines)
    catalog = content.clean_catalog(dt.song_catalog(dt.load(spark, SF_SMALL, "part")))
    want = content.song_rsi(content.song_features(plays, catalog, BUSINESS_DAY), top_n=30)
    assert _rows(board.select("PERIOD", "NBR", "RSI_RANK")) == _rows(want.select("PERIOD", "NBR", "RSI_RANK"))


def test_null_texts_become_null(spark, scratch):
    rows = [("1", "null", ""), ("2", "NULL", "x"), ("3", "y", None)]
    frame = spark.createDataFrame(rows, "MID string, STORE_ID string, other string").select("MID", "STORE_ID")
    write_raw(frame, scratch, "store_map")
    got = {r.MID: r.STORE_ID for r in read_raw(spark, scratch, "store_map").collect()}
    assert got == {"1": None, "2": None, "3": "y"}
    assert read_raw(spark, scratch, "stores").count() == 0


def test_import_reads_in_ranges_between_the_bounds(spark, scratch, monkeypatch):
    from encore.sources import jdbc

    calls = []

    def fake(session, url, table, properties, *ranges):
        calls.append((table, ranges))
        if "MIN(" in table:
            return spark.createDataFrame([(3, 90)], "LOW long, HIGH long")
        return spark.createDataFrame([("1", "s")], "MID string, STORE_ID string")

    monkeypatch.setattr(jdbc, "read_jdbc_table", fake)
    import_table(spark, scratch, "store_map", "jdbc:x", "store", {}, "id", 4)
    assert calls[-1] == ("store", ("id", 3, 91, 4))
    assert read_raw(spark, scratch, "store_map").count() == 1


def test_a_callers_cached_frame_survives_a_day(spark, scratch):
    mine = spark.range(10).cache()
    mine.count()
    raw = daily.raw_from_driver(spark, SF_SMALL)
    daily.run_content(spark, daily.Warehouse(os.path.join(scratch, "wh")), raw, BUSINESS_DAY)
    assert mine.is_cached
    mine.unpersist()


def test_lineage_cuts_need_the_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return None

    monkeypatch.setattr(type(spark), "conf", property(lambda self: Conf()))
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    with pytest.raises(ValueError, match="checkpoint"):
        materialize(spark.range(5))


def test_materialize_checkpoints(spark):
    held = materialize(spark.range(5))
    assert held.count() == 5 and not held.is_cached and spark.sparkContext.getCheckpointDir()
