"""The command line, driven in-process (it reuses the test session)."""

import os

from encore.__main__ import main
from encore.sources import driver_tables as dt

from .conftest import SF_SMALL


def test_daily_and_backfill_commands(spark, scratch):
    wh = os.path.join(scratch, "wh")
    main(["daily", "--date", "20240130", "--warehouse", wh, "--sf-dir", SF_SMALL, "--jobs", "content"])
    assert os.path.isdir(os.path.join(wh, "TW_SONG_RSI_D", "data_dt=20240130"))
    main(["backfill", "--from", "20240129", "--to", "20240130", "--warehouse", wh, "--sf-dir", SF_SMALL,
          "--sketches"])
    for table in ("TW_MAC_STAT_D", "TW_SONG_DAY_SKETCH_D", "TW_MAC_LOC_D"):
        assert os.path.isdir(os.path.join(wh, table, "data_dt=20240129")), table


def test_ingest_command(spark, scratch):
    landing = os.path.join(scratch, "landing")
    dt.client_log_lines(dt.load(spark, SF_SMALL, "events")).write.text(landing)
    wh = os.path.join(scratch, "wh")
    main(["ingest", "--log", landing, "--warehouse", wh])
    assert spark.read.parquet(os.path.join(wh, "TO_CLIENT_SONG_PLAY_OPERATE_REQ_D")).count() > 0
