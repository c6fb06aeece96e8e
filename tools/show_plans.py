"""Print the physical plans of the main jobs on the warehouse layout
(partitioned tables), to check pruning, pushdown, exchanges and joins.

    python tools/show_plans.py [sf_dir] > PLANS.txt
"""

from __future__ import annotations

import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from encore.operators import content, revenue  # noqa: E402
from encore.plans.daily import Warehouse, raw_from_driver, run_day, run_ingest  # noqa: E402
from encore.plans.registry import BUSINESS_DAY  # noqa: E402
from encore.session import build_session  # noqa: E402
from encore.sources import driver_tables as dt  # noqa: E402


def show(title: str, df) -> None:
    print("=" * 100)
    print(title)
    print("=" * 100)
    df.explain("formatted")


def shape_table(spark, sf: str) -> None:
    """Scans, exchanges and join/aggregate kinds of every registered query
    (static plans, AQE off, so the counts do not depend on runtime sizes)."""
    import re

    from encore.plans.registry import QUERIES

    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print(f"{'query':32s} scans exchanges broadcasts smj sort_aggs")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        scans = len(re.findall(r"FileScan parquet", plan)) + plan.count("Scan ExistingRDD")
        print(f"{name:32s} {scans:5d} {plan.count('Exchange ') - plan.count('BroadcastExchange'):9d} "
              f"{plan.count('BroadcastExchange'):10d} {plan.count('SortMergeJoin'):3d} {plan.count('SortAggregate'):9d}")
    spark.conf.set("spark.sql.adaptive.enabled", before)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="encore-plans-")
    spark = build_session(master="local[8]", shuffle_partitions=8,
                          extra={"spark.checkpoint.dir": os.path.join(scratch, "ck")})
    print("=" * 100)
    print("Plan shape of every registered query (driver tables)")
    print("=" * 100)
    shape_table(spark, sf)
    wh = Warehouse(os.path.join(scratch, "wh"))
    log_path = os.path.join(scratch, "landing")
    dt.client_log_lines(dt.load(spark, sf, "events")).write.text(log_path)
    run_ingest(spark, wh, log_path)
    raw = raw_from_driver(spark, sf)
    run_day(spark, wh, raw, BUSINESS_DAY)
    play_log = spark.read.parquet(wh.path("play_log"))
    catalog = spark.read.parquet(wh.path("song_base"))
    show("J3 song features: one scan of 31 play-log partitions, hash aggregates only",
         content.song_features(play_log, catalog, BUSINESS_DAY))
    features = spark.read.parquet(wh.path("song_features")).where(f"data_dt = '{BUSINESS_DAY}'")
    show("J4 top 30 per period: partial WindowGroupLimit before the shuffle",
         content.song_rsi(features, top_n=30))
    show("J10 machine revenue on the warehouse partitions",
         revenue.machine_stat(spark.read.parquet(wh.path("mac_base")), spark.read.parquet(wh.path("mac_loc")),
                              spark.read.parquet(wh.path("cnsm")), spark.read.parquet(wh.path("usr")), BUSINESS_DAY))
    spark.stop()


if __name__ == "__main__":
    main()
