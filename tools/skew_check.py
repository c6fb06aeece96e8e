"""Skew check: one song holds a third of all plays.

Builds the play log from ``events`` with every third play moved to song 0,
and the orders with every third order moved to machine 0; runs the
song-feature job (exact, one day), the all-days backfill and the machine
revenue aggregation with
Spark's event log in a scratch folder, and prints, per stage that reads a
shuffle, the number of tasks and the largest task's share of the records
read.  A hot key that landed in one task would show a share near 1/3.

    python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from encore.operators import content, revenue, users  # noqa: E402
from encore.plans.registry import BUSINESS_DAY, FIRST_DAY  # noqa: E402
from encore.session import build_session  # noqa: E402
from encore.sources import driver_tables as dt  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="encore-skew-")
    logs = os.path.join(scratch, "events")
    os.makedirs(logs)
    spark = build_session(
        master="local[8]", shuffle_partitions=16,
        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs, "spark.eventLog.compress": "false",
               "spark.sql.adaptive.enabled": "false"},
    )
    events = dt.load(spark, sf, "events")
    hot = events.withColumn(
        "props", F.when(F.col("event_id") % 3 == 0, F.lit('{"k": 0}')).otherwise(F.col("props"))
    ).withColumn(
        # "no user" (NULL, and user 0) makes half of the hot song's plays
        "user_id", F.when(F.col("event_id") % 12 == 0, F.lit(0)).when(F.col("event_id") % 12 != 6, F.col("user_id"))
    )
    log = dt.play_log(hot)
    catalog = content.clean_catalog(dt.song_catalog(dt.load(spark, sf, "part")))
    share = log.where(F.col("SONGID") == "0").count() / log.count()
    spark.sparkContext.setJobGroup("features", "features")
    content.song_features(log, catalog, BUSINESS_DAY).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("backfill", "backfill")
    content.song_features_range(log, catalog, FIRST_DAY, BUSINESS_DAY).write.format("noop").mode("overwrite").save()
    # one machine takes a third of all orders: machine revenue for every day
    orders = dt.consumption(dt.load(spark, sf, "orders"))
    hot_orders = orders.withColumn("MID", F.when(F.col("ID").cast("bigint") % 3 == 0, F.lit("0")).otherwise(F.col("MID")))
    brief = users.consumption_brief(hot_orders)
    spark.sparkContext.setJobGroup("revenue", "revenue")
    revenue.revenue_and_refunds(brief).write.format("noop").mode("overwrite").save()
    spark.stop()

    reads = defaultdict(list)
    for path in glob.glob(os.path.join(logs, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                metrics = ev.get("Task Metrics") or {}
                rec = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if rec:
                    reads[ev["Stage ID"]].append(rec)
    print(f"hot song share of plays: {share:.3f}")
    print("shuffle-reading stages with >= 1000 records (smaller ones are final merges of pre-aggregated rows):")
    for stage, recs in sorted(reads.items()):
        total = sum(recs)
        if total < 1000:
            continue
        print(f"stage {stage:3d}: tasks={len(recs):3d} records={total:9d} largest task share={max(recs) / total:.3f}")


if __name__ == "__main__":
    main()
