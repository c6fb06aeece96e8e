"""Command line: run the daily jobs for a business date, or a streaming job.

    python -m encore ingest  --log /landing/clientlog/20240130 --warehouse /shared/wh [--stream [--once]]
    python -m encore import  --url jdbc:... --table song --as song_info --raw-dir /shared/raw [--split-by id --splits 8]
    python -m encore daily   --date 20240130 --warehouse /shared/wh --raw-dir /shared/raw [--raw-format text] [--jobs content,machines,users,revenue] [--jdbc-url jdbc:...]
    python -m encore daily   --date 20240130 --warehouse /shared/wh --sf-dir /root/testdata/sf0.01   (stand-in raw layer)
    python -m encore backfill --from 20240101 --to 20240130 --warehouse /shared/wh --sf-dir /root/testdata/sf0.01 [--sketches]
    python -m encore stream  --job hot_songs|pv_uv --source /path/to/records --out /shared/boards [--kafka host:9092 --topic t] [--once]

The checkpoint folder comes from ``spark.checkpoint.dir`` of the session
(set it with ``--conf`` in spark-submit); ``--checkpoint`` is only used when
the session has none.
"""

from __future__ import annotations

import argparse
import json

from .plans import daily
from .session import build_session, checkpoint_dir, scale_conf
from .sources.jdbc import import_table
from .sources.raw_tables import RAW_LAYER

JOBS = {
    "content": lambda spark, wh, raw, day, approx=False: daily.run_content(spark, wh, raw, day, approx),
    "machines": lambda spark, wh, raw, day: daily.run_machines(spark, wh, raw, day),
    "users": lambda spark, wh, raw, day: daily.run_users(spark, wh, raw, day),
    "revenue": lambda spark, wh, raw, day: daily.run_revenue(spark, wh, day),
}


def _raw_layer(parser: argparse.ArgumentParser) -> None:
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--raw-dir", help="folder of the written raw tables")
    source.add_argument("--sf-dir", help="folder of the driver tables the stand-in raw layer is derived from")
    parser.add_argument("--raw-format", choices=["parquet", "text"], default="parquet")


def _raw(spark, args, wh: daily.Warehouse) -> daily.RawTables:
    if args.raw_dir:
        return daily.raw_from_tables(spark, args.raw_dir, wh, args.raw_format)
    return daily.raw_from_driver(spark, args.sf_dir)


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="encore")
    sub = parser.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily")
    d.add_argument("--date", required=True, help="business date yyyyMMdd")
    d.add_argument("--warehouse", required=True)
    _raw_layer(d)
    d.add_argument("--jdbc-url", help="relational database of the marts (else Parquet under the warehouse)")
    d.add_argument("--jdbc-properties", default="{}", help="JSON of connection properties")
    d.add_argument("--jobs", default="content,machines,users,revenue")
    d.add_argument("--approx-distinct", action="store_true",
                   help="song features from daily HLL sketches (reads only the day's play log)")
    d.add_argument("--checkpoint")
    b = sub.add_parser("backfill")
    b.add_argument("--from", dest="first", required=True, help="first business date yyyyMMdd")
    b.add_argument("--to", dest="last", required=True, help="last business date yyyyMMdd")
    b.add_argument("--warehouse", required=True)
    _raw_layer(b)
    for p in (d, b):
        p.add_argument("--database", help="catalog database: tables are registered there and read by name")
        p.add_argument("--buckets", type=int, help="with --database: buckets of the machine-level tables")
    b.add_argument("--sketches", action="store_true", help="also seed the daily song sketches")
    b.add_argument("--checkpoint")
    g = sub.add_parser("ingest")
    g.add_argument("--log", required=True, help="client log text (plain or gz), one or more files")
    g.add_argument("--warehouse", required=True)
    g.add_argument("--checkpoint")
    g.add_argument("--stream", action="store_true", help="keep ingesting new files as they land")
    g.add_argument("--once", action="store_true", help="with --stream: ingest what is there, then stop")
    i = sub.add_parser("import")
    i.add_argument("--url", required=True, help="JDBC URL")
    i.add_argument("--properties", default="{}", help="JSON of connection properties")
    i.add_argument("--table", required=True)
    i.add_argument("--as", dest="field", required=True, choices=sorted(RAW_LAYER), help="raw table that it becomes")
    i.add_argument("--raw-dir", required=True)
    i.add_argument("--split-by", help="numeric column to read in ranges of")
    i.add_argument("--splits", type=int, default=8)
    i.add_argument("--checkpoint")
    s = sub.add_parser("stream")
    s.add_argument("--job", choices=["hot_songs", "pv_uv"], required=True)
    s.add_argument("--source", help="folder of record files (parquet)")
    s.add_argument("--kafka")
    s.add_argument("--topic")
    s.add_argument("--offsets", default="earliest", help="earliest, latest, or JSON of offsets per topic and partition")
    s.add_argument("--jdbc-url", help="hot_songs: replace this database's board instead of Parquet snapshots")
    s.add_argument("--jdbc-table", default="tm_hot_songs")
    s.add_argument("--jdbc-properties", default="{}", help="JSON of connection properties")
    s.add_argument("--refresh", action="store_true", help="pv_uv: write page views of open windows at every trigger")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint")
    s.add_argument("--once", action="store_true", help="process what is available, then stop")
    s.add_argument("--by-arrival", action="store_true", help="window by arrival time, as the original; pv_uv then writes every slide by the clock")
    for p in (d, b, g, i, s):
        p.add_argument("--input-bytes", type=int, help="approximate input volume: sizes splits/shuffles")
        p.add_argument("--executors", type=int, default=1)
        p.add_argument("--executor-cores", type=int, default=8)
    args = parser.parse_args(argv)

    spark = build_session(app=f"encore-{args.cmd}")
    if args.input_bytes:
        for key, value in scale_conf(args.input_bytes, args.executor_cores, args.executors).items():
            spark.conf.set(key, value)
    checkpoint_dir(spark, fallback=args.checkpoint)
    if args.cmd == "backfill":
        wh = daily.Warehouse(args.warehouse, database=args.database, buckets=args.buckets)
        raw = _raw(spark, args, wh)
        daily.backfill(spark, wh, raw, args.first, args.last)
        if args.sketches:
            daily.backfill_sketches(spark, wh, raw, args.first, args.last)
        return
    if args.cmd == "ingest" and args.stream:
        from .streaming import jobs

        wh = daily.Warehouse(args.warehouse)
        trigger = {"availableNow": True} if args.once else None
        for q in jobs.start_log_ingest(spark, args.log, wh.path("requests"), wh.path("play_log"), trigger=trigger):
            q.awaitTermination()
        return
    if args.cmd == "ingest":
        for row in daily.run_ingest(spark, daily.Warehouse(args.warehouse), args.log).collect():
            print(f"{row['data_dt']}: {row['unparsable']} unparsable play payloads dropped")
        return
    if args.cmd == "daily":
        wh = daily.Warehouse(args.warehouse, args.jdbc_url, json.loads(args.jdbc_properties), args.database, args.buckets)
        raw = _raw(spark, args, wh)
        for job in args.jobs.split(","):
            if job == "content":
                JOBS[job](spark, wh, raw, args.date, args.approx_distinct)
            else:
                JOBS[job](spark, wh, raw, args.date)
        return

    if args.cmd == "import":
        import_table(spark, args.raw_dir, args.field, args.url, args.table, json.loads(args.properties), args.split_by, args.splits)
        return

    from .streaming import jobs

    if args.kafka:
        records = jobs.kafka_records(spark, args.kafka, args.topic, args.offsets)
    else:
        # record files (ts, mid, uid, songid, songname); the schema is taken from the files present
        records = jobs.file_records(spark, args.source, spark.read.parquet(args.source).schema)
    trigger = {"availableNow": True} if args.once else None
    if args.job == "hot_songs":
        write = jobs.jdbc_board(args.jdbc_url, args.jdbc_table, json.loads(args.jdbc_properties)) if args.jdbc_url else None
        jobs.start_hot_songs(records, args.out, trigger=trigger, arrival_time=args.by_arrival, write=write).awaitTermination()
    elif args.by_arrival and not args.once:
        jobs.start_arrival_pv_uv(records, args.out).awaitTermination()
    else:
        for q in jobs.start_pv_uv(records, args.out, trigger=trigger, arrival_time=args.by_arrival, refresh=args.refresh):
            q.awaitTermination()


if __name__ == "__main__":
    main()
