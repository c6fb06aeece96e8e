"""Streaming jobs: sources, the two dashboards, and their start functions.

Resume position and window state live in ``checkpointLocation`` (one
folder per query under the shared checkpoint directory), replacing offsets
kept by hand in a key-value store.  Sinks are idempotent per batch id.  Where
the checkpoint is lost, ``resumed`` starts again from the outputs, which carry
their position (see ``sinks._Resumable``): nothing is lost or counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_dir, sub_dir
from . import windows as W
from .sinks import KeyedUpsertSink, PvUvSink, TopKReplaceSink

# State for many keys over a long watermark belongs off-heap.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit each batch's state changes instead of uploading state snapshots every batch
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# fixed values: trigger intervals of the two dashboards
HOT_TRIGGER = "20 seconds"
PV_TRIGGER = "5 seconds"
DEFAULT_WATERMARK = "30 seconds"
#: How long a machine without records stays in the keyed tables.
KEEP_IDLE = "INTERVAL 1 DAY"


def kafka_records(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
                  starting_timestamp_ms: int | None = None) -> DataFrame:
    """Kafka topic -> records (needs the Kafka connector on the classpath).
    ``starting_offsets``: "earliest", "latest" or the connector's JSON of
    offsets per topic and partition; ``starting_timestamp_ms`` starts at the
    first records of that time instead (after a lost checkpoint: the
    ``resume_from`` of the outputs).  A checkpoint, once there, goes first."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if starting_timestamp_ms is None:
        reader = reader.option("startingOffsets", starting_offsets)
    else:
        reader = reader.option("startingTimestamp", str(starting_timestamp_ms))
    return W.parse_records(reader.load(), "value", "timestamp")


def file_records(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of records as a stream (tests and replays)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def _apply_conf(spark: SparkSession) -> None:
    for k, v in STREAMING_CONF.items():
        spark.conf.set(k, v)


def jdbc_board(url: str, table: str, properties: dict[str, str] | None = None):
    """A writer that replaces a relational board (see ``TopKReplaceSink``)."""
    from ..sinks import write_mart

    return lambda ranked, target: write_mart(ranked, table, jdbc_url=url, properties=properties)


def resume_from(position: str | None, window: str, slide: str) -> str | None:
    """SQL text of the start of the first window after ``position``: records
    from then on make up all windows that are not written yet."""
    return None if position is None else f"TIMESTAMP_NTZ '{position}' + INTERVAL {slide} - INTERVAL {window}"


def resumed(records: DataFrame, sink, checkpoint: str, window: str, slide: str) -> DataFrame:
    """``records`` as the query at this checkpoint has to read them.

    With its checkpoint, a query goes on by itself.  Without one, but with
    outputs, it starts at the first window that these do not hold: earlier
    records are left out, and so are, by the sink, the windows before it.  The
    batch numbers then go on after those of the outputs; which number was the
    first is kept beside the checkpoint."""
    spark = records.sparkSession
    jvm = spark.sparkContext._jvm
    note = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/first_batch")
    fs = note.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(note):
        position, first = spark.read.option("wholetext", "true").text(f"{checkpoint}/first_batch").first()[0].split("|")
        position, first = position or None, int(first)
    elif fs.exists(jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets")):
        return records  # a checkpoint of before
    else:
        position, first = sink.position(spark)
        out = fs.create(note)
        out.write(bytearray(f"{position or ''}|{first}".encode()))
        out.close()
    sink.resume_after(position, first)
    start = resume_from(position, window, slide)
    return records if start is None else records.where(F.col("ts") >= F.expr(start))


def start_hot_songs(records: DataFrame, out_path: str, name: str = "hot_songs",
                    watermark: str = DEFAULT_WATERMARK, trigger: dict | None = None,
                    checkpoint_root: str | None = None, key: str = "songname",
                    arrival_time: bool = False, write=None) -> StreamingQuery:
    """J13: song counts per sliding window, top 30 per window.

    Append mode: a window is emitted once, complete, when the watermark
    passes its end, so its top 30 is final and its state is dropped."""
    spark = records.sparkSession
    _apply_conf(spark)
    root = checkpoint_root or checkpoint_dir(spark)
    sink = TopKReplaceSink(out_path, key=key, write=write)
    if arrival_time:
        records, watermark = W.by_arrival(records), "0 seconds"
    elif write is None:
        records = resumed(records, sink, sub_dir(root, name), W.HOT_WINDOW, W.HOT_SLIDE)
    counts = W.song_counts(records, key=key, watermark=watermark, panes=True)
    return (
        counts.writeStream.outputMode("append")
        .foreachBatch(sink)
        .option("checkpointLocation", sub_dir(root, name))
        .trigger(**(trigger or {"processingTime": HOT_TRIGGER}))
        .queryName(name)
        .start()
    )


def start_pv_uv(records: DataFrame, out_path: str, name: str = "pv_uv", exact_uv: bool = True,
                watermark: str = DEFAULT_WATERMARK, trigger: dict | None = None,
                checkpoint_root: str | None = None,
                arrival_time: bool = False, refresh: bool = False, expire_after: str | None = KEEP_IDLE) -> tuple[StreamingQuery, ...]:
    """J14: page views and visitors per machine, upserted by machine into
    ``out_path/pv`` and ``out_path/uv``; a machine whose last window is
    ``expire_after`` older than the newest one leaves the tables.

    Exact visitors: ONE query (one read of the stream) feeds both tables.
    The original per-batch visitor form needs its own bucketed chain, so it
    runs as a second query.

    A window is written when it is complete.  With ``refresh`` page views are
    written at every trigger, also of windows still open (update mode, which a
    single aggregation allows), by a query of their own; the newest window per
    machine wins in the table, and a later count of a window replaces it."""
    if arrival_time:
        records, watermark = W.by_arrival(records), "0 seconds"
    spark = records.sparkSession
    _apply_conf(spark)
    root = checkpoint_root or checkpoint_dir(spark)
    trig = trigger or {"processingTime": PV_TRIGGER}
    if refresh:
        pv = (
            W.pv_counts(records, watermark=watermark)
            .writeStream.outputMode("update")
            .foreachBatch(KeyedUpsertSink(sub_dir(out_path, "pv"), ["mid"], expire_after=expire_after))
            .option("checkpointLocation", sub_dir(root, f"{name}_pv_refresh"))
            .trigger(**trig)
            .queryName(f"{name}_pv_refresh")
            .start()
        )
        uv = (
            W.uv_exact_counts(records, watermark=watermark, panes=True)
            .writeStream.outputMode("append")
            .foreachBatch(KeyedUpsertSink(sub_dir(out_path, "uv"), ["mid"], expire_after=expire_after))
            .option("checkpointLocation", sub_dir(root, f"{name}_uv"))
            .trigger(**trig)
            .queryName(f"{name}_uv")
            .start()
        )
        return pv, uv
    if exact_uv:
        sink = PvUvSink(out_path, expire_after=expire_after)
        if not arrival_time:
            records = resumed(records, sink, sub_dir(root, name), W.PV_WINDOW, W.PV_SLIDE)
        both = (
            W.pv_uv_counts(records, watermark=watermark, panes=True)
            .writeStream.outputMode("append")
            .foreachBatch(sink)
            .option("checkpointLocation", sub_dir(root, name))
            .trigger(**trig)
            .queryName(name)
            .start()
        )
        return (both,)
    pv = (
        W.pv_counts(records, watermark=watermark, panes=True)
        .writeStream.outputMode("append")
        .foreachBatch(KeyedUpsertSink(sub_dir(out_path, "pv"), ["mid"], expire_after=expire_after))
        .option("checkpointLocation", sub_dir(root, f"{name}_pv"))
        .trigger(**trig)
        .queryName(f"{name}_pv")
        .start()
    )
    uv_frame = W.uv_batch_counts(records, watermark=watermark)
    uv = (
        uv_frame.writeStream.outputMode("append")
        .foreachBatch(KeyedUpsertSink(sub_dir(out_path, "uv"), ["mid"], expire_after=expire_after))
        .option("checkpointLocation", sub_dir(root, f"{name}_uv"))
        .trigger(**trig)
        .queryName(f"{name}_uv")
        .start()
    )
    return pv, uv


def start_arrival_pv_uv(records: DataFrame, out_path: str, name: str = "pv_uv_arrival", window_seconds: int = 60, slide_seconds: int = 5,
                        trigger: dict | None = None, checkpoint_root: str | None = None, write=None) -> StreamingQuery:
    """J14 by time of arrival, as the original: page views and visitors of the
    last ``window_seconds`` per machine, written at the end of every slide,
    also while no record arrives.  ``write`` receives the window rows of each
    batch and its id; by default they are upserted by machine."""
    from .arrival import arrival_counts, merge_shards

    spark = records.sparkSession
    _apply_conf(spark)
    root = checkpoint_root or checkpoint_dir(spark)
    sink = write or PvUvSink(out_path, expire_after=KEEP_IDLE)
    return (
        arrival_counts(records, window_seconds, slide_seconds).writeStream.outputMode("append")
        .foreachBatch(lambda rows, batch_id: sink(merge_shards(rows), batch_id))
        .option("checkpointLocation", sub_dir(root, name))
        .trigger(**(trigger or {"processingTime": PV_TRIGGER}))
        .queryName(name)
        .start()
    )


def start_log_ingest(spark: SparkSession, landing: str, requests_path: str, play_log_path: str,
                     name: str = "log_ingest", trigger: dict | None = None,
                     checkpoint_root: str | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """J1 as a stream: new client-log files under ``landing`` are split as
    they arrive and appended (file sink, exactly once via the checkpoint) to
    the request table partitioned by (day, request type); a second query
    streams that table (the sink's commit log marks complete files) and
    appends decoded plays to the play-log table partitioned by day.  The raw
    text is read once; the second query reads compact parquet.

    With an ``availableNow`` trigger the two run one after the other; with
    a processing-time trigger they run side by side."""
    from pyspark.sql import types as T

    from ..sources import client_log
    from ..sources.schemas import PARTITION_COL

    root = checkpoint_root or checkpoint_dir(spark)
    trig = trigger or {"processingTime": "1 minute"}
    lines = spark.readStream.text(landing)
    requests = client_log.split_requests(lines)
    req_q = (
        requests.writeStream.format("parquet").outputMode("append")
        .partitionBy(PARTITION_COL, "req_type")
        .option("path", requests_path)
        .option("checkpointLocation", sub_dir(root, f"{name}_requests"))
        .trigger(**trig).queryName(f"{name}_requests").start()
    )
    if "availableNow" in trig:
        req_q.awaitTermination()
    else:  # the second stream may start before the first one's first commit
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(requests_path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hpath)
    landed_schema = T.StructType([
        T.StructField("payload", T.StringType()),
        T.StructField(PARTITION_COL, T.StringType()),
        T.StructField("req_type", T.StringType()),
    ])
    landed = spark.readStream.schema(landed_schema).parquet(requests_path)
    play_q = (
        client_log.decode_play_requests(landed).writeStream.format("parquet").outputMode("append")
        .partitionBy(PARTITION_COL)
        .option("path", play_log_path)
        .option("checkpointLocation", sub_dir(root, f"{name}_plays"))
        .trigger(**trig).queryName(f"{name}_plays").start()
    )
    return req_q, play_q
