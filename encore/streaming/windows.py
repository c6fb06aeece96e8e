"""Sliding-window counts of the two dashboards (J13 hot songs, J14 pv/uv).

Every function takes a records DataFrame ``(ts, mid, uid, songid,
songname)`` and works unchanged on a batch DataFrame (the oracle twin and
backfills) or a streaming one (with a watermark on ``ts``).  The original
windows were by arrival batch; here they are by event time, so late rows
within the watermark still land in the right window.  A record without a
user is a page view and no visitor, in every form of the visitor count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values of the dashboards (window, slide): page views and visitors,
# and hot songs; the visitor buckets equal the page-view batch interval
PV_WINDOW, PV_SLIDE = "60 seconds", "5 seconds"
UV_BUCKET = "5 seconds"
HOT_WINDOW, HOT_SLIDE = "60 seconds", "20 seconds"
HOT_TOP_N = 30

RECORD_FIELDS = ["mid", "uid", "songid", "songname"]
_CORRUPT = "_corrupt_record"
RECORD_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType()) for f in RECORD_FIELDS] + [T.StructField(_CORRUPT, T.StringType())]
)


def parse_records(raw: DataFrame, value_col: str = "value", ts_col: str = "timestamp") -> DataFrame:
    """JSON message values -> records.  Malformed JSON is dropped instead of
    failing the batch (see ``malformed_records`` to count it)."""
    parsed = _parsed(raw, value_col, ts_col)
    ok = F.col("r").isNotNull() & F.col(f"r.{_CORRUPT}").isNull()
    return parsed.where(ok).select("ts", *[F.col(f"r.{f}").alias(f) for f in RECORD_FIELDS])


def malformed_records(raw: DataFrame, value_col: str = "value", ts_col: str = "timestamp") -> DataFrame:
    parsed = _parsed(raw, value_col, ts_col)
    return parsed.where(F.col("r").isNull() | F.col(f"r.{_CORRUPT}").isNotNull()).select("ts")


def _parsed(raw: DataFrame, value_col: str, ts_col: str) -> DataFrame:
    opts = {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"}
    return raw.select(
        F.col(ts_col).alias("ts"), F.from_json(F.col(value_col).cast("string"), RECORD_SCHEMA, opts).alias("r")
    )


def by_arrival(records: DataFrame) -> DataFrame:
    """Window by arrival instead of event time, as the original dashboards
    did: every record of a micro-batch gets the batch's time stamp
    (``current_timestamp()`` is fixed per batch), so all window functions
    below group by when data arrived.  Use a zero-delay watermark."""
    return records.withColumn("ts", F.current_timestamp())


def _flat(df: DataFrame, win: str = "w") -> DataFrame:
    others = [c for c in df.columns if c != win]
    return df.select(
        F.col(f"{win}.start").cast("timestamp_ntz").alias("window_start"),
        F.col(f"{win}.end").cast("timestamp_ntz").alias("window_end"),
        *others,
    )


def with_watermark(records: DataFrame, delay: str | None) -> DataFrame:
    return records.withWatermark("ts", delay) if delay else records


def pv_counts(records: DataFrame, window: str = PV_WINDOW, slide: str = PV_SLIDE,
              watermark: str | None = None, panes: bool = False) -> DataFrame:
    """Page views per machine per sliding window.

    With ``panes`` the events are first counted per ``slide``-long pane and
    the panes are summed into windows (chained on ``window_time``): an event
    updates one pane row instead of window/slide window rows, and state
    holds one row per (pane, machine) -- the same counts, far less work when
    a machine sees many events per pane (the streaming job's setting); on
    sparse data the extra aggregation costs more than it saves.
    """
    src = with_watermark(records, watermark)
    if not panes:
        agg = src.groupBy(F.window("ts", window, slide).alias("w"), "mid").agg(F.count(F.lit(1)).alias("pv"))
        return _flat(agg)
    per_pane = src.groupBy(F.window("ts", slide).alias("p"), "mid").agg(F.count(F.lit(1)).alias("n"))
    agg = per_pane.groupBy(F.window(F.window_time("p"), window, slide).alias("w"), "mid").agg(
        F.sum("n").alias("pv")
    )
    return _flat(agg)


def uv_batch_counts(records: DataFrame, window: str = PV_WINDOW, slide: str = PV_SLIDE,
                    bucket: str = UV_BUCKET, watermark: str | None = None) -> DataFrame:
    """Visitors the way the original dashboard counted them: distinct
    (machine, user) per ``bucket`` (its micro-batch), summed over the window,
    so a user seen in k buckets counts k times.  Two chained aggregations;
    the second windows on the event time of the first (``window_time``)."""
    src = with_watermark(records, watermark)
    per_bucket = src.groupBy(F.window("ts", bucket).alias("b"), "mid", "uid").agg(F.count(F.lit(1)).alias("_n"))
    agg = per_bucket.groupBy(F.window(F.window_time("b"), window, slide).alias("w"), "mid").agg(
        F.count("uid").alias("uv")
    )
    return _flat(agg)


def uv_batch_counts_updating(records: DataFrame, window: str = PV_WINDOW, slide: str = PV_SLIDE,
                             bucket: str = UV_BUCKET, watermark: str | None = None) -> DataFrame:
    """``uv_batch_counts`` with one aggregation, so that a stream can write
    open windows too (update mode): a user's first record in a bucket stays,
    the others go.  In a stream the watermark's delay must reach over a bucket;
    then a first record is remembered until no other of its bucket can come."""
    src = with_watermark(records, watermark).select(F.window("ts", bucket)["start"].cast("timestamp").alias("_b"), "ts", "mid", "uid")
    keys = ["_b", "mid", "uid"]
    once = src.dropDuplicatesWithinWatermark(keys) if records.isStreaming else src.dropDuplicates(keys)
    # slides are whole buckets, so any record of a bucket is in the bucket's windows
    agg = once.groupBy(F.window("ts", window, slide).alias("w"), "mid").agg(F.count("uid").alias("uv"))
    return _flat(agg)


def uv_exact_counts(records: DataFrame, window: str = PV_WINDOW, slide: str = PV_SLIDE,
                    watermark: str | None = None, panes: bool = False) -> DataFrame:
    """Distinct visitors per machine per sliding window (the stated intent).

    Two-level aggregation: (window, machine, user) first, then users per
    (window, machine); no per-key set is held in one task.  With ``panes``
    the (machine, user) pairs are first made distinct per ``slide`` pane, so
    a user's repeated events within a pane touch one state row."""
    src = with_watermark(records, watermark)
    if panes:
        src = src.groupBy(F.window("ts", slide).alias("p"), "mid", "uid").agg(F.count(F.lit(1)).alias("_k"))
        src = src.select(F.window_time("p").alias("ts"), "mid", "uid")
    per_user = src.groupBy(F.window("ts", window, slide).alias("w"), "mid", "uid").agg(
        F.count(F.lit(1)).alias("_n")
    )
    agg = per_user.groupBy("w", "mid").agg(F.count("uid").alias("uv"))
    return _flat(agg)


def pv_uv_counts(records: DataFrame, window: str = PV_WINDOW, slide: str = PV_SLIDE,
                 watermark: str | None = None, panes: bool = False) -> DataFrame:
    """Page views AND exact distinct visitors per machine and window from one
    chain: (window, machine, user) counts, then per (window, machine) their
    sum is the page views and the number of (non-NULL) users the visitors.
    One stream read and one state chain instead of two queries."""
    src = with_watermark(records, watermark)
    if panes:
        src = src.groupBy(F.window("ts", slide).alias("p"), "mid", "uid").agg(F.count(F.lit(1)).alias("_k"))
        src = src.select(F.window_time("p").alias("ts"), "mid", "uid", "_k")
    else:
        src = src.withColumn("_k", F.lit(1).cast("bigint"))
    per_user = src.groupBy(F.window("ts", window, slide).alias("w"), "mid", "uid").agg(F.sum("_k").alias("_n"))
    agg = per_user.groupBy("w", "mid").agg(
        F.sum("_n").alias("pv"), F.count_if(F.col("uid").isNotNull()).alias("uv")
    )
    return _flat(agg)


def uv_approx_counts(records: DataFrame, window: str = PV_WINDOW, slide: str = PV_SLIDE,
                     rsd: float = 0.02, watermark: str | None = None) -> DataFrame:
    """Distinct visitors per machine per window with a HyperLogLog sketch:
    one stateful operator whose state per window is fixed-size, for windows
    holding very many users (relative standard deviation ``rsd``)."""
    src = with_watermark(records, watermark)
    agg = src.groupBy(F.window("ts", window, slide).alias("w"), "mid").agg(
        F.approx_count_distinct("uid", rsd).alias("uv")
    )
    return _flat(agg)


def song_counts(records: DataFrame, window: str = HOT_WINDOW, slide: str = HOT_SLIDE,
                key: str = "songname", watermark: str | None = None, panes: bool = False) -> DataFrame:
    """Plays per song (by name, as the original; pass ``key='songid'`` to
    keep same-titled songs apart) per sliding window; ``panes`` as in
    ``pv_counts``."""
    src = with_watermark(records, watermark)
    if not panes:
        agg = src.groupBy(F.window("ts", window, slide).alias("w"), key).agg(F.count(F.lit(1)).alias("times"))
        return _flat(agg)
    per_pane = src.groupBy(F.window("ts", slide).alias("p"), key).agg(F.count(F.lit(1)).alias("n"))
    agg = per_pane.groupBy(F.window(F.window_time("p"), window, slide).alias("w"), key).agg(
        F.sum("n").alias("times")
    )
    return _flat(agg)


def top_songs(counts: DataFrame, n: int = HOT_TOP_N, key: str = "songname") -> DataFrame:
    """Top ``n`` songs of each window (ties: name ascending).  Runs on a batch
    DataFrame -- inside ``foreachBatch`` for a stream."""
    from ..operators.ranking import top_per_group

    return top_per_group(
        counts, ["window_start", "window_end"], [F.desc("times"), F.asc(key)], n, name="rank"
    )
