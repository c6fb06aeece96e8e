"""Client log ingest (J1): ``&``-separated lines -> request type + payload -> play log.

Line layout (0-based parts): 0 time, 1 machine, 2 request type, 3 JSON
payload, 4 machine version, 5 UI version.  Exactly six parts after removing
trailing empty ones are kept.  Song-play requests are decoded into the ten
play columns; every other request type passes through as raw JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json_fields import PLAY_KEYS, is_parsed, play_payload
from ..functions.text import has_parts, split_dropping_trailing  # noqa: F401 (re-exported)
from .schemas import PARTITION_COL

# fixed values: request type of a song-play operation, and the part count of a line
PLAY_REQUEST = "MINIK_CLIENT_SONG_PLAY_OPERATE_REQ"
LINE_PARTS = 6
SEPARATOR = "&"


def read_client_log(spark: SparkSession, path: str) -> DataFrame:
    """Plain or gzip text (one line per record) -> ``value`` column.

    Plain text splits by ``spark.sql.files.maxPartitionBytes``; a ``.gz`` file
    is one task per file, so daily logs should land as many files.
    """
    return spark.read.text(path)


def split_requests(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Field-count filter and split into ``(data_dt, req_type, payload)``.

    ``data_dt`` is the day of the line's own time stamp (part 0), so a
    multi-day backlog is demultiplexed in one pass.
    """
    parts = split_dropping_trailing(F.col(line_col), SEPARATOR)
    return (
        lines.select(parts.alias("_p"))
        .where(has_parts(F.col("_p"), LINE_PARTS))
        .select(
            F.substring(F.col("_p")[0], 1, 8).alias(PARTITION_COL),
            F.col("_p")[2].alias("req_type"),
            F.col("_p")[3].alias("payload"),
        )
    )


def decode_play_requests(requests: DataFrame) -> DataFrame:
    """Song-play requests -> play-log rows; unparsable payloads are dropped."""
    parsed = requests.where(F.col("req_type") == F.lit(PLAY_REQUEST)).select(
        play_payload("payload").alias("_j"), PARTITION_COL
    )
    return parsed.where(is_parsed(F.col("_j"))).select(
        *[F.col(f"_j.{k}").alias(k.upper()) for k in PLAY_KEYS], PARTITION_COL
    )


def unparsable_play_requests(requests: DataFrame) -> DataFrame:
    """Play requests whose payload is not valid JSON (dropped by the decoder),
    counted per day for the run report."""
    plays = requests.where(F.col("req_type") == F.lit(PLAY_REQUEST))
    return (
        plays.where(~is_parsed(play_payload("payload")))
        .groupBy(PARTITION_COL)
        .agg(F.count(F.lit(1)).alias("unparsable"))
    )


def write_demultiplexed(requests: DataFrame, path: str) -> None:
    """One directory per (day, request type); the type is not repeated in the rows.

    The rows are rebalanced by (day, type): at run time a type that holds most
    of the log is split by the bytes it has
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), and small ones
    share a task, so tasks and files follow the volume."""
    (
        requests.hint("rebalance", PARTITION_COL, "req_type")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_COL, "req_type")
        .parquet(path)
    )


def to_tab_text(play_log: DataFrame) -> DataFrame:
    """Play rows as the original tab-joined text, fields in log order."""
    return play_log.select(
        F.concat_ws("\t", *[F.coalesce(F.col(k.upper()), F.lit("null")) for k in PLAY_KEYS]).alias("value"),
        PARTITION_COL,
    )
