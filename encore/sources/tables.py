"""Catalog and partition scans (string partition literals so pruning works)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import PARTITION_COL


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet table scan; pass the schema for partitioned tables."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


SPREAD_MIN_BYTES = 1 << 20


def normalize_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Raw layers write a missing value as ``''`` or the text ``null``; turn
    both into SQL NULL once, at the ingest boundary (string columns only)."""
    from ..functions.text import blank_to_null

    targets = set(cols) if cols is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    }
    return df.select(*[blank_to_null(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t",
                   partitioned: bool = True) -> DataFrame:
    """Delimited-text raw table with a declared schema (no inference), NULL
    sentinels normalised.  With ``partitioned`` the ``data_dt=`` directories
    supply the partition column (kept as a string)."""
    fields = [f for f in schema.fields if not (partitioned and f.name == PARTITION_COL)]
    df = (
        spark.read.option("sep", sep).option("header", "false").option("mode", "PERMISSIVE")
        .schema(T.StructType(fields))
        .csv(path)
    )
    if partitioned and PARTITION_COL in schema.fieldNames() and PARTITION_COL in df.columns:
        df = df.withColumn(PARTITION_COL, F.col(PARTITION_COL).cast("string"))
    return normalize_nulls(df, [f.name for f in fields if isinstance(f.dataType, T.StringType)])


def ensure_parallelism(df: DataFrame, path: str, min_partitions: int | None = None,
                       min_bytes: int = SPREAD_MIN_BYTES) -> DataFrame:
    """Spread the scan of one file over the cores (the stand-in tables).

    A file written as a single row group is read by one task whatever the
    split size, so every per-row expression after it runs on one core.  When
    the input is one file of at least ``min_bytes`` and the scan yields fewer
    partitions than ``min_partitions`` (default: the default parallelism),
    the rows are round-robin repartitioned.  A folder of files, as every
    table of a warehouse is, is never touched.
    """
    spark = df.sparkSession
    try:
        if not _is_file(spark, path) or _size(spark, path) < min_bytes:
            return df
        target = min_partitions or spark.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # no JVM/RDD access (e.g. a remote session): leave the scan as is
        return df
    return df.repartition(target) if current < target else df


def _is_file(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hpath).isFile()


def _size(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(hpath).getLength()


def on_day(df: DataFrame, day: str) -> DataFrame:
    """Single-date partition scan: ``data_dt = 'yyyyMMdd'``."""
    return df.where(F.col(PARTITION_COL) == F.lit(day))


def between_days(df: DataFrame, first: str, last: str) -> DataFrame:
    """Trailing-window partition scan, both ends inclusive."""
    return df.where(F.col(PARTITION_COL).between(F.lit(first), F.lit(last)))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(conf).exists(hpath)
