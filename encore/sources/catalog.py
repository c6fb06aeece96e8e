"""Warehouse tables in the session catalog (SRC2, SRC7, SNK6).

The original created its tables with DDL and attached each day's folder to
them.  Here a table is an external one over its folder, with the declared or
the written schema; a landed day is attached as a partition and its statistics
are computed, so jobs can name tables instead of paths, partitions are pruned
from the catalog without listing folders, and joins are planned by sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .schemas import PARTITION_COL


def _quoted(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def ensure_table(spark: SparkSession, database: str, table: str, path: str, schema: T.StructType) -> str:
    """The table over the folder ``path``, created where it is missing;
    partitioned by the day where the schema has one."""
    name = _quoted(database, table)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f" PARTITIONED BY (`{PARTITION_COL}`)" if PARTITION_COL in schema.fieldNames() else ""
        location = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION '{location}'")
    return name


def write_bucketed(df: DataFrame, database: str, table: str, path: str, key: str, buckets: int) -> str:
    """The days of ``df`` in place of those of a table whose days are bucketed
    and sorted by ``key``: joins on the key read it without a shuffle.  For
    tables with one row a key (a bucket holds whole keys, so a fact table with
    a hot key would fill one bucket)."""
    spark = df.sparkSession
    name = _quoted(database, table)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        location = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{PARTITION_COL}`) "
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{location}'")
    # one task a bucket: a day's folder has as many files as buckets
    rows = df.select(*[c for c in df.columns if c != PARTITION_COL], PARTITION_COL).repartition(buckets, key)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)
    return name


def attach_days(spark: SparkSession, name: str, days: list[str]) -> None:
    """Landed days become partitions, with statistics; repeating it is safe."""
    for day in days:
        part = f"PARTITION (`{PARTITION_COL}` = '{day}')"
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {part}")
        spark.sql(f"ANALYZE TABLE {name} {part} COMPUTE STATISTICS")
    spark.catalog.refreshTable(name)


def publish(spark: SparkSession, database: str, table: str, path: str, schema: T.StructType, days: list[str] | None = None) -> str:
    """Makes what was written under ``path`` visible in the catalog."""
    name = ensure_table(spark, database, table, path, schema)
    if PARTITION_COL in schema.fieldNames():
        attach_days(spark, name, days or [])
    else:
        spark.catalog.refreshTable(name)
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    return name


def read(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(_quoted(database, table))
