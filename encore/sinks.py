"""Batch sinks.

* ``write_partition`` -- replace only the ``data_dt`` partitions present in
  the frame (dynamic overwrite), other dates untouched; re-running a day
  rewrites that day only, so every job is idempotent.
* ``overwrite_table`` -- full refresh.
* ``write_mart`` -- the serving copy (relational table replaced each run in
  the original); JDBC when a URL is given, else a parquet directory.  Written
  aside first and put in place by renaming, so a write that fails leaves the
  copy of before.
* ``stamp_day`` -- the constant date column added on the way out.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sources.schemas import PARTITION_COL


def write_partition(df: DataFrame, path: str, partition_col: str = PARTITION_COL) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def stamp_day(df: DataFrame, day: str) -> DataFrame:
    """``select D as data_dt, *`` (replacing a ``data_dt`` already present)."""
    rest = [c for c in df.columns if c != PARTITION_COL]
    return df.select(F.lit(day).alias(PARTITION_COL), *rest)


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def restore_folder(spark: SparkSession, target: str) -> None:
    """Finishes a replacement that was cut off between its two renames: the
    copy of before comes back if nothing took its place."""
    fs, to = _fs(spark, target)
    _, old = _fs(spark, f"{target}.before")
    if fs.exists(old):
        if fs.exists(to):
            fs.delete(old, True)
        else:
            fs.rename(old, to)


def replace_folder(df: DataFrame, target: str) -> None:
    """The folder ``target`` with the rows of ``df``, or as it was if the
    write fails."""
    spark = df.sparkSession
    restore_folder(spark, target)
    fs, to = _fs(spark, target)
    staging, old = f"{target}.new-{uuid.uuid4().hex}", _fs(spark, f"{target}.before")[1]
    try:
        df.write.parquet(staging)
        if fs.exists(to):
            fs.rename(to, old)
        if not fs.rename(_fs(spark, staging)[1], to):
            raise OSError(f"{staging} could not be moved to {target}")
    finally:
        fs.delete(_fs(spark, staging)[1], True)
        restore_folder(spark, target)


@dataclass(frozen=True)
class Dialect:
    """Statements that make an empty table like another one, and that put it
    in the other one's place."""

    like: str
    swap: tuple[str, ...]


STANDARD = Dialect("CREATE TABLE {new} (LIKE {name} INCLUDING ALL)",
                   ("ALTER TABLE {name} RENAME TO {old}", "ALTER TABLE {new} RENAME TO {name}", "DROP TABLE {old}"))
#: One statement renames both tables here; statements of a transaction would not wait for each other.
MYSQL = Dialect("CREATE TABLE {new} LIKE {name}", ("RENAME TABLE {name} TO {old}, {new} TO {name}", "DROP TABLE {old}"))


def dialect_of(url: str) -> Dialect:
    return MYSQL if url.split(":", 2)[1] in ("mysql", "mariadb") else STANDARD


def run_sql(spark: SparkSession, url: str, properties: dict[str, str] | None, statements: list[str]) -> None:
    """Statements in one transaction over a connection of the driver's JVM."""
    jvm = spark.sparkContext._jvm
    info = jvm.java.util.Properties()
    for key, value in (properties or {}).items():
        info.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, info)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            connection.createStatement().execute(statement)
        connection.commit()
    finally:
        connection.close()  # without a commit: rolled back


def replace_jdbc(df: DataFrame, url: str, name: str, properties: dict[str, str] | None = None, execute=run_sql) -> None:
    """A relational table with the rows of ``df``: a table like it (same
    definition) is filled by all tasks, then takes its place; if a task fails,
    the table stays as it was and the half-filled one goes at the next run.  A
    table that is not there yet is simply written."""
    spark, dialect = df.sparkSession, dialect_of(url)
    names = {"name": name, "new": f"{name}__new", "old": f"{name}__old"}
    execute(spark, url, properties, [f"DROP TABLE IF EXISTS {names[x]}" for x in ("new", "old")])
    try:
        execute(spark, url, properties, [dialect.like.format(**names)])
    except Exception:
        df.write.mode("append").jdbc(url, name, properties=properties or {})
        return
    df.write.mode("append").jdbc(url, names["new"], properties=properties or {})
    execute(spark, url, properties, [s.format(**names) for s in dialect.swap])


def write_mart(df: DataFrame, name: str, path: str | None = None, jdbc_url: str | None = None,
               properties: dict[str, str] | None = None) -> None:
    """Replace a serving table, all of it or nothing."""
    if jdbc_url:
        replace_jdbc(df, jdbc_url, name, properties)
    elif path:
        replace_folder(df, f"{path}/{name}")
    else:
        raise ValueError("write_mart needs a JDBC URL or a path")
