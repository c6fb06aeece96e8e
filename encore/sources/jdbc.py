"""Relational import (J0): a full-refresh snapshot of a catalog table.

The original used a one-mapper command-line import; here the read is split
over ranges of a numeric column so that a large table is fetched in parallel,
then written as a full overwrite.  The ranges hold about equally many rows:
their bounds are quantiles of a sample of the keys, so keys in clusters (an
old block of small numbers, a new one of large ones) do not fill one range.
A table of a few rows is cut evenly between its least and greatest key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed value: rows fetched per round trip
FETCH_SIZE = 10000
#: Of so many keys one is sampled, by its remainder.
SAMPLE_EVERY = 101
#: Sampled keys per range below which all keys are read instead; with fewer
#: keys than that in the whole table no quantiles are taken.
LEAST_SAMPLE = 20


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int = 1,
) -> DataFrame:
    props = {"fetchsize": str(FETCH_SIZE), **properties}
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=props,
    )


def range_predicates(column: str, bounds: list[int]) -> list[str]:
    """WHERE clauses of the ranges between the bounds: together they hold every
    row once, those without a key in the first one."""
    bounds = sorted(set(bounds))
    if not bounds:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:], strict=False)]
    return [f"{column} < {bounds[0]} OR {column} IS NULL", *middle, f"{column} >= {bounds[-1]}"]


def quantile_bounds(keys: DataFrame, splits: int) -> list[int]:
    """Inner bounds of ``splits`` ranges with about equally many of the keys
    (one numeric column); only the bounds come to the driver."""
    column = keys.columns[0]
    shares = [i / splits for i in range(1, splits)]
    return [int(b) for b in keys.select(keys[column].cast("double")).approxQuantile(column, shares, 0.1 / splits)] if shares else []


def _even_ranges(spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str, splits: int) -> DataFrame:
    """The table in ``splits`` equal ranges between its least and greatest key."""
    bounds = read_jdbc_table(spark, url, f"(SELECT MIN({column}) AS LOW, MAX({column}) AS HIGH FROM {table}) B", properties).first()
    if bounds is None or bounds[0] is None:
        return read_jdbc_table(spark, url, table, properties)
    return read_jdbc_table(spark, url, table, properties, column, int(bounds[0]), int(bounds[1]) + 1, splits)


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str, splits: int,
                     every: int = SAMPLE_EVERY) -> DataFrame:
    """The table in ``splits`` ranges of about equally many rows."""
    def keys(where: str) -> DataFrame:
        return read_jdbc_table(spark, url, f"(SELECT {column} AS K FROM {table} WHERE {where}) S", properties)

    def few(sample: DataFrame) -> bool:
        return sample.limit(LEAST_SAMPLE * splits).count() < LEAST_SAMPLE * splits

    sample = keys(f"MOD({column}, {every}) = 0")
    if few(sample):
        sample = keys(f"{column} IS NOT NULL")
        if few(sample):
            return _even_ranges(spark, url, table, properties, column, splits)
    props = {"fetchsize": str(FETCH_SIZE), **properties}
    return spark.read.jdbc(url, table, predicates=range_predicates(column, quantile_bounds(sample, splits)), properties=props)


def import_table(spark: SparkSession, root: str, field: str, url: str, table: str, properties: dict[str, str],
                 partition_column: str | None = None, num_partitions: int = 1) -> None:
    """J0: one relational table into the raw layer, split by ranges of a numeric
    column with about equally many rows."""
    from .raw_tables import write_raw

    if partition_column is None or num_partitions < 2:
        df = read_jdbc_table(spark, url, table, properties)
    else:
        df = read_jdbc_ranges(spark, url, table, properties, partition_column, num_partitions)
    write_raw(df, root, field)
