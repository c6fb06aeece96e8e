"""Ranking and top-k helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, partition_cols: list, order_cols: list[Column], name: str) -> DataFrame:
    """``row_number() over (partition by … order by …)`` with a total order.

    Callers always end ``order_cols`` with a unique key so ranks never depend
    on row arrival order.
    """
    w = Window.partitionBy(*partition_cols).orderBy(*order_cols)
    return df.withColumn(name, F.row_number().over(w))


def top_per_group(df: DataFrame, partition_cols: list, order_cols: list[Column], n: int,
                  name: str = "rank") -> DataFrame:
    """Top ``n`` rows per group.  The rank filter directly over the window lets
    Catalyst insert a partial ``WindowGroupLimit`` before the shuffle, so each
    map task ships at most ``n`` rows per group."""
    return rank_within(df, partition_cols, order_cols, name).where(F.col(name) <= n)


def mode_per_key(df: DataFrame, key, count_col: str, tie_cols: list[str]) -> DataFrame:
    """The row with the highest ``count_col`` per ``key``; ties go to the
    smallest ``tie_cols``.

    ``min_by`` over the ordering ``(-count, ties…)`` is an aggregate with a
    map-side partial step (sort-based, as its buffer holds strings), so a
    key holding a large share of the rows is reduced before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    # explicit NULL placement in the ties (NULL sorts like '' would: first)
    order = F.struct(
        -F.col(count_col),
        *[x for c in tie_cols for x in (F.col(c).isNotNull(), F.col(c))],
    )
    best = F.min_by(F.struct(*[F.col(c) for c in others]), order)
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")


#: Rows that one task of a global ranking sorts.
RANK_ROWS = 250_000


def global_row_number(df: DataFrame, group_cols: list[str], order_cols: list[Column], name: str,
                      num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by group_cols order by order_cols)`` for
    a few very large groups (e.g. one ranking per day over the whole catalog).
    The number of tasks follows the number of rows, not the shuffle setting.

    A plain window sorts each group in one task.  Here the rows are
    range-partitioned on (group, order) over ``num_partitions`` tasks and
    sorted within partitions; every row gets its position inside its
    partition, a tiny table of (partition, group) counts gives each
    partition's offset within the group, and offset + position is the rank.
    ``order_cols`` must end in a unique key (a total order), which makes the
    range partitioning and positions deterministic on recomputation.  The
    offsets table has at most partitions x groups rows and is broadcast only
    under the size check.
    """
    from ..session import materialize
    from .small import BROADCAST_MAX_ROWS, has_at_most, maybe_broadcast

    rows = materialize(df)  # counted, then ranked
    n = num_partitions or max(1, -(-rows.count() // RANK_ROWS))
    keys = [F.col(g) for g in group_cols]
    # materialised once: the offsets and the final rows read the same placement
    placed = materialize(
        rows.repartitionByRange(n, *keys, *order_cols)
        .sortWithinPartitions(*keys, *order_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    stats = placed.groupBy("_pid", *group_cols).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    offsets = offsets.drop("_n")
    # narrow rows (partition id, group keys, two longs): the exact row bound is
    # the size proof; the optimizer would estimate this aggregate at its input's size
    small = has_at_most(offsets, BROADCAST_MAX_ROWS)
    joined = placed.join(maybe_broadcast(offsets, small=small), ["_pid", *group_cols], "inner")
    ranked = joined.withColumn(name, (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).cast("int"))
    return ranked.drop("_pid", "_pos", "_first", "_offset")
