"""Lookup-table helpers: deterministic de-duplication and size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup is broadcast only when it is proven to hold at most this many rows
# AND the optimizer's size estimate (conservative for file scans) is at most
# this many bytes; beyond either the join stays a shuffle join (AQE may still
# pick a broadcast from runtime sizes under spark.sql.autoBroadcastJoinThreshold).
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 << 20


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (plan statistics, no job)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return None


def _bytes_ok(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= max_bytes


def dedupe_by_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key; when a key repeats, the smallest row (by all columns) wins."""
    others = [c for c in df.columns if c != key]
    if not others:
        return df.distinct()
    return df.groupBy(key).agg(F.min(F.struct(*others)).alias("_r")).select(key, "_r.*")


def has_at_most(df: DataFrame, n: int) -> bool:
    """Cheap bound check: reads at most ``n + 1`` rows."""
    return df.limit(n + 1).count() <= n


def all_at_most(dfs: list[DataFrame], n: int) -> list[bool]:
    """``has_at_most`` for several frames in ONE job (each reads at most n + 1 rows)."""
    if not dfs:
        return []
    tagged = None
    for i, df in enumerate(dfs):
        part = df.limit(n + 1).select(F.lit(i).alias("_i"))
        tagged = part if tagged is None else tagged.unionByName(part)
    counts = {r["_i"]: r["count"] for r in tagged.groupBy("_i").count().collect()}
    return [counts.get(i, 0) <= n and _bytes_ok(df) for i, df in enumerate(dfs)]


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, small: bool | None = None) -> DataFrame:
    if small is None:
        small = has_at_most(df, max_rows) and _bytes_ok(df)
    return F.broadcast(df) if small else df


def lookup_join(fact: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str,
                max_rows: int = BROADCAST_MAX_ROWS, small: bool | None = None) -> DataFrame:
    """Left join to a lookup keyed uniquely on ``lookup_key`` (de-duplicated here).
    ``small`` passes a size check already made (see ``all_at_most``)."""
    dim = dedupe_by_key(lookup, lookup_key)
    dim = maybe_broadcast(dim, max_rows, small)
    joined = fact.join(dim, fact[fact_key] == dim[lookup_key], "left")
    return joined.drop(dim[lookup_key]) if lookup_key != fact_key else joined
