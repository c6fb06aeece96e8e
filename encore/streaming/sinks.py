"""``foreachBatch`` sinks.

Both are idempotent per batch id, so a micro-batch replayed after a failure
(at-least-once delivery from the source) rewrites the same output instead
of double counting.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .windows import HOT_TOP_N, top_songs

BATCH_DIR = "batch_id"
#: Boards and snapshots that stay for readers that opened one just before.
KEEP = 3


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def committed_batches(spark: SparkSession, path: str) -> list[int]:
    """Committed batch directories under ``path``, ascending (metadata listing only)."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    ids = []
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if name.startswith(f"{BATCH_DIR}=") and fs.exists(st.getPath().suffix("/_SUCCESS")):
            ids.append(int(name.split("=", 1)[1]))
    return sorted(ids)


def latest_batch(spark: SparkSession, path: str) -> int | None:
    ids = committed_batches(spark, path)
    return ids[-1] if ids else None


def drop_batches(spark: SparkSession, path: str, ids: list[int]) -> None:
    """Removes batch directories that nothing reads any more."""
    fs, _ = _fs(spark, path)
    for i in ids:
        fs.delete(_fs(spark, f"{path}/{BATCH_DIR}={i}")[1], True)


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    b = latest_batch(spark, path)
    return None if b is None else spark.read.parquet(f"{path}/{BATCH_DIR}={b}")


def current_board(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest closed window of the latest board snapshot."""
    board = read_latest(spark, path)
    if board is None:
        return None
    last = board.agg(F.max("window_end").alias("_m"))
    return board.join(last, board["window_end"] == last["_m"], "inner").drop("_m")


def _max_version(rows: DataFrame | None, version_col: str, less: str | None = None) -> str | None:
    """Greatest version (less an SQL interval or number) as text; None without rows."""
    if rows is None:
        return None
    top = F.max(version_col) if less is None else F.max(version_col) - F.expr(less)
    return rows.agg(top.cast("string")).first()[0]


class _Resumable:
    """A sink whose outputs tell where to go on.

    A window is written when it is complete, all windows that end at a time in
    one batch, and a batch's rows are committed at once.  So the greatest
    window end among the outputs is a position that cannot be apart from them:
    every window up to it is there, none after it.  ``resume_after`` makes a
    sink go on from such a position under new batch numbers: rows of windows
    up to it are left out, as a replay holds these only in part.
    """

    first_batch = 0
    after: str | None = None

    def resume_after(self, after: str | None, first_batch: int) -> None:
        self.after, self.first_batch = after, first_batch

    def _new(self, batch: DataFrame, version_col: str) -> DataFrame:
        if self.after is None:
            return batch
        return batch.where(F.col(version_col) > F.lit(self.after).cast(batch.schema[version_col].dataType))


class TopKReplaceSink(_Resumable):
    """Hot-song board: each trigger replaces the board with the top ``n`` songs
    of every window in the batch.  Empty batches leave the board as it is.

    ``write`` receives the ranked DataFrame; the default writes a new
    snapshot directory per batch (readers take the latest), a JDBC writer
    with mode ``overwrite`` can be passed instead.
    """

    def __init__(self, path: str, n: int = HOT_TOP_N, key: str = "songname",
                 write: Callable[[DataFrame, str], None] | None = None):
        self.path, self.n, self.key, self.write = path, n, key, write

    def position(self, spark: SparkSession) -> tuple[str | None, int]:
        """(greatest window end written, next free batch number)."""
        last = latest_batch(spark, self.path)
        return _max_version(read_latest(spark, self.path), "window_end"), 0 if last is None else last + 1

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch, batch_id = self._new(batch, "window_end"), batch_id + self.first_batch
        batch.persist()  # two actions below: compute the micro-batch once
        try:
            if batch.isEmpty():
                return
            ranked = top_songs(batch, self.n, self.key)
            target = f"{self.path}/{BATCH_DIR}={batch_id}"
            if self.write is not None:
                self.write(ranked, target)
            else:
                ranked.write.mode("overwrite").parquet(target)
                spark = batch.sparkSession
                drop_batches(spark, self.path, committed_batches(spark, self.path)[:-KEEP])
        finally:
            batch.unpersist()


class KeyedUpsertSink(_Resumable):
    """Keyed table (``key -> value``, e.g. machine -> page views) kept as
    append-only deltas plus periodic snapshots.

    Each batch writes only its own rows (``delta/batch_id=N``, overwritten on
    replay), so a trigger costs O(batch), not O(table).  Once
    ``compact_every`` deltas wait, the latest snapshot and they are merged
    into ``snapshot/batch_id=N``; then the merged deltas go, and all but the
    last ``KEEP`` snapshots.  A replayed batch that a snapshot holds already
    is not written again.  Per key the row with the greatest
    ``version_col`` (the window end) wins, so replayed or late batches never
    move a key backwards.  ``expire_after`` (an SQL interval or number) ages
    out keys whose last window is that much older than the newest of the
    table, from what is read and, at the next snapshot, from what is kept;
    ``expire_before`` does so by a bound of the caller's.  ``read_current``
    gives the table as of the last batch.
    """

    def __init__(self, path: str, key_cols: list[str], version_col: str = "window_end",
                 compact_every: int = 20, expire_before: Callable[[], object] | None = None, expire_after: str | None = None):
        self.path, self.key_cols, self.version_col = path, key_cols, version_col
        self.compact_every = compact_every
        self.expire_before, self.expire_after = expire_before, expire_after

    def position(self, spark: SparkSession) -> tuple[str | None, int]:
        """(greatest version written, next free batch number)."""
        ids = [i for part in ("delta", "snapshot") for i in committed_batches(spark, f"{self.path}/{part}")]
        return _max_version(self._pending_rows(spark), self.version_col), max(ids, default=-1) + 1

    def merge(self, rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in self.key_cols]
        best = F.max_by(F.struct(*others), F.col(self.version_col))
        merged = rows.groupBy(*self.key_cols).agg(best.alias("_r")).select(*self.key_cols, "_r.*")
        if self.expire_before is not None:
            merged = merged.where(F.col(self.version_col) >= F.lit(self.expire_before()))
        if self.expire_after is not None:
            oldest = _max_version(rows, self.version_col, self.expire_after)
            merged = merged.where(F.col(self.version_col) >= F.lit(oldest).cast(rows.schema[self.version_col].dataType))
        return merged

    def _pending_rows(self, spark: SparkSession, upto: int | None = None) -> DataFrame | None:
        snap_id = latest_batch(spark, f"{self.path}/snapshot")
        parts = []
        if snap_id is not None:
            parts.append(spark.read.parquet(f"{self.path}/snapshot/{BATCH_DIR}={snap_id}"))
        if committed_batches(spark, f"{self.path}/delta"):
            deltas = spark.read.parquet(f"{self.path}/delta")
            cond = F.lit(True)
            if snap_id is not None:
                cond = cond & (F.col(BATCH_DIR).cast("bigint") > snap_id)
            if upto is not None:
                cond = cond & (F.col(BATCH_DIR).cast("bigint") <= upto)
            parts.append(deltas.where(cond).drop(BATCH_DIR))
        if not parts:
            return None
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return rows

    def read_current(self, spark: SparkSession) -> DataFrame | None:
        rows = self._pending_rows(spark)
        return None if rows is None else self.merge(rows)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch, batch_id = self._new(batch, self.version_col), batch_id + self.first_batch
        spark = batch.sparkSession
        snapshot = latest_batch(spark, f"{self.path}/snapshot")
        if snapshot is not None and batch_id <= snapshot:
            return  # a replay of rows that the snapshot holds
        batch.persist()  # emptiness check + write: compute the micro-batch once
        try:
            if not batch.isEmpty():
                batch.write.mode("overwrite").parquet(f"{self.path}/delta/{BATCH_DIR}={batch_id}")
        finally:
            batch.unpersist()
        waiting = committed_batches(spark, f"{self.path}/delta")
        if len(waiting) >= self.compact_every:
            rows = self._pending_rows(spark, upto=batch_id)
            self.merge(rows).write.mode("overwrite").parquet(f"{self.path}/snapshot/{BATCH_DIR}={batch_id}")
            drop_batches(spark, f"{self.path}/delta", [i for i in waiting if i <= batch_id])
            drop_batches(spark, f"{self.path}/snapshot", committed_batches(spark, f"{self.path}/snapshot")[:-KEEP])


class PvUvSink:
    """One micro-batch of (window, machine, pv, uv) rows upserted into the
    page-view and the visitor tables (each a ``KeyedUpsertSink``)."""

    def __init__(self, path: str, compact_every: int = 20, expire_after: str | None = None):
        self.pv = KeyedUpsertSink(f"{path}/pv", ["mid"], compact_every=compact_every, expire_after=expire_after)
        self.uv = KeyedUpsertSink(f"{path}/uv", ["mid"], compact_every=compact_every, expire_after=expire_after)

    def position(self, spark: SparkSession) -> tuple[str | None, int]:
        """The earlier of the two tables' positions; a batch may have reached
        one of them only."""
        (pv, i), (uv, k) = self.pv.position(spark), self.uv.position(spark)
        return None if pv is None or uv is None else min(pv, uv), max(i, k)

    def resume_after(self, after: str | None, first_batch: int) -> None:
        for table in (self.pv, self.uv):
            spark = SparkSession.active()
            table.resume_after(after if after is None else table.position(spark)[0], first_batch)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            self.pv(batch.select("window_start", "window_end", "mid", "pv"), batch_id)
            self.uv(batch.select("window_start", "window_end", "mid", "uv"), batch_id)
        finally:
            batch.unpersist()
