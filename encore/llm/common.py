"""Helpers shared by the operators: staged tables, size-checked joins,
component labels, Arrow batches of texts."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.session import checkpoint_dir

#: White space as the query contracts define it, as a regex class body.
WS = r"\x20\x09-\x0D"
#: Most rows of an id table that a join may broadcast (8 bytes each); larger
#: ones are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Rows and bytes of an Arrow batch that carries whole texts.
TEXT_BATCH = 512
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session (see ``session.checkpoint_dir``); it
    raises where none is named."""
    return checkpoint_dir(spark)


def give_back() -> None:
    """Returns memory that this worker has freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def tidy(run):
    """A ``mapInArrow`` function that gives freed memory back, now and then
    and at its end: workers live on, and what one step needed most would
    otherwise stay with them through all later steps."""
    @functools.wraps(run)
    def tidied(batches):
        try:
            for i, out in enumerate(run(batches), 1):
                yield out
                if i % 64 == 0:
                    give_back()
        finally:
            give_back()

    return tidied


class Workspace:
    """Intermediate tables of one run in the shared folder.

    ``put`` writes a frame as Parquet and returns a frame that reads it, which
    cuts the lineage; ``drop`` deletes tables that nothing reads any more.
    Tables that the returned frame reads stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark).rstrip('/')}/encore-llm/{name}-{uuid.uuid4().hex}"
        self.names = 0

    def put(self, df: DataFrame, text_batch: int = TEXT_BATCH, **options: str) -> DataFrame:
        self.names += 1
        path = f"{self.base}/{self.names}"
        limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(text_batch), "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
        before = {key: self.spark.conf.get(key) for key in limits}
        for key, value in limits.items():
            self.spark.conf.set(key, value)
        try:
            df.write.options(**options).parquet(path)
        finally:
            for key, value in before.items():
                self.spark.conf.set(key, value)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            delete(self.spark, frame._staged)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def keep_ids(df: DataFrame, ids: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """Semi or anti join of wide rows with a staged id table: without a
    shuffle of ``df`` while the table holds at most BROADCAST_ROWS rows (it is
    counted), by a shuffle join beyond that."""
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return df.join(ids, on, how)


def maybe_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a staged table) marked for broadcast if it has at most ``rows``
    rows, which are counted; as it is otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in pc.cast(column, pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys (the input is sorted by them) as one
    table each; holds one group and one batch at a time."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table.column(k).to_pylist() for k in keys]
        values = list(zip(*columns, strict=True))
        begin = 0
        for i, value in enumerate(values):
            if value != last:
                if i > begin:
                    held.append(table.slice(begin, i - begin))
                if held:
                    yield pa.concat_tables(held)
                held, begin, last = [], i, value
        held.append(table.slice(begin))
    if held:
        yield pa.concat_tables(held)


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): (id, comp) with the smallest
    id of each component, for every id that has an edge.

    Alternating large-star and small-star steps; every step is a minimum per
    node (combined before the shuffle) and a join, and each round is staged,
    so a node with any number of neighbours is never gathered.
    """
    pairs = edges.where(F.col("a") != F.col("b")).select("a", "b").distinct()
    now = ws.put(pairs)
    before = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = ws.put(large.where("a != b").distinct())
        # every edge now runs from the larger to the smaller id
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a != b").distinct()
        after = ws.put(small)
        ws.drop(large, now)
        now = after
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    stars = now.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    return stars.union(now.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())


def shards(df: DataFrame, salt: Column, n: int) -> Column:
    """A salt in [0, n) from the given column."""
    return F.pmod(F.xxhash64(salt), F.lit(n))
