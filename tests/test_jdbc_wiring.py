"""JDBC import and mart sink wiring, checked with stand-in reader/writer
objects (no database may be started in this environment)."""

import os

import pytest
from pyspark.sql import functions as F

from encore.sinks import replace_jdbc, restore_folder, write_mart
from encore.sources.jdbc import FETCH_SIZE, read_jdbc_ranges, read_jdbc_table


class _Recorder:
    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self
        return call


class _Session:
    def __init__(self):
        self.read = _Recorder()


class _Frame:
    def __init__(self):
        self.write = _Recorder()


def test_partitioned_snapshot_read():
    spark = _Session()
    read_jdbc_table(spark, "jdbc:x://h/db", "song", {"user": "u"}, "NBR", 0, 1000, 8)
    name, args, kwargs = spark.read.calls[-1]
    assert name == "jdbc" and args == ("jdbc:x://h/db", "song")
    assert kwargs["column"] == "NBR" and kwargs["numPartitions"] == 8
    assert (kwargs["lowerBound"], kwargs["upperBound"]) == (0, 1000)
    assert kwargs["properties"]["fetchsize"] == str(FETCH_SIZE) and kwargs["properties"]["user"] == "u"


class _Jdbc(_Frame):
    """A frame whose JDBC write fills ``tables``, or fails half-way."""

    def __init__(self, tables, rows, fails=False):
        super().__init__()
        self.sparkSession, self.tables, self.rows, self.fails = None, tables, rows, fails
        self.write = self

    def mode(self, m):
        assert m == "append"
        return self

    def jdbc(self, url, name, properties=None):
        self.tables.setdefault(name, {"defined": "by the writer", "rows": []})
        self.tables[name]["rows"] += self.rows[:1] if self.fails else self.rows
        if self.fails:
            raise OSError("a task failed")


def _database(tables):
    """Executes the few statements of a replacement on a dict of tables."""
    def execute(spark, url, properties, statements):
        now = dict(tables)  # one transaction
        for s in statements:
            w = s.replace("(", " ").replace(",", "").split()
            if w[0] == "DROP":
                now.pop(w[-1], None)
            elif w[0] == "CREATE":
                like = w[w.index("LIKE") + 1]
                now[w[2]] = {"defined": now[like]["defined"], "rows": []}
            elif w[0] == "ALTER":
                now[w[-1]] = now.pop(w[2])
            else:
                assert w[:2] == ["RENAME", "TABLE"]
                now[w[4]] = now.pop(w[2])
                now[w[7]] = now.pop(w[5])
        tables.clear()
        tables.update(now)

    return execute


@pytest.mark.parametrize("url", ["jdbc:x://h/db", "jdbc:mysql://h/db"])
def test_mart_is_replaced_whole_and_keeps_its_definition(url):
    tables = {"mart": {"defined": "by hand", "rows": [1, 2]}}
    replace_jdbc(_Jdbc(tables, [3, 4, 5]), url, "mart", execute=_database(tables))
    assert tables == {"mart": {"defined": "by hand", "rows": [3, 4, 5]}}


@pytest.mark.parametrize("url", ["jdbc:x://h/db", "jdbc:mysql://h/db"])
def test_failed_write_leaves_the_mart_of_before(url):
    tables = {"mart": {"defined": "by hand", "rows": [1, 2]}}
    with pytest.raises(OSError):
        replace_jdbc(_Jdbc(tables, [3, 4, 5], fails=True), url, "mart", execute=_database(tables))
    assert tables["mart"] == {"defined": "by hand", "rows": [1, 2]}
    replace_jdbc(_Jdbc(tables, [6]), url, "mart", execute=_database(tables))  # the next run clears up
    assert tables == {"mart": {"defined": "by hand", "rows": [6]}}


def test_first_write_makes_the_mart():
    tables = {}
    replace_jdbc(_Jdbc(tables, [1]), "jdbc:x://h/db", "mart", execute=_database(tables))
    assert tables == {"mart": {"defined": "by the writer", "rows": [1]}}


def test_folder_mart_is_replaced_whole(spark, scratch):
    def rows():
        return sorted(r[0] for r in spark.read.parquet(f"{scratch}/mart").collect())

    write_mart(spark.range(3), "mart", path=scratch)
    write_mart(spark.range(10, 12), "mart", path=scratch)
    assert rows() == [10, 11]
    broken = spark.range(8).repartition(4).select(F.when(F.col("id") == 5, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="half-way"):
        write_mart(broken, "mart", path=scratch)
    assert rows() == [10, 11] and os.listdir(scratch) == ["mart"]


def test_folder_mart_survives_a_cut_between_the_renames(spark, scratch):
    write_mart(spark.range(3), "mart", path=scratch)
    os.rename(f"{scratch}/mart", f"{scratch}/mart.before")  # then the process ended
    restore_folder(spark, f"{scratch}/mart")
    assert spark.read.parquet(f"{scratch}/mart").count() == 3
    write_mart(spark.range(4), "mart", path=scratch)
    os.rename(f"{scratch}/mart", f"{scratch}/mart.before")
    write_mart(spark.range(5), "mart", path=scratch)
    assert spark.read.parquet(f"{scratch}/mart").count() == 5 and os.listdir(scratch) == ["mart"]


class _StreamSession:
    def __init__(self):
        self.readStream = _Recorder()


def test_kafka_source_wiring(spark):
    from encore.streaming.jobs import kafka_records

    fake = _StreamSession()
    kafka_records(fake, "broker:9092", "logtopic", "earliest")
    calls = [(c[0], c[1]) for c in fake.readStream.calls]
    assert ("format", ("kafka",)) in calls
    assert ("option", ("kafka.bootstrap.servers", "broker:9092")) in calls
    assert ("option", ("subscribe", "logtopic")) in calls
    assert ("option", ("startingOffsets", "earliest")) in calls
    assert ("load", ()) in calls


class _Database:
    """Stands in for a JDBC reader: tables are frames, subqueries and
    predicates are run by Spark; the rows of each partition are told."""

    def __init__(self, spark, **tables):
        self.real, self.read, self.parts = spark, self, []
        for name, frame in tables.items():
            frame.createOrReplaceTempView(name)

    def jdbc(self, url, table, properties=None, predicates=None, **_):
        frame = self.real.sql(f"SELECT * FROM {table}")
        if predicates is None:
            return frame
        pieces = [frame.where(p) for p in predicates]
        self.parts = [p.count() for p in pieces]
        out = pieces[0]
        for p in pieces[1:]:
            out = out.unionByName(p)
        return out


@pytest.mark.parametrize("every", [101, 1])
def test_import_splits_clustered_keys_evenly(spark, every):
    """Most keys in two narrow clusters far apart, some without a key."""
    small, large = spark.range(1, 8001), spark.range(10 ** 12, 10 ** 12 + 8000)
    few = spark.range(10 ** 6, 10 ** 11, 10 ** 9)
    keys = small.union(large).union(few).union(spark.createDataFrame([(None,)] * 50, "id long"))
    db = _Database(spark, clustered=keys.selectExpr("id AS NBR", "concat('n', id) AS name"))
    got = read_jdbc_ranges(db, "jdbc:x://h/db", "clustered", {}, "NBR", 8, every=every)
    assert got.count() == keys.count() and got.distinct().count() == keys.distinct().count()
    assert got.where("NBR IS NULL").count() == 50
    assert len(db.parts) == 8 and max(db.parts) <= 1.5 * keys.count() / 8


def test_import_of_few_rows(spark):
    for ids in ([], [None, None], [5], [7, 7, 7, 7]):
        db = _Database(spark, few=spark.createDataFrame([(i,) for i in ids], "NBR long"))
        got = read_jdbc_ranges(db, "jdbc:x://h/db", "few", {}, "NBR", 4)
        assert sorted((r[0] is not None, r[0]) for r in got.collect()) == sorted((i is not None, i) for i in ids)
