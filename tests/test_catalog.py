"""Warehouse tables by name: partitions attached on landing, pruned from the catalog."""

import uuid

from encore.plans import daily
from encore.sources import catalog

from .conftest import SF_SMALL

DAYS = ["20240129", "20240130"]


def test_jobs_by_table_names(spark, scratch):
    database = f"wh_{uuid.uuid4().hex[:8]}"
    wh = daily.Warehouse(f"{scratch}/wh", database=database)
    raw = daily.raw_from_driver(spark, SF_SMALL)
    for day in [*DAYS, DAYS[1]]:  # a day run again is replaced, not doubled
        daily.run_users(spark, wh, raw, day)
    for key in ("cnsm", "usr"):
        name = f"{database}.{daily.TABLES[key]}"
        by_path = spark.read.parquet(wh.path(key))
        by_name = wh.read(spark, key)
        assert by_name.columns == by_path.columns
        assert by_name.count() == by_path.count() == wh.read(spark, key).where(f"data_dt in ({', '.join(map(repr, DAYS))})").count()
        assert sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()) == [f"data_dt={d}" for d in DAYS]
    one = daily._read(spark, wh, "cnsm", DAYS[0])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_dt" in plan and "PushedFilters: []" in plan
    assert len(one.inputFiles()) < len(wh.read(spark, "cnsm").inputFiles())
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(
        f"DESCRIBE EXTENDED {database}.{daily.TABLES['cnsm']} PARTITION (data_dt = '{DAYS[0]}')").collect()}
    assert f"{one.count()} rows" in facts["Partition Statistics"]
    spark.sql(f"DROP DATABASE {database} CASCADE")
    assert spark.read.parquet(wh.path("cnsm")).count() > 0  # external tables: the data stays


def test_a_range_is_attached_in_one_go(spark, scratch):
    database = f"wh_{uuid.uuid4().hex[:8]}"
    wh = daily.Warehouse(f"{scratch}/wh", database=database)
    rows = spark.createDataFrame([("m1", d) for d in ("20240228", "20240301")], "MID string, data_dt string")
    wh.write(rows, "mac_loc", "20240227", "20240302")
    assert sorted(r.data_dt for r in wh.read(spark, "mac_loc").collect()) == ["20240228", "20240301"]
    assert spark.sql(f"SHOW PARTITIONS {database}.TW_MAC_LOC_D").count() == 2
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_tables_without_days(spark, scratch):
    database = f"wh_{uuid.uuid4().hex[:8]}"
    spark.range(5).write.parquet(f"{scratch}/it's")
    catalog.publish(spark, database, "songs", f"{scratch}/it's", spark.range(1).schema)
    assert catalog.read(spark, database, "songs").count() == 5
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {database}.songs").collect()}
    assert "5 rows" in facts["Statistics"]
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_machine_tables_join_without_a_shuffle(spark, scratch):
    """The revenue job reads profile and location in buckets by machine; its
    rows equal those from plain folders."""
    from encore.operators import revenue

    database = f"wh_{uuid.uuid4().hex[:8]}"
    raw = daily.raw_from_driver(spark, SF_SMALL)
    wh = daily.Warehouse(f"{scratch}/wh", database=database, buckets=4)
    plain = daily.Warehouse(f"{scratch}/plain")
    for w in (wh, plain):
        daily.run_machines(spark, w, raw, DAYS[1])
        daily.run_users(spark, w, raw, DAYS[1])
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def stat(w):
            return revenue.machine_stat(*[w.read(spark, k) for k in ("mac_base", "mac_loc", "cnsm", "usr")], DAYS[1])

        assert sorted(map(str, stat(wh).collect())) == sorted(map(str, stat(plain).collect()))
        plan = stat(wh)._jdf.queryExecution().executedPlan().toString()
        for table in ("TW_MAC_BASEINFO_D", "TW_MAC_LOC_D".lower()):
            lines = plan.splitlines()
            at = next(i for i, x in enumerate(lines) if table.lower() in x.lower())
            assert "Bucketed: true" in lines[at] or "SelectedBucketsCount" in lines[at]
            depth = lines[at].index("FileScan")
            for line in reversed(lines[:at]):  # what stands above the scan, up to the join
                here = len(line) - len(line.lstrip(" :+-"))
                if here < depth:
                    depth = here
                    if "Join" in line:
                        break
                    assert "Exchange" not in line, plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    daily.run_machines(spark, wh, raw, DAYS[1])  # a day run again is replaced
    assert wh.read(spark, "mac_base").count() == plain.read(spark, "mac_base").count()
    spark.sql(f"DROP DATABASE {database} CASCADE")
