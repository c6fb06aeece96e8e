"""Golden rows and invariants of the job operators."""

import random
import re

from pyspark.sql import functions as F

from encore.operators import content, location, revenue, users
from encore.operators.ranking import mode_per_key
from encore.plans import registry
from encore.sources import schemas
from encore.sources.schemas import GAZETTEER_PLACE_COLS

from .conftest import SF_MID, SF_SMALL

D = "20240130"


def _loc_rows(spark, rows):
    return spark.createDataFrame([(*r, D) for r in rows], schemas.USER_LOCATIONS)


def test_mode_location_ties_and_repeats(spark):
    rows = [("u1", "m1", "1", "1"), ("u1", "m1", "1", "1"), ("u2", "m1", "1", "1"), ("u3", "m1", "2", "2")]
    got = location.mode_location(_loc_rows(spark, rows), D).collect()
    assert [(r.MID, r.X, r.Y, r.CNT) for r in got] == [("m1", "1", "1", 2)]


def test_mode_location_blank_mode(spark):
    rows = [("u1", "m1", "", ""), ("u2", "m1", "", ""), ("u3", "m1", "2", "2")]
    assert location.mode_location(_loc_rows(spark, rows), D).count() == 0
    got = location.mode_location(_loc_rows(spark, rows), D, drop_blank_first=True).collect()
    assert [(r.MID, r.X, r.Y, r.CNT) for r in got] == [("m1", "2", "2", 1)]


def test_mode_per_key_tie_break(spark):
    df = spark.createDataFrame([("k", "b", 3), ("k", "a", 3), ("k", "c", 1)], "k string, x string, n long")
    assert [tuple(r) for r in mode_per_key(df, "k", "n", ["x"]).collect()] == [("k", "a", 3)]


def test_roll_forward(spark):
    cols = location.LOCATION_COLS

    def frame(mids, tag):
        return spark.createDataFrame(
            [(m, tag, tag, 1, *([tag] * 18)) for m in mids],
            "MID string, X string, Y string, CNT int, " + ", ".join(f"{c} string" for c in cols[4:]),
        )

    out = location.roll_forward(frame(["m2", "m3"], "today"), frame(["m1", "m2"], "yday"), D)
    got = sorted((r.MID, r.X) for r in out.collect())
    assert got == [("m1", "yday"), ("m2", "today"), ("m3", "today")]


def test_active_list(spark):
    days = ["2024012" + str(i) for i in range(3, 10)] + ["20240130"]
    rows = [("u1", d) for d in days[1:]] + [("u2", d) for d in days[2:]]
    logins = spark.createDataFrame(rows, schemas.LOGINS)
    empty = spark.createDataFrame([], schemas.USERS_WECHAT)
    alipay = spark.createDataFrame([], schemas.USERS_ALIPAY)
    qq = spark.createDataFrame([], schemas.USERS_QQ)
    app = spark.createDataFrame([], schemas.USERS_APP)
    profiles = users.active_profiles(logins, users.all_users(empty, alipay, qq, app))
    got = users.active_list(profiles, D, active_days=7).collect()
    assert [(r.UID, r.REG_CHNL, r.GDR) for r in got] == [("u1", "未知", "不明")]


def _brief(spark, rows):
    schema = "MID string, PKG_ID string, PAY_TYPE string, UID string, ORDR_ID string, COIN_CNT int, COIN_PRC long, ABN_TYP int, data_dt string"
    return spark.createDataFrame([(*r, D) for r in rows], schema)


def test_refund_join_literal_and_full(spark):
    brief = _brief(spark, [
        ("m1", "p1", "wx", "u1", "o1", 1, 100, 0),
        ("m1", "p1", "wx", "u2", "o2", 1, 30, 2),
        ("m1", "p2", "wx", "u3", "o3", 1, 40, 2),
    ])
    profile = spark.createDataFrame([("m1", D)], "MID string, data_dt string")
    for c in ("MAC_NM", "STORE_NM", "BUS_MODE", "PAY_SW", "SCENCE_CATGY", "SUB_SCENCE_CATGY", "SCENE",
              "SUB_SCENE", "BRND", "SUB_BRND", "PRVC", "CTY", "AREA", "PRTN_NM"):
        profile = profile.withColumn(c, F.lit(None).cast("string"))
    profile = profile.withColumn("PRDCT_TYP", F.lit(2))
    for c in ("INV_RATE", "AGE_RATE", "COM_RATE", "PAR_RATE"):
        profile = profile.withColumn(c, F.lit(None).cast("double"))
    locs = spark.createDataFrame([], "MID string, PRVC string, CTY string, DISTRICT string, data_dt string")
    profs = spark.createDataFrame([], "UID string, REG_MID string, REG_DT string, data_dt string")
    literal = revenue.machine_stat(profile, locs, brief, profs, D).collect()
    assert [(r.PKG_ID, r.TOT_REV, r.TOT_REF) for r in literal] == [("p1", 100, 30)]
    full = revenue.machine_stat(profile, locs, brief, profs, D, include_refund_only=True).collect()
    assert sorted((r.PKG_ID, r.TOT_REV, r.TOT_REF) for r in full) == [("p1", 100, 30), ("p2", 0, 40)]


def test_null_package_never_matches_refund(spark):
    brief = _brief(spark, [
        ("m1", None, "wx", "u1", "o1", 1, 100, 0),
        ("m1", None, "wx", "u2", "o2", 1, 30, 2),
    ])
    groups = revenue.revenue_and_refunds(brief)
    assert groups.count() == 1


def test_rank_invariants(spark):
    ranked = registry.song_rsi(spark, SF_MID).collect()
    by_period = {}
    for r in ranked:
        by_period.setdefault(r.PERIOD, []).append(r)
    for rows in by_period.values():
        ranks = sorted(r.RSI_RANK for r in rows)
        assert ranks == list(range(1, len(rows) + 1))
        ordered = sorted(rows, key=lambda r: r.RSI_RANK)
        assert all(a.RSI >= b.RSI for a, b in zip(ordered, ordered[1:]))


def test_horizon_monotone(spark):
    for r in registry.song_features(spark, SF_MID).collect():
        assert r.SING_CNT <= r.RCT_7_SING_CNT <= r.RCT_30_SING_CNT
        assert r.USR_CNT <= r.RCT_7_USR_CNT <= r.RCT_30_USR_CNT
        assert r.SING_CNT <= r.RCT_7_TOP_SING_CNT <= r.RCT_30_TOP_SING_CNT
        assert r.RCT_7_TOP_SING_CNT <= r.RCT_7_SING_CNT


def test_history_tops_match_log_tops(spark):
    """The original best-day rule over this job's own past partitions equals
    the log-based rule once every earlier day has been produced."""
    from encore.functions.dates import days_before
    from encore.sources import driver_tables as dt

    log = dt.play_log(dt.load(spark, SF_SMALL, "events"))
    catalog = content.clean_catalog(dt.song_catalog(dt.load(spark, SF_SMALL, "part")))
    days = [days_before(D, i) for i in range(0, 31)]
    history = None
    for d in days:
        f = content.song_features(log, catalog, d)
        history = f if history is None else history.unionByName(f)
    tops = {r.NBR: r for r in content.tops_from_history(history, D).collect()}
    for r in content.song_features(log, catalog, D).collect():
        assert tops[r.NBR].RCT_7_TOP_SING_CNT == r.RCT_7_TOP_SING_CNT
        assert tops[r.NBR].RCT_30_TOP_SING_CNT == r.RCT_30_TOP_SING_CNT


def test_single_scan_of_play_log(spark):
    """The multi-horizon features read the play log once."""
    plan = registry.song_features(spark, SF_MID)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") == 1


def test_global_row_number_equals_window(spark):
    from pyspark.sql import Window

    from encore.operators.ranking import global_row_number

    df = spark.range(0, 20000).select(
        (F.col("id") % 3).cast("string").alias("g"),
        ((F.col("id") * 7919) % 1000).alias("score"),
        F.col("id").alias("k"),
    )
    order = [F.desc("score"), F.asc("k")]
    got = global_row_number(df, ["g"], order, "r", num_partitions=7)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert sorted(map(tuple, got.select("g", "k", "r").collect())) == sorted(map(tuple, want.select("g", "k", "r").collect()))


def test_results_independent_of_partitioning(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(map(tuple, registry.song_rsi(spark, SF_SMALL).collect())))
            results.append(sorted(map(tuple, registry.machine_stat(spark, SF_SMALL).collect())))
        assert results[0] == results[2] and results[1] == results[3]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_plans_stay_distributed_and_jvm_side(spark):
    """No registered query funnels all rows into one partition or calls Python per row."""
    for name, fn in registry.QUERIES.items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        # the engine's own runtime filters gather one sketch
        plan = re.sub(r"Exchange SinglePartition[^\n]*\n[^\n]*partial_bloom_filter_agg", "", plan)
        assert "SinglePartition" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_feature_options(spark):
    from encore.sources import driver_tables as dt

    log = dt.play_log(dt.load(spark, SF_SMALL, "events"))
    catalog = content.clean_catalog(dt.song_catalog(dt.load(spark, SF_SMALL, "part")))
    base = {r.NBR: r for r in content.song_features(log, catalog, D).collect()}
    views = {r.NBR: r for r in content.song_features(log, catalog, D, op_types=["view"]).collect()}
    assert set(views) <= set(base)
    assert all(views[k].SING_CNT <= base[k].SING_CNT for k in views)
    likes = log.select("SONGID", "data_dt", F.lit(2).alias("n"))
    liked = {r.NBR: r for r in content.song_features(log, catalog, D, likes=likes).collect()}
    for k, r in liked.items():
        assert r.SUPP_CNT == 2 * r.SING_CNT and r.RCT_30_SUPP_CNT == 2 * r.RCT_30_SING_CNT
        assert r.RCT_7_TOP_SUPP_CNT == 2 * r.RCT_7_TOP_SING_CNT
    some_user = log.select("UID").first()[0]
    no_user = {r.NBR: r for r in content.song_features(log, catalog, D, exclude_uid=some_user).collect()}
    assert sum(r.RCT_30_USR_CNT for r in no_user.values()) < sum(r.RCT_30_USR_CNT for r in base.values())


def test_feature_series_equals_daily_job(spark):
    from encore.functions.dates import days_before
    from encore.sources import driver_tables as dt

    log = dt.play_log(dt.load(spark, SF_SMALL, "events"))
    catalog = content.clean_catalog(dt.song_catalog(dt.load(spark, SF_SMALL, "part")))
    first = days_before(D, 9)
    series = content.song_features_range(log, catalog, first, D)
    got = sorted(map(tuple, series.collect()))
    want = []
    for i in range(0, 10):
        want += [tuple(r) for r in content.song_features(log, catalog, days_before(D, i)).collect()]
    assert got == sorted(want)


def test_machine_profile_one_row_per_machine(spark):
    from encore.operators import machine

    mac_a = spark.createDataFrame([("m1", "s", "h", "v", "e", "u", "1", "t", "1", "1")], schemas.MAC_A)
    loc_a = spark.createDataFrame(
        [("m1", None, None, "湖北省武汉市洪山区", None, "20230101", "20230102")], schemas.MAC_LOC_A
    )
    b_rows = [("m1", t, "KTV", "标准版", 50.0, 1.0, 2.0, 3.0, "1", "20230301", "20230301", "1", "0", "0", "0",
               "addr", "ground") for t in (1, 2)]  # two product types for one machine
    admin_b = spark.createDataFrame(b_rows, schemas.MAC_ADMIN_B)
    provinces = spark.createDataFrame([("0", "P-a"), ("0", "P-b")], schemas.PROVINCES)  # duplicate key
    cities = spark.createDataFrame([("0", "C")], schemas.CITIES)
    areas = spark.createDataFrame([("0", "A")], schemas.AREAS)
    store_map = spark.createDataFrame([("m1", "9")], schemas.STORE_MAP)
    stores = spark.createDataFrame([("9", "g", "t", "st", "sc", "ss", "b", "sb")], schemas.STORES)
    out = machine.machine_profile(mac_a, loc_a, admin_b, provinces, cities, areas, store_map, stores, D).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.PRVC, r.CTY, r.AREA, r.STORE_NM, r.BUS_MODE, r.REV_TM) == ("湖北", "武汉", "A", "g", "联营", "20230101000000")


def test_catalog_drops_blank_ids(spark):
    from encore.sources import driver_tables as dt

    songs = dt.song_catalog(dt.load(spark, SF_SMALL, "part")).limit(3)
    blank = songs.limit(1).withColumn("NBR", F.lit(""))
    assert content.clean_catalog(songs.unionByName(blank)).count() == 3


def test_sketch_features_match_exact_on_small_data(spark):
    from encore.sources import driver_tables as dt

    log = dt.play_log(dt.load(spark, SF_SMALL, "events"))
    catalog = content.clean_catalog(dt.song_catalog(dt.load(spark, SF_SMALL, "part")))
    exact = sorted(map(tuple, content.song_features(log, catalog, D).collect()))
    approx = sorted(map(tuple, content.song_features_from_sketches(content.song_day_sketches(log), catalog, D).collect()))
    assert approx == exact  # HLL keeps exact coupon lists at these cardinalities


def test_two_day_locations_in_one_pass(spark):
    from encore.functions.dates import days_before
    from encore.sources import driver_tables as dt

    events = dt.load(spark, SF_SMALL, "events")
    locs = dt.user_locations(events)
    gaz = dt.gazetteer(*[dt.load(spark, SF_SMALL, t) for t in ("customer", "nation", "region")])
    prev = days_before(D, 1)
    separate = location.machine_location(locs, gaz, D, yesterday=location.machine_location(locs, gaz, prev))
    together = location.machine_location_with_yesterday(locs, gaz, D)
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, separate.select(*together.columns).collect()))


def test_merchant_rate_scale(spark):
    stat = spark.createDataFrame(
        [("m1", "a1", "wx", 1, 0, 1000, 0, 30.0, 10.0, 20.0, None, D)],
        "MID string, AGE_ID string, PAY_TYPE string, REV_ORDR_CNT long, REF_ORDR_CNT long, TOT_REV long, "
        "TOT_REF long, INV_RATE double, AGE_RATE double, COM_RATE double, PAR_RATE double, data_dt string",
    )
    literal = revenue.merchant_share(stat, D).first()
    percent = revenue.merchant_share(stat, D, rate_scale=100).first()
    assert float(literal.TOT_INV_REV) == 30000.0 and float(percent.TOT_INV_REV) == 300.0
    assert float(literal.TOT_PAR_REV) == 0.0


def _by_day(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_locations_of_a_month_in_one_job_equal_daily_runs(spark, scratch):
    """After a snapshot of the day before (the registered query has none);
    machines that go silent keep their last place."""
    import datetime as dtm

    places = spark.createDataFrame([(i, 20.0 + i, 100.0 + i, *[f"{c}{i}" for c in GAZETTEER_PLACE_COLS]) for i in range(5)],
                                   "place_id long, lat double, lng double, " + ", ".join(f"{c} string" for c in GAZETTEER_PLACE_COLS))
    rng = random.Random(12)
    day = lambda n: (dtm.date(2024, 1, 28) + dtm.timedelta(days=n)).strftime("%Y%m%d")
    spots = [("20.1", "100.1"), ("23", "103"), ("", ""), ("x", "1"), ("-45", "10"), (None, "3")]
    rows = [(rng.choice(["u1", "u2", "u3", None]), f"m{rng.randrange(6)}", *rng.choice(spots), day(rng.choice([-40, -31, -3, 0, 1, 2, 5]))) for _ in range(60)]
    rows += [("u1", "old", "20.1", "100.1", day(-3)), ("u1", "new", "23", "103", day(4))]
    reports = spark.createDataFrame(rows, "UID string, MID string, LAT string, LNG string, data_dt string")
    snapshot = location.machine_location(reports, places, day(-1), window_days=3)
    for before in (snapshot,):
        want, yesterday = [], before
        for n in range(3):
            today = location.machine_location(reports, places, day(n), yesterday=yesterday, window_days=3)
            path = f"{scratch}/{n}"
            today.write.parquet(path)
            yesterday = spark.read.parquet(path)
            want += [tuple(r) for r in yesterday.collect()]
        got = location.machine_location_range(reports, places, day(0), day(2), yesterday=before, window_days=3)
        assert got.columns == yesterday.columns
        assert _by_day(got) == sorted(want, key=str) and len(want) > 12
