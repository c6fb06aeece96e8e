"""The daily batch pipeline: every job for one business date, chained
through partitioned parquet tables.

Each job writes its ``data_dt=D`` partition (dynamic overwrite) and the
next job reads that partition back.  The written table is the lineage cut:
a lost executor only re-runs tasks of the current job, and re-running a
date rewrites exactly that date.  Two-sink jobs write the partition first
and serve the mart from the read-back copy, so nothing is computed twice.
Yesterday's machine locations are read from their own partition path and
today's are written to a different partition.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import days_before, days_between
from ..operators import content, location, machine, revenue, users
from ..sinks import overwrite_table, stamp_day, write_mart, write_partition
from ..sources import catalog, schemas
from ..sources.tables import _exists, on_day, read_table

TABLES = {
    "requests": "ALL_CLIENT_TABLES",
    "play_log": "TO_CLIENT_SONG_PLAY_OPERATE_REQ_D",
    "song_base": "TW_SONG_BASEINFO_D",
    "song_features": "TW_SONG_FTUR_D",
    "song_sketch": "TW_SONG_DAY_SKETCH_D",
    "song_rsi": "TW_SONG_RSI_D",
    "singer_rsi": "TW_SINGER_RSI_D",
    "mac_base": "TW_MAC_BASEINFO_D",
    "mac_loc": "TW_MAC_LOC_D",
    "cnsm": "TW_CNSM_BRIEF_D",
    "usr": "TW_USR_BASEINFO_D",
    "mac_stat": "TW_MAC_STAT_D",
    "region": "TM_MAC_REGION_STAT_D",
    "merchant": "TM_USR_MRCHNT_STAT_D",
}


#: Tables with one row a machine and day.
MACHINE_TABLES = ("mac_base", "mac_loc")


@dataclass
class RawTables:
    """The ODS inputs of one run (any DataFrames with the raw schemas)."""

    play_log: DataFrame
    song_info: DataFrame
    mac_a: DataFrame
    mac_loc_a: DataFrame
    mac_b: DataFrame
    provinces: DataFrame
    cities: DataFrame
    areas: DataFrame
    store_map: DataFrame
    stores: DataFrame
    user_locations: DataFrame
    gazetteer: DataFrame
    consumption: DataFrame
    users_wechat: DataFrame
    users_alipay: DataFrame
    users_qq: DataFrame
    users_app: DataFrame
    logins: DataFrame


@dataclass
class Warehouse:
    """Folders under ``root``; with ``database`` each of them is a table of the
    session catalog too, and jobs read the tables by name.  With ``buckets``
    the machine-level tables are bucketed by machine, so the revenue job joins
    them without a shuffle."""

    root: str
    jdbc_url: str | None = None
    jdbc_properties: dict[str, str] = field(default_factory=dict)
    database: str | None = None
    buckets: int | None = None

    def path(self, key: str) -> str:
        return f"{self.root}/{TABLES.get(key, key)}"

    def write(self, df: DataFrame, key: str, first: str | None = None, last: str | None = None) -> None:
        """The days of ``df`` in place of those of the table; with a catalog
        the days ``first`` to ``last`` are attached that have been landed."""
        if self.database and self.buckets and key in MACHINE_TABLES:
            catalog.write_bucketed(df, self.database, TABLES[key], self.path(key), "MID", self.buckets)
            return
        write_partition(df, self.path(key))
        if self.database:
            spark = df.sparkSession
            days = [d for d in days_between(first, last or first) if _exists(spark, f"{self.path(key)}/{schemas.PARTITION_COL}={d}")]
            catalog.publish(spark, self.database, TABLES.get(key, key), self.path(key), df.schema, days)

    def read(self, spark: SparkSession, key: str) -> DataFrame:
        if self.database:
            return catalog.read(spark, self.database, TABLES.get(key, key))
        return spark.read.parquet(self.path(key))

    def mart(self, df: DataFrame, name: str) -> None:
        write_mart(df, name, path=f"{self.root}/marts", jdbc_url=self.jdbc_url, properties=self.jdbc_properties)


def _read(spark: SparkSession, wh: Warehouse, key: str, day: str) -> DataFrame:
    return on_day(wh.read(spark, key), day)


def run_ingest(spark: SparkSession, wh: Warehouse, log_path: str) -> DataFrame:
    """J1: raw client-log text -> one directory per (day, request type) and the
    play-log table partitioned by day.  Returns unparsable play payloads per
    day (dropped from the play log) for the run report."""
    from ..sources import client_log

    requests = client_log.split_requests(client_log.read_client_log(spark, log_path))
    client_log.write_demultiplexed(requests, wh.path("requests"))
    landed = spark.read.parquet(wh.path("requests"))
    write_partition(client_log.decode_play_requests(landed), wh.path("play_log"))
    return client_log.unparsable_play_requests(landed)


def run_content(spark: SparkSession, wh: Warehouse, raw: RawTables, day: str,
                approx_distinct: bool = False) -> None:
    """J2-J5 for ``day``.  Exact by default (31 days of the play log are
    scanned once).  With ``approx_distinct`` only today's log partition is
    read: it becomes one row of plays and HLL sketches per song
    (TW_SONG_DAY_SKETCH_D), and the horizons are merged from 31 days of
    those rows -- distinct users/orders become estimates (~1.6%)."""
    overwrite_table(content.clean_catalog(raw.song_info), wh.path("song_base"))
    songs = spark.read.parquet(wh.path("song_base"))
    if approx_distinct:
        wh.write(content.song_day_sketches(raw.play_log, day), "song_sketch", day)
        sketches = wh.read(spark, "song_sketch")
        features = content.song_features_from_sketches(sketches, songs, day)
    else:
        features = content.song_features(raw.play_log, songs, day)
    wh.write(features, "song_features", day)
    features = _read(spark, wh, "song_features", day)
    wh.write(content.song_rsi(features), "song_rsi", day)
    wh.write(content.singer_rsi(features), "singer_rsi", day)
    for key, mart in (("song_rsi", "tm_song_rsi"), ("singer_rsi", "tm_singer_rsi")):
        wh.mart(stamp_day(content.top_ranked(_read(spark, wh, key, day)), day), mart)


def run_machines(spark: SparkSession, wh: Warehouse, raw: RawTables, day: str) -> None:
    run_profiles(spark, wh, raw, day)
    yesterday = _yesterday_locations(spark, wh, day)
    wh.write(location.machine_location(raw.user_locations, raw.gazetteer, day, yesterday=yesterday), "mac_loc", day)


def run_profiles(spark: SparkSession, wh: Warehouse, raw: RawTables, day: str) -> None:
    profile = machine.machine_profile(
        raw.mac_a, raw.mac_loc_a, raw.mac_b, raw.provinces, raw.cities, raw.areas, raw.store_map, raw.stores, day
    )
    wh.write(profile, "mac_base", day)
    wh.mart(stamp_day(_read(spark, wh, "mac_base", day), day), "tm_mac_baseinfo")


def _yesterday_locations(spark: SparkSession, wh: Warehouse, day: str) -> DataFrame | None:
    prev = days_before(day, 1)
    path = f"{wh.path('mac_loc')}/{schemas.PARTITION_COL}={prev}"
    if not _exists(spark, path):
        return None
    return spark.read.parquet(path)


def run_users(spark: SparkSession, wh: Warehouse, raw: RawTables, day: str, active_days: int = 7) -> None:
    wh.write(users.consumption_brief(raw.consumption, day), "cnsm", day)
    everyone = users.all_users(raw.users_wechat, raw.users_alipay, raw.users_qq, raw.users_app)
    wh.write(users.active_profiles(raw.logins, everyone, day), "usr", day)
    profiles = wh.read(spark, "usr")
    wh.mart(users.active_list(profiles, day, active_days=active_days), "user_7days_active")


def run_revenue(spark: SparkSession, wh: Warehouse, day: str, include_refund_only: bool = False) -> None:
    stat = revenue.machine_stat(
        wh.read(spark, "mac_base"),
        wh.read(spark, "mac_loc"),
        wh.read(spark, "cnsm"),
        wh.read(spark, "usr"),
        day,
        include_refund_only=include_refund_only,
    )
    wh.write(stat, "mac_stat", day)
    stat_day = wh.read(spark, "mac_stat")
    wh.mart(stamp_day(_read(spark, wh, "mac_stat", day), day), "tm_machine_rev_infos")
    wh.write(revenue.region_stat(stat_day, day), "region", day)
    wh.write(revenue.merchant_share(stat_day, day), "merchant", day)
    wh.mart(stamp_day(_read(spark, wh, "region", day), day), "tm_mac_region_stat_d")
    wh.mart(stamp_day(_read(spark, wh, "merchant", day), day), "tm_usr_mrchnt_stat_d")


def run_day(spark: SparkSession, wh: Warehouse, raw: RawTables, day: str) -> None:
    """All batch jobs for ``day`` in dependency order."""
    run_content(spark, wh, raw, day)
    run_machines(spark, wh, raw, day)
    run_users(spark, wh, raw, day)
    run_revenue(spark, wh, day)


def backfill(spark: SparkSession, wh: Warehouse, raw: RawTables, first_day: str, last_day: str) -> None:
    """Fill a range of dates.  Jobs whose grain allows it run ONCE over the
    whole range (song features via ``song_features_range``, rankings,
    machine locations carried forward from the day before the range,
    consumption brief, active profiles); machine profiles and revenue marts,
    whose grain is every machine on every day, are written day by day."""
    from ..functions.dates import days_before
    from ..sources.tables import between_days

    overwrite_table(content.clean_catalog(raw.song_info), wh.path("song_base"))
    songs = spark.read.parquet(wh.path("song_base"))
    wh.write(content.song_features_range(raw.play_log, songs, first_day, last_day), "song_features", first_day, last_day)
    features = between_days(wh.read(spark, "song_features"), first_day, last_day)
    wh.write(content.song_rsi(features), "song_rsi", first_day, last_day)
    wh.write(content.singer_rsi(features), "singer_rsi", first_day, last_day)
    wh.write(users.consumption_brief(between_days(raw.consumption, first_day, last_day)), "cnsm", first_day, last_day)
    everyone = users.all_users(raw.users_wechat, raw.users_alipay, raw.users_qq, raw.users_app)
    wh.write(users.active_profiles(between_days(raw.logins, first_day, last_day), everyone), "usr", first_day, last_day)
    before = _yesterday_locations(spark, wh, first_day)
    wh.write(location.machine_location_range(raw.user_locations, raw.gazetteer, first_day, last_day, yesterday=before), "mac_loc", first_day, last_day)
    days, d = [], last_day
    while d >= first_day:
        days.append(d)
        d = days_before(d, 1)
    for day in reversed(days):
        run_profiles(spark, wh, raw, day)
    # per-machine-per-day grain (idle machines included): one job per day
    for day in reversed(days):
        run_revenue(spark, wh, day)


def backfill_sketches(spark: SparkSession, wh: Warehouse, raw: RawTables, first_day: str, last_day: str) -> None:
    """Daily song sketches for a whole range in one job (seeds the approximate mode)."""
    from ..sources.tables import between_days

    write_partition(content.song_day_sketches(between_days(raw.play_log, first_day, last_day)), wh.path("song_sketch"))


def raw_from_tables(spark: SparkSession, root: str, wh: Warehouse | None = None, fmt: str = "parquet") -> RawTables:
    """The raw layer under ``root``; the play log is the one that ``run_ingest``
    wrote into the warehouse, where there is one."""
    from ..sources.raw_tables import RAW_LAYER, read_raw

    tables = {name: read_raw(spark, root, name, fmt) for name in RAW_LAYER if name != "play_log"}
    if wh is not None and _exists(spark, wh.path("play_log")):
        play_log = read_table(spark, wh.path("play_log"), schemas.PLAY_LOG)
    else:
        play_log = read_raw(spark, root, "play_log", fmt)
    return RawTables(play_log=play_log, **tables)


def raw_from_driver(spark: SparkSession, sf_dir: str) -> RawTables:
    """The stand-in raw tables derived from the driver's tables."""
    from ..sources import driver_tables as dt

    t = {n: dt.load(spark, sf_dir, n) for n in ("events", "part", "supplier", "nation", "region", "orders", "customer")}
    machines = dt.machine_count(spark, sf_dir)
    return RawTables(
        play_log=dt.play_log(t["events"], machines),
        song_info=dt.song_catalog(t["part"]),
        mac_a=dt.machines_a(dt.known_to_a(t["supplier"])),
        mac_loc_a=dt.machine_locations_a(dt.known_location(t["supplier"])),
        mac_b=dt.machines_b(dt.known_to_b(t["supplier"])),
        provinces=dt.provinces(t["region"]),
        cities=dt.cities(t["nation"]),
        areas=dt.areas(t["nation"]),
        store_map=dt.store_map(dt.known_store(t["supplier"])),
        stores=dt.stores(t["nation"]),
        user_locations=dt.user_locations(t["events"], machines),
        gazetteer=dt.gazetteer(t["customer"], t["nation"], t["region"]),
        consumption=dt.consumption(t["orders"], machines),
        users_wechat=dt.users_wechat(t["customer"], machines),
        users_alipay=dt.users_alipay(t["customer"], machines),
        users_qq=dt.users_qq(t["customer"], machines),
        users_app=dt.users_app(t["customer"], machines),
        logins=dt.logins(t["events"]),
    )
