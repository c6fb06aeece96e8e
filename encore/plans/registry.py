"""Named queries over the driver tables: one per operator group of the
inventory.  Each takes ``(spark, sf_dir)`` and returns a DataFrame; the
DuckDB twins live in ``oracles/duckdb_sql.py``.

All jobs run for the business date ``BUSINESS_DAY``, the last day of the
driver's event month, so the 30-day horizons cover the whole ``events``
table.  Queries whose natural grain is per day (log demux, consumption,
active profiles, windowed stream counts) run for every day at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import time14
from ..functions.text import city_from_address, province_from_address
from ..operators import content, location, machine, revenue, users
from ..sources import client_log
from ..sources import driver_tables as dt
from ..sources.tables import normalize_nulls, on_day
from ..streaming import windows as sw

BUSINESS_DAY = "20240130"
FIRST_DAY = "20240101"
SCORE_DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark, sf):
    return dt.load(spark, sf, "events")


def _plays(spark, sf):
    return dt.play_log(_events(spark, sf), dt.machine_count(spark, sf))


def _lines(spark, sf):
    return dt.client_log_lines(_events(spark, sf), dt.machine_count(spark, sf))


def _reports(spark, sf):
    return dt.user_locations(_events(spark, sf), dt.machine_count(spark, sf))


def _places(spark, sf):
    return dt.gazetteer(*_tables(spark, sf, "customer", "nation", "region"))


def _catalog(spark, sf):
    return content.clean_catalog(dt.song_catalog(dt.load(spark, sf, "part")))


def _features(spark, sf):
    return content.song_features(_plays(spark, sf), _catalog(spark, sf), BUSINESS_DAY)


def _rounded(df: DataFrame, col: str = "RSI") -> DataFrame:
    return df.withColumn(col, F.round(col, SCORE_DIGITS))


def _neutral(df: DataFrame, nullable_ints: tuple[str, ...] = ()) -> DataFrame:
    """Engine-neutral presentation for cross-engine value checks (the
    operators keep their types): decimals as doubles, integer columns that
    hold NULLs as doubles, arrays as comma-joined text -- so Spark and the
    SQL twin export the same values whether read as rows or as pandas."""
    from pyspark.sql import types as T

    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType) or f.name in nullable_ints:
            c = c.cast("double")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ----------------------------------------------------------------------------- J1

def log_demux_counts(spark, sf):
    """Lines per (day, request type) after the six-part filter (STR1-2, FLT1, SNK5 grain)."""
    reqs = client_log.split_requests(_lines(spark, sf))
    return reqs.groupBy("data_dt", "req_type").agg(F.count(F.lit(1)).alias("n_lines"))


def log_split_filter(spark, sf):
    """Lines kept and dropped by the six-part rule, per day of the line's time stamp."""
    lines = _lines(spark, sf)
    parts = client_log.split_dropping_trailing(F.col("value"), client_log.SEPARATOR)
    kept = client_log.has_parts(parts, client_log.LINE_PARTS)
    return lines.groupBy(F.substring("value", 1, 8).alias("data_dt")).agg(
        F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped")
    )


def play_decode(spark, sf):
    """Decoded song-play requests (FLT6, JS1)."""
    reqs = client_log.split_requests(_lines(spark, sf))
    return client_log.decode_play_requests(reqs)


# ----------------------------------------------------------------------------- J2-J5

def catalog_clean(spark, sf):
    return _neutral(_catalog(spark, sf))


def song_horizons(spark, sf):
    return content.song_horizon_counts(_plays(spark, sf), BUSINESS_DAY)


def song_features(spark, sf):
    return _features(spark, sf)


def _features_all_days(spark, sf):
    return content.song_features_range(_plays(spark, sf), _catalog(spark, sf), FIRST_DAY, BUSINESS_DAY)


def song_features_all_days(spark, sf):
    """J3 for every day of the month in one job (backfill)."""
    return _features_all_days(spark, sf)


def song_rsi_all_days(spark, sf):
    """J4 rankings for every day of the month (one ranking per day and period)."""
    return _rounded(content.song_rsi(_features_all_days(spark, sf)))


def song_day(spark, sf):
    """Per-day song counts for every day (AG1, AG3)."""
    return content.song_day_counts(_plays(spark, sf))


def song_tops(spark, sf):
    """Best single-day counts over the 7 / 30-day horizons from the daily table (AG8, AG9)."""
    return content.tops_from_history(content.song_day_counts(_plays(spark, sf)), BUSINESS_DAY)


def song_rsi(spark, sf):
    return _rounded(content.song_rsi(_features(spark, sf)))


def song_rsi_top30(spark, sf):
    return _rounded(content.song_rsi(_features(spark, sf), top_n=content.TOP_N))


def singer_rsi(spark, sf):
    return _rounded(content.singer_rsi(_features(spark, sf)))


def singer_rsi_top30(spark, sf):
    return _rounded(content.singer_rsi(_features(spark, sf), top_n=content.TOP_N))


# ----------------------------------------------------------------------------- machines, users, revenue


def _tables(spark, sf, *names):
    return [dt.load(spark, sf, n) for n in names]


def _brief(spark, sf):
    return users.consumption_brief(dt.consumption(dt.load(spark, sf, "orders"), dt.machine_count(spark, sf)))


def _all_users(spark, sf):
    cust = dt.load(spark, sf, "customer")
    n = dt.machine_count(spark, sf)
    return users.all_users(*[of(cust, n) for of in (dt.users_wechat, dt.users_alipay, dt.users_qq, dt.users_app)])


def _profiles(spark, sf):
    return users.active_profiles(dt.logins(_events(spark, sf)), _all_users(spark, sf))


def _machine_profile(spark, sf):
    supplier, nation, region = _tables(spark, sf, "supplier", "nation", "region")
    return machine.machine_profile(
        dt.machines_a(dt.known_to_a(supplier)), dt.machine_locations_a(dt.known_location(supplier)),
        dt.machines_b(dt.known_to_b(supplier)),
        dt.provinces(region), dt.cities(nation), dt.areas(nation), dt.store_map(dt.known_store(supplier)), dt.stores(nation),
        BUSINESS_DAY,
    )


def _locations(spark, sf):
    """Today's locations rolled forward over yesterday's (both computed here,
    from one scan and one nearest-place pass)."""
    return location.machine_location_with_yesterday(_reports(spark, sf), _places(spark, sf), BUSINESS_DAY)


def _machine_stat(spark, sf):
    return revenue.machine_stat(
        _machine_profile(spark, sf), _locations(spark, sf), _brief(spark, sf), _profiles(spark, sf), BUSINESS_DAY
    )


def consumption_brief(spark, sf):
    return _brief(spark, sf)


def revenue_by_machine(spark, sf):
    return revenue.revenue_by_machine(_brief(spark, sf))


def refund_by_machine(spark, sf):
    return revenue.refund_by_machine(_brief(spark, sf))


def user_union(spark, sf):
    return _all_users(spark, sf)


_PROFILE_INTS = ("USR_EXP", "SCORE", "LEVEL")


def active_profile(spark, sf):
    return _neutral(_profiles(spark, sf), _PROFILE_INTS)


def active_list(spark, sf):
    return _neutral(users.active_list(_profiles(spark, sf), BUSINESS_DAY), _PROFILE_INTS)


def active_list_all_days(spark, sf):
    """The 7-of-8-days active list for every day of the month in one job."""
    return _neutral(users.active_list_range(_profiles(spark, sf), FIRST_DAY, BUSINESS_DAY), _PROFILE_INTS)


def new_users(spark, sf):
    return revenue.new_users(on_day(_profiles(spark, sf), BUSINESS_DAY), BUSINESS_DAY)


def new_users_all_days(spark, sf):
    return revenue.new_users_all_days(_profiles(spark, sf))


def machine_ids(spark, sf):
    supplier = dt.load(spark, sf, "supplier")
    return machine.machine_ids(dt.machines_a(dt.known_to_a(supplier)), dt.machines_b(dt.known_to_b(supplier)))


def machine_locations_clean(spark, sf):
    return machine.clean_locations(dt.machine_locations_a(dt.load(spark, sf, "supplier")))


def address_parse(spark, sf):
    """Province and city read from every raw machine address (STR7, STR8)."""
    raw = dt.machine_locations_a(dt.load(spark, sf, "supplier"))
    return raw.select("MID", "ADDR", province_from_address("ADDR").alias("PRVC"), city_from_address("ADDR").alias("CTY"))


def time14_clean(spark, sf):
    """14-digit times of both machine systems normalised (DT3)."""
    supplier = dt.load(spark, sf, "supplier")
    a = dt.machine_locations_a(supplier).select(
        "MID", F.lit("A").alias("system"), time14("REV_TM").alias("T1"), time14("SALE_TM").alias("T2")
    )
    b = dt.machines_b(supplier).select(
        "MID", F.lit("B").alias("system"), time14("ACTV_TM").alias("T1"), time14("ORDER_TM").alias("T2")
    )
    return a.unionByName(b)


def machine_profile(spark, sf):
    return _machine_profile(spark, sf)


def machine_mode_location(spark, sf):
    return location.mode_location(_reports(spark, sf), BUSINESS_DAY)


def place_lookup(spark, sf):
    return location.locate(location.mode_location(_reports(spark, sf), BUSINESS_DAY), _places(spark, sf))


def location_rollforward(spark, sf):
    return _locations(spark, sf)


def location_all_days(spark, sf):
    """Machine locations of every day of the month in one job (the backfill of
    J7); no snapshot before the first day."""
    return location.machine_location_range(_reports(spark, sf), _places(spark, sf), FIRST_DAY, BUSINESS_DAY)


def machine_stat(spark, sf):
    return _machine_stat(spark, sf)


def machine_stat_refunds(spark, sf):
    """J10 keeping refund-only (machine, package, pay type) groups, NULL keys matched null-safely."""
    return revenue.machine_stat(
        _machine_profile(spark, sf), _locations(spark, sf), _brief(spark, sf), _profiles(spark, sf), BUSINESS_DAY,
        include_refund_only=True,
    )


def machine_mode_location_nonblank(spark, sf):
    """Modal coordinate chosen among non-blank reports only."""
    return location.mode_location(_reports(spark, sf), BUSINESS_DAY, drop_blank_first=True)


def region_stat(spark, sf):
    return _neutral(revenue.region_stat(_machine_stat(spark, sf), BUSINESS_DAY))


def merchant_share(spark, sf):
    return _neutral(revenue.merchant_share(_machine_stat(spark, sf), BUSINESS_DAY))


# ----------------------------------------------------------------------------- streaming twins (batch)


def _records(spark, sf):
    return dt.play_records(_events(spark, sf), dt.machine_count(spark, sf))


def pv_sliding(spark, sf):
    return sw.pv_counts(_records(spark, sf), panes=True)


def uv_batch5s(spark, sf):
    return sw.uv_batch_counts(_records(spark, sf))


def uv_exact(spark, sf):
    return sw.uv_exact_counts(_records(spark, sf), panes=True)


def pv_uv(spark, sf):
    """The dashboards' one chain: page views and visitors together (SM3-4)."""
    return sw.pv_uv_counts(_records(spark, sf), panes=True)


def hot_songs(spark, sf):
    return sw.top_songs(sw.song_counts(_records(spark, sf), panes=True))


def record_parse(spark, sf):
    """Messages of the bus parsed to records, per minute: kept and malformed (JS5)."""
    raw = dt.record_messages(_events(spark, sf), dt.machine_count(spark, sf))

    def minute(df):
        return df.select(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute"), "*")

    kept = minute(sw.parse_records(raw)).groupBy("minute").agg(
        F.count(F.lit(1)).alias("kept"), F.count("uid").alias("with_user"), F.sum(F.length("songname")).alias("name_chars"))
    lost = minute(sw.malformed_records(raw)).groupBy("minute").agg(F.count(F.lit(1)).alias("malformed"))
    return kept.join(lost, "minute", "full").select(
        "minute", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("kept", "with_user", "name_chars", "malformed")])


def play_tab_text(spark, sf):
    """Decoded plays as tab-joined text (STR3)."""
    return client_log.to_tab_text(play_decode(spark, sf))


def null_text_clean(spark, sf):
    """Raw rows that write a missing value as '' or the text null, cleaned (the
    ingest boundary of the raw layers)."""
    raw = dt.user_rows_with_null_text(dt.load(spark, sf, "customer"), dt.machine_count(spark, sf))
    return normalize_nulls(raw)


QUERIES: dict[str, Query] = {
    "log_split_filter": log_split_filter,
    "log_demux_counts": log_demux_counts,
    "play_decode": play_decode,
    "catalog_clean": catalog_clean,
    "song_horizons": song_horizons,
    "song_features": song_features,
    "song_features_all_days": song_features_all_days,
    "song_rsi_all_days": song_rsi_all_days,
    "song_day": song_day,
    "song_tops": song_tops,
    "song_rsi": song_rsi,
    "song_rsi_top30": song_rsi_top30,
    "singer_rsi": singer_rsi,
    "singer_rsi_top30": singer_rsi_top30,
    "consumption_brief": consumption_brief,
    "revenue_by_machine": revenue_by_machine,
    "refund_by_machine": refund_by_machine,
    "user_union": user_union,
    "active_profile": active_profile,
    "active_list": active_list,
    "active_list_all_days": active_list_all_days,
    "new_users": new_users,
    "new_users_all_days": new_users_all_days,
    "address_parse": address_parse,
    "time14_clean": time14_clean,
    "machine_ids": machine_ids,
    "machine_locations_clean": machine_locations_clean,
    "machine_profile": machine_profile,
    "machine_mode_location": machine_mode_location,
    "place_lookup": place_lookup,
    "location_rollforward": location_rollforward,
    "location_all_days": location_all_days,
    "machine_stat": machine_stat,
    "machine_stat_refunds": machine_stat_refunds,
    "machine_mode_location_nonblank": machine_mode_location_nonblank,
    "region_stat": region_stat,
    "merchant_share": merchant_share,
    "pv_sliding": pv_sliding,
    "uv_batch5s": uv_batch5s,
    "uv_exact": uv_exact,
    "pv_uv": pv_uv,
    "hot_songs": hot_songs,
    "record_parse": record_parse,
    "play_tab_text": play_tab_text,
    "null_text_clean": null_text_clean,
}
