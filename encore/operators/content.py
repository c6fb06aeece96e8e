"""Content jobs: catalog cleaning (J2), daily song features (J3), song and
singer popularity index with rankings (J4, J5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    album_name,
    auth_company,
    empty_to_null,
    int_list,
    normalize_post_time,
    rsi_n_days,
    rsi_one_day,
    singer_fields,
)
from ..functions.dates import days_before
from ..sources.schemas import PARTITION_COL, SONG_INT_COLS
from ..session import materialize
from ..sources.tables import between_days, on_day
from .ranking import global_row_number, rank_within

# fixed values: trailing horizons (D-n .. D inclusive) and index periods
SHORT_DAYS = 7
LONG_DAYS = 30
TOP_N = 30


# --------------------------------------------------------------------------- J2

def clean_catalog(songs: DataFrame) -> DataFrame:
    """TO_SONG_INFO_D -> TW_SONG_BASEINFO_D (43 columns)."""
    singer1, singer2, singer1_id, singer2_id = singer_fields("SINGER_INFO")
    return songs.where(F.col("NBR") != "").select(
        "NBR",
        F.coalesce("NAME", "OTHER_NAME").alias("NAME"),
        "SOURCE",
        album_name("ALBUM").alias("ALBUM"),
        "PRDCT",
        "LANG",
        "VIDEO_FORMAT",
        "DUR",
        singer1.alias("SINGER1"),
        singer2.alias("SINGER2"),
        singer1_id.alias("SINGER1ID"),
        singer2_id.alias("SINGER2ID"),
        F.lit(0).alias("MAC_TIME"),
        normalize_post_time("POST_TIME").alias("POST_TIME"),
        "PINYIN_FST",
        "PINYIN",
        "SING_TYPE",
        "ORI_SINGER",
        "LYRICIST",
        "COMPOSER",
        *SONG_INT_COLS,
        auth_company("AUTH_CO").alias("AUTH_CO"),
        "STATE",
        empty_to_null(int_list("PRDCT_TYPE")).alias("PRDCT_TYPE"),
    )


# --------------------------------------------------------------------------- J3

COUNT_COLS = [
    "SING_CNT", "SUPP_CNT", "USR_CNT", "ORDR_CNT",
    "RCT_7_SING_CNT", "RCT_7_SUPP_CNT", "RCT_7_TOP_SING_CNT", "RCT_7_TOP_SUPP_CNT",
    "RCT_7_USR_CNT", "RCT_7_ORDR_CNT",
    "RCT_30_SING_CNT", "RCT_30_SUPP_CNT", "RCT_30_TOP_SING_CNT", "RCT_30_TOP_SUPP_CNT",
    "RCT_30_USR_CNT", "RCT_30_ORDR_CNT",
]
SINGER_SUM_COLS = [c for c in COUNT_COLS if not c.endswith(("USR_CNT", "ORDR_CNT"))]
CATALOG_COLS = [
    "NAME", "SOURCE", "ALBUM", "PRDCT", "LANG", "VIDEO_FORMAT", "DUR",
    "SINGER1", "SINGER2", "SINGER1ID", "SINGER2ID", "MAC_TIME",
]


def select_plays(play_log: DataFrame, op_types: list[str] | None = None,
                 exclude_uid: str | None = None) -> DataFrame:
    """Optional narrowing of the play log: only some operation types (e.g. the
    order-a-song operation) and/or without the "no user" id.  Defaults keep
    every row, as the original counted them."""
    rows = play_log
    if op_types is not None:
        rows = rows.where(F.col("OPTRATE_TYPE").isin(list(op_types)))
    if exclude_uid is not None:
        rows = rows.withColumn("UID", F.when(F.col("UID") != F.lit(exclude_uid), F.col("UID")))
    return rows


def like_horizon_counts(likes: DataFrame, day: str, short_days: int = SHORT_DAYS,
                        long_days: int = LONG_DAYS) -> DataFrame:
    """Likes ``(SONGID, data_dt, n)`` -> the five like columns of the features."""
    lo_short, lo_long = days_before(day, short_days), days_before(day, long_days)
    daily = between_days(likes, lo_long, day).groupBy("SONGID", PARTITION_COL).agg(F.sum("n").alias("n"))
    in_short = F.col(PARTITION_COL) >= F.lit(lo_short)
    return daily.groupBy("SONGID").agg(
        F.sum(F.when(F.col(PARTITION_COL) == F.lit(day), F.col("n"))).cast("bigint").alias("SUPP_CNT"),
        F.sum(F.when(in_short, F.col("n"))).cast("bigint").alias("RCT_7_SUPP_CNT"),
        F.max(F.when(in_short, F.col("n"))).cast("bigint").alias("RCT_7_TOP_SUPP_CNT"),
        F.sum("n").cast("bigint").alias("RCT_30_SUPP_CNT"),
        F.max("n").cast("bigint").alias("RCT_30_TOP_SUPP_CNT"),
    )


LIKE_COLS = ["SUPP_CNT", "RCT_7_SUPP_CNT", "RCT_7_TOP_SUPP_CNT", "RCT_30_SUPP_CNT", "RCT_30_TOP_SUPP_CNT"]


def song_horizon_counts(play_log: DataFrame, day: str, short_days: int = SHORT_DAYS,
                        long_days: int = LONG_DAYS) -> DataFrame:
    """Per song: plays, distinct users, distinct orders and best single day over
    the 1 / short / long-day horizons ending on ``day``, from ONE scan.

    Each play row is expanded into three keyed facts -- (song, 'd', day),
    (song, 'u', user), (song, 'o', order) -- and aggregated once; a user (or
    order) is inside a horizon iff its latest day is, so distinct counts for
    all horizons come from one ``max(day)`` per key instead of three
    ``count(distinct)`` passes.  All aggregates are algebraic, so a hot song
    is pre-aggregated map-side and its keys spread over many reducers.
    """
    lo_short, lo_long = days_before(day, short_days), days_before(day, long_days)
    rows = between_days(play_log, lo_long, day).select(
        "SONGID", "UID", "ORDER_ID", PARTITION_COL, F.col(PARTITION_COL).cast("int").alias("_day")
    )
    # the day is aggregated as an int so max() stays a (partial + final) hash aggregate
    facts = rows.select(
        "SONGID",
        F.explode(
            F.array(
                F.struct(F.lit("d").alias("kind"), F.col(PARTITION_COL).alias("key"), F.col("_day").alias("dt")),
                F.struct(F.lit("u").alias("kind"), F.col("UID").alias("key"), F.col("_day").alias("dt")),
                F.struct(F.lit("o").alias("kind"), F.col("ORDER_ID").alias("key"), F.col("_day").alias("dt")),
            )
        ).alias("f"),
    ).where(F.col("f.key").isNotNull())
    per_key = facts.groupBy("SONGID", F.col("f.kind").alias("kind"), F.col("f.key").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.max("f.dt").alias("last")
    )
    is_day, is_user, is_order = (F.col("kind") == k for k in ("d", "u", "o"))
    in_short = F.col("last") >= F.lit(int(lo_short))
    today = F.col("last") == F.lit(int(day))

    def _sum_n(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")

    def _max_n(cond):
        return F.coalesce(F.max(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")

    return per_key.groupBy("SONGID").agg(
        _sum_n(is_day & today).alias("SING_CNT"),
        F.count_if(is_user & today).alias("USR_CNT"),
        F.count_if(is_order & today).alias("ORDR_CNT"),
        _sum_n(is_day & in_short).alias("RCT_7_SING_CNT"),
        _max_n(is_day & in_short).alias("RCT_7_TOP_SING_CNT"),
        F.count_if(is_user & in_short).alias("RCT_7_USR_CNT"),
        F.count_if(is_order & in_short).alias("RCT_7_ORDR_CNT"),
        _sum_n(is_day).alias("RCT_30_SING_CNT"),
        _max_n(is_day).alias("RCT_30_TOP_SING_CNT"),
        F.count_if(is_user).alias("RCT_30_USR_CNT"),
        F.count_if(is_order).alias("RCT_30_ORDR_CNT"),
    )


def song_day_counts(play_log: DataFrame) -> DataFrame:
    """Per (day, song): plays, distinct users, distinct orders -- every day at
    once.  Distinct counts are a two-level aggregation over (day, song,
    kind, key) facts, so there is no ``count(distinct)`` Expand and a hot
    song is spread by user/order."""
    rows = play_log.select(PARTITION_COL, "SONGID", "UID", "ORDER_ID")
    facts = rows.select(
        PARTITION_COL,
        "SONGID",
        F.explode(
            F.array(
                F.struct(F.lit("u").alias("kind"), F.col("UID").alias("key")),
                F.struct(F.lit("o").alias("kind"), F.col("ORDER_ID").alias("key")),
            )
        ).alias("f"),
    )
    per_key = facts.groupBy(PARTITION_COL, "SONGID", F.col("f.kind").alias("kind"), F.col("f.key").alias("key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    is_user, is_order = F.col("kind") == "u", F.col("kind") == "o"
    has_key = F.col("key").isNotNull()
    return per_key.groupBy(PARTITION_COL, F.col("SONGID").alias("NBR")).agg(
        F.sum(F.when(is_user, F.col("n"))).alias("SING_CNT"),
        F.lit(0).cast("bigint").alias("SUPP_CNT"),
        F.count_if(is_user & has_key).alias("USR_CNT"),
        F.count_if(is_order & has_key).alias("ORDR_CNT"),
    )


# HyperLogLog precision of the approximate mode (relative error ~1.6%)
SKETCH_LG_K = 12


def song_day_sketches(play_log: DataFrame, day: str | None = None) -> DataFrame:
    """Per (day, song): plays plus mergeable HyperLogLog sketches of users and
    orders.  A daily run reads ONLY that day's log partition; the sketches
    (one small row per song and day) then serve every horizon."""
    src = play_log if day is None else on_day(play_log, day)
    return src.groupBy(PARTITION_COL, "SONGID").agg(
        F.count(F.lit(1)).cast("bigint").alias("SING_CNT"),
        F.hll_sketch_agg("UID", SKETCH_LG_K).alias("USR_SKETCH"),
        F.hll_sketch_agg("ORDER_ID", SKETCH_LG_K).alias("ORDR_SKETCH"),
    )


def song_horizon_counts_from_sketches(sketches: DataFrame, day: str, short_days: int = SHORT_DAYS,
                                      long_days: int = LONG_DAYS) -> DataFrame:
    """``song_horizon_counts`` from daily sketches: reads songs x 31 small rows
    instead of 31 days of plays; distinct counts are HLL estimates."""
    lo_short, lo_long = days_before(day, short_days), days_before(day, long_days)
    rows = between_days(sketches, lo_long, day)
    today = F.col(PARTITION_COL) == F.lit(day)
    in_short = F.col(PARTITION_COL) >= F.lit(lo_short)
    zero = F.lit(0).cast("bigint")

    def est(col: str, cond):
        union = F.hll_union_agg(F.when(cond, F.col(col)) if cond is not None else F.col(col))
        return F.coalesce(F.hll_sketch_estimate(union), zero)

    return rows.groupBy("SONGID").agg(
        F.coalesce(F.sum(F.when(today, F.col("SING_CNT"))), zero).alias("SING_CNT"),
        est("USR_SKETCH", today).alias("USR_CNT"),
        est("ORDR_SKETCH", today).alias("ORDR_CNT"),
        F.coalesce(F.sum(F.when(in_short, F.col("SING_CNT"))), zero).alias("RCT_7_SING_CNT"),
        F.coalesce(F.max(F.when(in_short, F.col("SING_CNT"))), zero).alias("RCT_7_TOP_SING_CNT"),
        est("USR_SKETCH", in_short).alias("RCT_7_USR_CNT"),
        est("ORDR_SKETCH", in_short).alias("RCT_7_ORDR_CNT"),
        F.sum("SING_CNT").alias("RCT_30_SING_CNT"),
        F.max("SING_CNT").alias("RCT_30_TOP_SING_CNT"),
        est("USR_SKETCH", None).alias("RCT_30_USR_CNT"),
        est("ORDR_SKETCH", None).alias("RCT_30_ORDR_CNT"),
    )


def song_features_from_sketches(sketches: DataFrame, catalog: DataFrame, day: str,
                                short_days: int = SHORT_DAYS, long_days: int = LONG_DAYS) -> DataFrame:
    """Approximate TW_SONG_FTUR_D (distinct users/orders estimated, plays exact)."""
    counts = song_horizon_counts_from_sketches(sketches, day, short_days, long_days).where(F.col("SING_CNT") > 0)
    return _assemble_features(counts, catalog, F.lit(day))


def _assemble_features(counts: DataFrame, catalog: DataFrame, data_dt, like: dict | None = None,
                       extra_join: DataFrame | None = None) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    joined = counts.join(catalog.select(F.col("NBR").alias("SONGID"), *CATALOG_COLS), "SONGID", "inner")
    if extra_join is not None:
        joined = joined.join(extra_join, "SONGID", "left")
    like = like or {c: zero for c in LIKE_COLS}
    return joined.select(
        F.col("SONGID").alias("NBR"),
        *CATALOG_COLS,
        "SING_CNT",
        like["SUPP_CNT"].alias("SUPP_CNT"),
        "USR_CNT",
        "ORDR_CNT",
        "RCT_7_SING_CNT",
        like["RCT_7_SUPP_CNT"].alias("RCT_7_SUPP_CNT"),
        "RCT_7_TOP_SING_CNT",
        like["RCT_7_TOP_SUPP_CNT"].alias("RCT_7_TOP_SUPP_CNT"),
        "RCT_7_USR_CNT",
        "RCT_7_ORDR_CNT",
        "RCT_30_SING_CNT",
        like["RCT_30_SUPP_CNT"].alias("RCT_30_SUPP_CNT"),
        "RCT_30_TOP_SING_CNT",
        like["RCT_30_TOP_SUPP_CNT"].alias("RCT_30_TOP_SUPP_CNT"),
        "RCT_30_USR_CNT",
        "RCT_30_ORDR_CNT",
        data_dt.alias(PARTITION_COL),
    )


def song_features(play_log: DataFrame, catalog: DataFrame, day: str,
                  short_days: int = SHORT_DAYS, long_days: int = LONG_DAYS,
                  likes: DataFrame | None = None, op_types: list[str] | None = None,
                  exclude_uid: str | None = None) -> DataFrame:
    """TW_SONG_FTUR_D for ``day``: songs played that day that are in the catalog.

    Like counts were never wired into the source system: without ``likes``
    they are typed zero columns.  Best-day counts come from the log
    (including ``day``), so the job is idempotent and order-independent.
    """
    plays = select_plays(play_log, op_types, exclude_uid)
    counts = song_horizon_counts(plays, day, short_days, long_days).where(F.col("SING_CNT") > 0)
    if likes is None:
        return _assemble_features(counts, catalog, F.lit(day))
    zero = F.lit(0).cast("bigint")
    like_counts = like_horizon_counts(likes, day, short_days, long_days)
    like = {c: F.coalesce(F.col(c), zero) for c in LIKE_COLS}
    return _assemble_features(counts, catalog, F.lit(day), like=like, extra_join=like_counts)


EPOCH_DAY = "19700101"


def _day_number(c) -> "F.Column":
    return F.datediff(F.to_date(c, "yyyyMMdd"), F.to_date(F.lit(EPOCH_DAY), "yyyyMMdd"))


def _day_text(c) -> "F.Column":
    return F.date_format(F.date_add(F.to_date(F.lit(EPOCH_DAY), "yyyyMMdd"), c), "yyyyMMdd")


def song_horizon_series(play_log: DataFrame, first_day: str, last_day: str,
                        short_days: int = SHORT_DAYS, long_days: int = LONG_DAYS) -> DataFrame:
    """The horizon counts of ``song_horizon_counts`` for EVERY day D in
    [first_day, last_day] and every song played on D, in one job.

    * plays, trailing sums and best days: a per-song daily series with
      RANGE-frame windows over day numbers (gaps handled);
    * distinct users / orders over a trailing window: each (song, key, day)
      fact covers days [day, day + h] up to the key's next active day, so it
      emits +1 on its day and -1 where that coverage ends; a running sum per
      song gives, for every day, the number of keys active in the window --
      exact, O(1) rows per fact, no per-day explosion and no sets.

    The log is read once: plays are counted per (song, day) and keys per
    (song, kind, key, day), with a map-side step, and that table is written;
    every branch reads it.  So a user, or "no user", who holds half of a hot
    song's plays is one row per day before any shuffle, and every window is
    per song or per (song, key) with at most one row per day.
    """
    lo = days_before(first_day, long_days)
    rows = between_days(play_log, lo, last_day).select(
        "SONGID", "UID", "ORDER_ID", _day_number(F.col(PARTITION_COL)).alias("dn")
    )
    def fact(kind: str, key):
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"))

    # one scan: every play is a play fact, a user fact and an order fact (the
    # last two only with a key); counting them per day is combined map-side
    facts = F.filter(
        F.array(fact("p", F.lit("")), fact("u", F.col("UID")), fact("o", F.col("ORDER_ID"))), lambda f: f["key"].isNotNull()
    )
    per_key = materialize(
        rows.select("SONGID", "dn", F.explode(facts).alias("f"))
        .groupBy("SONGID", F.col("f.kind").alias("kind"), F.col("f.key").alias("key"), "dn")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    daily = per_key.where(F.col("kind") == "p").select("SONGID", "dn", F.col("n").alias("SING_CNT"))
    by_day = Window.partitionBy("SONGID").orderBy("dn")
    w_short, w_long = by_day.rangeBetween(-short_days, 0), by_day.rangeBetween(-long_days, 0)
    plays = daily.select(
        "SONGID",
        "dn",
        F.col("SING_CNT").cast("bigint").alias("SING_CNT"),
        F.sum("SING_CNT").over(w_short).cast("bigint").alias("RCT_7_SING_CNT"),
        F.max("SING_CNT").over(w_short).cast("bigint").alias("RCT_7_TOP_SING_CNT"),
        F.sum("SING_CNT").over(w_long).cast("bigint").alias("RCT_30_SING_CNT"),
        F.max("SING_CNT").over(w_long).cast("bigint").alias("RCT_30_TOP_SING_CNT"),
    )
    nxt = F.lead("dn").over(Window.partitionBy("SONGID", "kind", "key").orderBy("dn"))
    keyed = per_key.where(F.col("kind") != "p").select("SONGID", "kind", "dn", nxt.alias("_next"))

    def _end(h: int):
        stop = F.col("dn") + F.lit(h + 1)
        return F.least(stop, F.coalesce(F.col("_next"), stop))

    def _delta(day, d0, ds, dl):
        return F.struct(day.alias("day"), F.lit(d0).alias("d0"), F.lit(ds).alias("ds"), F.lit(dl).alias("dl"))

    events = keyed.select(
        "SONGID",
        "kind",
        F.explode(
            F.array(
                _delta(F.col("dn"), 1, 1, 1),
                _delta(_end(0), -1, 0, 0),
                _delta(_end(short_days), 0, -1, 0),
                _delta(_end(long_days), 0, 0, -1),
            )
        ).alias("e"),
    )
    sums = events.groupBy("SONGID", "kind", F.col("e.day").alias("dn")).agg(
        F.sum("e.d0").alias("d0"), F.sum("e.ds").alias("ds"), F.sum("e.dl").alias("dl")
    )
    run = Window.partitionBy("SONGID", "kind").orderBy("dn").rowsBetween(Window.unboundedPreceding, 0)
    cover = sums.select(
        "SONGID", "kind", "dn",
        F.sum("d0").over(run).alias("c0"), F.sum("ds").over(run).alias("cs"), F.sum("dl").over(run).alias("cl"),
    )

    def _kind(kind: str, prefix: str):
        return cover.where(F.col("kind") == kind).select(
            "SONGID", "dn",
            F.col("c0").cast("bigint").alias(f"{prefix}_CNT"),
            F.col("cs").cast("bigint").alias(f"RCT_7_{prefix}_CNT"),
            F.col("cl").cast("bigint").alias(f"RCT_30_{prefix}_CNT"),
        )

    first_n = _day_number(F.lit(first_day))
    last_n = _day_number(F.lit(last_day))
    joined = (
        plays.where(F.col("dn").between(first_n, last_n))
        .join(_kind("u", "USR"), ["SONGID", "dn"], "left")
        .join(_kind("o", "ORDR"), ["SONGID", "dn"], "left")
    )
    zero = F.lit(0).cast("bigint")
    counts = [
        "SING_CNT", "USR_CNT", "ORDR_CNT", "RCT_7_SING_CNT", "RCT_7_TOP_SING_CNT", "RCT_7_USR_CNT",
        "RCT_7_ORDR_CNT", "RCT_30_SING_CNT", "RCT_30_TOP_SING_CNT", "RCT_30_USR_CNT", "RCT_30_ORDR_CNT",
    ]
    return joined.select(
        "SONGID",
        *[F.coalesce(F.col(c), zero).alias(c) for c in counts],
        _day_text(F.col("dn")).alias(PARTITION_COL),
    )


def song_features_range(play_log: DataFrame, catalog: DataFrame, first_day: str, last_day: str,
                        short_days: int = SHORT_DAYS, long_days: int = LONG_DAYS) -> DataFrame:
    """TW_SONG_FTUR_D for every day of [first_day, last_day] in one job (backfill)."""
    counts = song_horizon_series(play_log, first_day, last_day, short_days, long_days)
    return _assemble_features(counts, catalog, F.col(PARTITION_COL))


def tops_from_history(history: DataFrame, day: str, short_days: int = SHORT_DAYS,
                      long_days: int = LONG_DAYS) -> DataFrame:
    """The original best-day rule over earlier TW_SONG_FTUR_D partitions."""
    lo_short, lo_long = days_before(day, short_days), days_before(day, long_days)
    in_short = F.col(PARTITION_COL).between(F.lit(lo_short), F.lit(day))
    return between_days(history, lo_long, day).groupBy("NBR").agg(
        F.max(F.when(in_short, F.col("SING_CNT")).otherwise(0)).alias("RCT_7_TOP_SING_CNT"),
        F.max(F.when(in_short, F.col("SUPP_CNT")).otherwise(0)).alias("RCT_7_TOP_SUPP_CNT"),
        F.max("SING_CNT").alias("RCT_30_TOP_SING_CNT"),
        F.max("SUPP_CNT").alias("RCT_30_TOP_SUPP_CNT"),
    )


# --------------------------------------------------------------------------- J4 / J5

def with_rsi(features: DataFrame) -> DataFrame:
    return features.select(
        "*",
        rsi_one_day("SING_CNT", "SUPP_CNT").alias("RSI_1D"),
        rsi_n_days("RCT_7_SING_CNT", "RCT_7_TOP_SING_CNT", "RCT_7_SUPP_CNT", "RCT_7_TOP_SUPP_CNT", SHORT_DAYS).alias("RSI_7D"),
        rsi_n_days("RCT_30_SING_CNT", "RCT_30_TOP_SING_CNT", "RCT_30_SUPP_CNT", "RCT_30_TOP_SUPP_CNT", LONG_DAYS).alias("RSI_30D"),
    )


def _by_period(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Unpivot the three scores into (PERIOD, RSI) rows: one pass, one window."""
    stacked = F.expr(
        "stack(3, '1', RSI_1D, '7', RSI_7D, '30', RSI_30D) as (PERIOD, RSI)"
    )
    return scored.select(PARTITION_COL, *keys, stacked)


def _rank(periods: DataFrame, order: list, top_n: int | None) -> DataFrame:
    """Full ranking: range-partitioned global row number (no single-task sort
    of the catalog).  Top-n: window + rank filter, which Catalyst turns into
    a partial group limit before the shuffle."""
    groups = [PARTITION_COL, "PERIOD"]
    if top_n is None:
        return global_row_number(periods, groups, order, "RSI_RANK")
    return rank_within(periods, groups, order, "RSI_RANK").where(F.col("RSI_RANK") <= top_n)


def song_rsi(features: DataFrame, top_n: int | None = None) -> DataFrame:
    """TW_SONG_RSI_D: songs ranked per period (ties: song id); ``top_n`` keeps
    only the best ranks."""
    periods = _by_period(with_rsi(features), ["NBR", "NAME"])
    ranked = _rank(periods, [F.desc("RSI"), F.asc("NBR")], top_n)
    return ranked.select("PERIOD", "NBR", "NAME", "RSI", "RSI_RANK", PARTITION_COL)


def singer_features(features: DataFrame) -> DataFrame:
    """Song features summed per (day, first singer); the second singer gets no credit."""
    sums = [F.sum(c).alias(c) for c in SINGER_SUM_COLS]
    return features.groupBy(PARTITION_COL, "SINGER1ID", "SINGER1").agg(*sums)


def singer_rsi(features: DataFrame, top_n: int | None = None) -> DataFrame:
    """TW_SINGER_RSI_D: singers ranked per period (ties: id, then name)."""
    periods = _by_period(with_rsi(singer_features(features)), ["SINGER1ID", "SINGER1"])
    ranked = _rank(periods, [F.desc("RSI"), F.asc("SINGER1ID"), F.asc("SINGER1")], top_n)
    return ranked.select("PERIOD", "SINGER1ID", "SINGER1", "RSI", "RSI_RANK", PARTITION_COL)


def top_ranked(ranked: DataFrame, n: int = TOP_N) -> DataFrame:
    """Mart rows: rank <= n per period (Catalyst pushes a group limit below the window)."""
    return ranked.where(F.col("RSI_RANK") <= n)
