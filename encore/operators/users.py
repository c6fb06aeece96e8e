"""User jobs: consumption brief (J8), active-user profiles and the N-day
active list (J9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import abnormal_type, channel_label, clock_part, date_part, gender_label, typed_null
from ..functions import codes
from ..functions.dates import days_before
from ..sources.schemas import PARTITION_COL
from ..sources.tables import between_days, on_day

PROFILE_COLS = [
    "UID", "REG_MID", "REG_CHNL", "REF_UID", "GDR", "BIRTHDAY", "MSISDN", "LOC_ID", "LOG_MDE",
    "REG_DT", "REG_TM", "USR_EXP", "SCORE", "LEVEL", "USR_TYPE", "IS_CERT", "IS_STDNT",
]
ACTIVE_DAYS = 7
WINDOW_DAYS = 7


# --------------------------------------------------------------------------- J8

def consumption_brief(orders: DataFrame, day: str | None = None) -> DataFrame:
    """TO_YCAK_CNSM_D -> TW_CNSM_BRIEF_D (17 columns + data_dt).

    Amounts are cents; the coin price is the absolute amount, one coin per
    order; order types map to 0 normal / 1 abnormal / 2 refund.  With ``day``
    only that partition is read; without, every day is processed at once.
    """
    src = orders if day is None else on_day(orders, day)
    return src.select(
        "ID",
        "TRD_ID",
        F.col("UID").cast("string").alias("UID"),
        "MID",
        "PRDCD_TYPE",
        "PAY_TYPE",
        "ACT_TM",
        "PKG_ID",
        F.abs("AMT").alias("COIN_PRC"),
        F.lit(1).alias("COIN_CNT"),
        F.col("ACT_TM").alias("UPDATE_TM"),
        "ORDR_ID",
        "ACTV_NM",
        "PKG_PRC",
        "PKG_DSCNT",
        "CPN_TYPE",
        abnormal_type("ORDR_TYPE").alias("ABN_TYP"),
        PARTITION_COL,
    )


# --------------------------------------------------------------------------- J9

def _channel(df: DataFrame, code: str, ref_col: str, user_type=None, cert=None, student=None,
             log_mode=None, score=None) -> DataFrame:
    return df.select(
        "UID",
        "REG_MID",
        F.lit(code).alias("REG_CHNL"),
        F.col(ref_col).alias("REF_UID"),
        "GDR",
        "BIRTHDAY",
        "MSISDN",
        "LOC_ID",
        (log_mode if log_mode is not None else F.col("LOG_MDE")).alias("LOG_MDE"),
        date_part("REG_TM").alias("REG_DT"),
        clock_part("REG_TM").alias("REG_TM"),
        "USR_EXP",
        (score if score is not None else F.col("SCORE")).alias("SCORE"),
        "LEVEL",
        (user_type if user_type is not None else F.lit(codes.USER_TYPE_PERSON)).alias("USR_TYPE"),
        (cert if cert is not None else typed_null("string")).alias("IS_CERT"),
        (student if student is not None else typed_null("string")).alias("IS_STDNT"),
    )


def all_users(wechat: DataFrame, alipay: DataFrame, qq: DataFrame, app: DataFrame) -> DataFrame:
    """The four registration channels as one user table (by-name union, typed NULLs)."""
    return (
        _channel(wechat, codes.CHANNEL_WECHAT, "WX_ID")
        .unionByName(
            _channel(
                alipay, codes.CHANNEL_ALIPAY, "ALY_ID",
                user_type=F.coalesce(F.col("USR_TYPE"), F.lit(codes.USER_TYPE_PERSON)),
                cert=F.col("IS_CERT"), student=F.col("IS_STDNT"),
            )
        )
        .unionByName(_channel(qq, codes.CHANNEL_QQ, "QQID"))
        .unionByName(
            _channel(app, codes.CHANNEL_APP, "APP_ID", log_mode=typed_null("string"), score=F.lit(0).cast("int"))
        )
    )


def active_profiles(logins: DataFrame, users: DataFrame, day: str | None = None) -> DataFrame:
    """TW_USR_BASEINFO_D: distinct users who logged in on a day, with their profile.

    Without ``day`` every day's partition is produced in one pass (the
    distinct is on (user, day), so a user active on many days spreads).
    """
    src = logins if day is None else on_day(logins, day)
    active = src.select("UID", PARTITION_COL).distinct()
    joined = active.join(users, "UID", "left")
    return joined.select(*PROFILE_COLS, PARTITION_COL)


def active_list(profiles: DataFrame, day: str, active_days: int = ACTIVE_DAYS,
                window_days: int = WINDOW_DAYS) -> DataFrame:
    """Users active on exactly ``active_days`` distinct days of D-window..D and
    present on D, with labelled channel and gender (8 columns)."""
    window = between_days(profiles, days_before(day, window_days), day).select("UID", PARTITION_COL)
    counted = (
        window.groupBy("UID")
        .agg(F.count_distinct(PARTITION_COL).alias("c"))
        .where(F.col("c") == active_days)
        .select("UID")
    )
    today = on_day(profiles, day)
    joined = counted.join(today, "UID", "inner")
    return joined.select(
        "UID",
        channel_label("REG_CHNL").alias("REG_CHNL"),
        "REF_UID",
        gender_label("GDR").alias("GDR"),
        "BIRTHDAY",
        "MSISDN",
        "REG_DT",
        "LEVEL",
    )


def active_list_range(profiles: DataFrame, first_day: str, last_day: str, active_days: int = ACTIVE_DAYS,
                      window_days: int = WINDOW_DAYS) -> DataFrame:
    """``active_list`` for every day of [first_day, last_day] in one job.

    Distinct active days per user, then a RANGE-frame count over each user's
    day numbers: one window per user (at most one row per day), no self-join.
    """
    lo = days_before(first_day, window_days)
    day_n = F.datediff(F.to_date(F.col(PARTITION_COL), "yyyyMMdd"), F.lit("1970-01-01").cast("date"))
    days = (
        between_days(profiles, lo, last_day).select("UID", PARTITION_COL).distinct()
        .withColumn("_dn", day_n)
    )
    w = Window.partitionBy("UID").orderBy("_dn").rangeBetween(-window_days, 0)
    qualified = (
        days.withColumn("c", F.count(F.lit(1)).over(w))
        .where((F.col("c") == active_days) & F.col(PARTITION_COL).between(F.lit(first_day), F.lit(last_day)))
        .select("UID", PARTITION_COL)
    )
    joined = qualified.join(between_days(profiles, first_day, last_day), ["UID", PARTITION_COL], "inner")
    return joined.select(
        "UID",
        channel_label("REG_CHNL").alias("REG_CHNL"),
        "REF_UID",
        gender_label("GDR").alias("GDR"),
        "BIRTHDAY",
        "MSISDN",
        "REG_DT",
        "LEVEL",
        PARTITION_COL,
    )
