"""Revenue jobs: machine daily revenue (J10), region revenue (J11),
merchant revenue share (J12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import PARTITION_COL
from ..sources.tables import on_day

GROUP_KEYS = ["MID", "PKG_ID", "PAY_TYPE"]
NORMAL, REFUND = 0, 2
MONEY = "decimal(18,4)"

STAT_COLS = [
    "MID", "MAC_NM", "PRDCT_TYP", "STORE_NM", "BUS_MODE", "PAY_SW", "SCENCE_CATGY",
    "SUB_SCENCE_CATGY", "SCENE", "SUB_SCENE", "BRND", "SUB_BRND", "PRVC", "CTY", "AREA",
    "AGE_ID", "INV_RATE", "AGE_RATE", "COM_RATE", "PAR_RATE", "PKG_ID", "PAY_TYPE",
    "CNSM_USR_CNT", "REF_USR_CNT", "NEW_USR_CNT", "REV_ORDR_CNT", "REF_ORDR_CNT", "TOT_REV", "TOT_REF",
]


def _amount() -> Column:
    return F.col("COIN_CNT") * F.col("COIN_PRC")


def revenue_and_refunds(brief: DataFrame) -> DataFrame:
    """Per (machine, package, pay type): users, orders and amounts of normal
    orders and of refunds, in one two-step aggregation.

    Step 1 groups by (keys, type, user) -- so a machine with a huge share of
    the orders is spread over reducers by user -- and step 2 folds users into
    counts; both steps combine map-side.
    """
    per_user = (
        brief.where(F.col("ABN_TYP").isin(NORMAL, REFUND))
        .groupBy(*GROUP_KEYS, "ABN_TYP", "UID")
        .agg(F.sum(_amount()).alias("amt"), F.count("ORDR_ID").alias("n"))
    )
    is_rev, is_ref = F.col("ABN_TYP") == NORMAL, F.col("ABN_TYP") == REFUND
    has_user = F.col("UID").isNotNull()
    return per_user.groupBy(*GROUP_KEYS).agg(
        F.count_if(is_rev & has_user).alias("CNSM_USR_CNT"),
        F.sum(F.when(is_rev, F.col("amt"))).alias("TOT_REV"),
        F.sum(F.when(is_rev, F.col("n"))).alias("REV_ORDR_CNT"),
        F.count_if(is_ref & has_user).alias("REF_USR_CNT"),
        F.sum(F.when(is_ref, F.col("amt"))).alias("TOT_REF"),
        F.sum(F.when(is_ref, F.col("n"))).alias("REF_ORDR_CNT"),
        F.max(is_rev).alias("_has_rev"),
        F.max(is_ref).alias("_has_ref"),
    )


def revenue_by_machine(brief: DataFrame) -> DataFrame:
    """Normal orders per (day, machine, package, pay type) for every day at once."""
    amount = _amount()
    keyed = brief.where(F.col("ABN_TYP") == NORMAL)
    return keyed.groupBy(PARTITION_COL, *GROUP_KEYS).agg(
        F.count_distinct("UID").alias("CNSM_USR_CNT"),
        F.sum(amount).alias("TOT_REV"),
        F.count("ORDR_ID").alias("REV_ORDR_CNT"),
    )


def refund_by_machine(brief: DataFrame) -> DataFrame:
    """Refunds per (day, machine, package, pay type) for every day at once."""
    keyed = brief.where(F.col("ABN_TYP") == REFUND)
    return keyed.groupBy(PARTITION_COL, *GROUP_KEYS).agg(
        F.count_distinct("UID").alias("REF_USR_CNT"),
        F.sum(_amount()).alias("TOT_REF"),
        F.count("ORDR_ID").alias("REF_ORDR_CNT"),
    )


def new_users(profiles_day: DataFrame, day: str) -> DataFrame:
    """Users registered on ``day`` among the day's active profiles, per machine."""
    return (
        profiles_day.where(F.col("REG_DT") == F.lit(day))
        .groupBy(F.col("REG_MID").alias("MID"))
        .agg(F.count("UID").alias("NEW_USR_CNT"))
    )


def new_users_all_days(profiles: DataFrame) -> DataFrame:
    """``new_users`` for every day at once: users whose registration day is
    the day they are active, per (day, machine)."""
    return (
        profiles.where(F.col("REG_DT") == F.col(PARTITION_COL))
        .groupBy(PARTITION_COL, F.col("REG_MID").alias("MID"))
        .agg(F.count("UID").alias("NEW_USR_CNT"))
    )


def machine_stat(profile: DataFrame, locations: DataFrame, brief: DataFrame, profiles: DataFrame,
                 day: str, include_refund_only: bool = False) -> DataFrame:
    """TW_MAC_STAT_D for ``day`` (29 columns + data_dt).

    Grain: one row per machine and (package, pay type) with revenue, or one
    row with NULL package/pay type for a machine without revenue.  By default
    refunds count only where the same machine/package/pay type had revenue
    and never for a NULL package or pay type (the original plain-equality
    join); ``include_refund_only`` keeps refund-only groups too, matching NULL
    keys null-safely.  ``NEW_USR_CNT`` repeats on every row of a machine: do
    not sum it across packages.
    """
    groups = revenue_and_refunds(on_day(brief, day))
    null_key = F.col("PKG_ID").isNull() | F.col("PAY_TYPE").isNull() | F.col("MID").isNull()
    if include_refund_only:
        groups = groups.where(F.col("_has_rev") | F.col("_has_ref"))
    else:
        groups = groups.where(F.col("_has_rev"))
        for c in ("REF_USR_CNT", "TOT_REF", "REF_ORDR_CNT"):
            groups = groups.withColumn(c, F.when(~null_key & F.col("_has_ref"), F.col(c)))
    base = on_day(profile, day).drop(PARTITION_COL)
    loc = on_day(locations, day).select(
        "MID", F.col("PRVC").alias("L_PRVC"), F.col("CTY").alias("L_CTY"), F.col("DISTRICT").alias("L_DISTRICT")
    )
    fresh = new_users(on_day(profiles, day), day)
    joined = base.join(loc, "MID", "left").join(groups, "MID", "left").join(fresh, "MID", "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "MID", "MAC_NM", "PRDCT_TYP", "STORE_NM", "BUS_MODE", "PAY_SW", "SCENCE_CATGY",
        "SUB_SCENCE_CATGY", "SCENE", "SUB_SCENE", "BRND", "SUB_BRND",
        F.coalesce("L_PRVC", "PRVC").alias("PRVC"),
        F.coalesce("L_CTY", "CTY").alias("CTY"),
        F.coalesce("L_DISTRICT", "AREA").alias("AREA"),
        F.col("PRTN_NM").alias("AGE_ID"),
        "INV_RATE", "AGE_RATE", "COM_RATE", "PAR_RATE",
        "PKG_ID", "PAY_TYPE",
        F.coalesce(F.col("CNSM_USR_CNT"), zero).alias("CNSM_USR_CNT"),
        F.coalesce(F.col("REF_USR_CNT"), zero).alias("REF_USR_CNT"),
        F.coalesce(F.col("NEW_USR_CNT"), zero).alias("NEW_USR_CNT"),
        F.coalesce(F.col("REV_ORDR_CNT"), zero).alias("REV_ORDR_CNT"),
        F.coalesce(F.col("REF_ORDR_CNT"), zero).alias("REF_ORDR_CNT"),
        F.coalesce(F.col("TOT_REV"), zero).alias("TOT_REV"),
        F.coalesce(F.col("TOT_REF"), zero).alias("TOT_REF"),
        F.lit(day).alias(PARTITION_COL),
    )


def region_stat(stat: DataFrame, day: str) -> DataFrame:
    """TM_MAC_REGION_STAT_D: revenue per (province, city).

    ``MAC_CNT`` counts stat rows (machines fanned out by package) as the
    original did; ``MAC_DISTINCT_CNT`` counts machines."""
    return on_day(stat, day).groupBy("PRVC", "CTY").agg(
        F.count("MID").alias("MAC_CNT"),
        F.count_distinct("MID").alias("MAC_DISTINCT_CNT"),
        F.sum("TOT_REV").cast(MONEY).alias("MAC_REV"),
        F.sum("TOT_REF").cast(MONEY).alias("MAC_REF"),
        F.sum("REV_ORDR_CNT").alias("MAC_REV_ORDR_CNT"),
        F.sum("REF_ORDR_CNT").alias("MAC_REF_ORDR_CNT"),
        F.sum("CNSM_USR_CNT").alias("MAC_CNSM_USR_CNT"),
        F.sum("REF_USR_CNT").alias("MAC_REF_USR_CNT"),
    ).withColumn(PARTITION_COL, F.lit(day))


def merchant_share(stat: DataFrame, day: str, rate_scale: float = 1.0) -> DataFrame:
    """TM_USR_MRCHNT_STAT_D: revenue split per (agent, pay type).

    Rates are multiplied as stored (``rate_scale=1``); pass 100 to treat them
    as percentages."""
    rev = F.col("TOT_REV").cast("decimal(18,0)")

    def share(rate: str) -> Column:
        # decimals add up to the same digits in any order of the rows
        part = rev * F.coalesce(F.col(rate), F.lit(0.0)).cast("decimal(12,6)")
        return (F.sum(part) / F.lit(rate_scale).cast("decimal(12,6)")).cast(MONEY)

    return on_day(stat, day).groupBy(F.col("AGE_ID").alias("ADMIN_ID"), "PAY_TYPE").agg(
        F.sum("REV_ORDR_CNT").alias("REV_ORDR_CNT"),
        F.sum("REF_ORDR_CNT").alias("REF_ORDR_CNT"),
        F.sum("TOT_REV").cast("double").alias("TOT_REV"),
        F.sum("TOT_REF").cast("double").alias("TOT_REF"),
        share("INV_RATE").alias("TOT_INV_REV"),
        share("AGE_RATE").alias("TOT_AGE_REV"),
        share("COM_RATE").alias("TOT_COM_REV"),
        share("PAR_RATE").alias("TOT_PAR_REV"),
    ).withColumn(PARTITION_COL, F.lit(day))
