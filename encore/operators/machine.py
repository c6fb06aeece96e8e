"""Machine profile (J6): the union of both machine systems, system A's
hardware and cleaned location, system B's contract, scene and store data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import business_mode, time14
from ..functions.text import city_from_address, fill_from_address, province_from_address
from ..sources.schemas import PARTITION_COL
from .small import BROADCAST_MAX_ROWS, all_at_most, dedupe_by_key, lookup_join

SYSTEM_A_PRODUCT_TYPE = 2

PROFILE_COLS = [
    "MID", "MAC_NM", "SONG_WHSE_VER", "EXEC_VER", "UI_VER", "HARD_ID", "SALE_TM", "REV_TM",
    "OPER_NM", "PRVC", "CTY", "AREA", "ADDR", "STORE_NM", "SCENCE_CATGY", "SUB_SCENCE_CATGY",
    "SCENE", "SUB_SCENE", "BRND", "SUB_BRND", "PRDCT_NM", "PRDCT_TYP", "BUS_MODE", "INV_RATE",
    "AGE_RATE", "COM_RATE", "PAR_RATE", "IS_ACTV", "ACTV_TM", "PAY_SW", "PRTN_NM", "CUR_LOGIN_TM",
]


def machine_ids(mac_a: DataFrame, admin_b: DataFrame) -> DataFrame:
    """Every machine known to either system, once (distinct on the id only)."""
    return mac_a.select("MID").union(admin_b.select("MID")).distinct()


def clean_locations(loc_a: DataFrame) -> DataFrame:
    """Fill missing province/city from the address; drop rows still blank;
    normalise the two 14-digit times."""
    filled = loc_a.select(
        "MID",
        fill_from_address("PRVC", "ADDR", province_from_address).alias("PRVC"),
        fill_from_address("CTY", "ADDR", city_from_address).alias("CTY"),
        "ADDR_FMT",
        time14("REV_TM").alias("REV_TM"),
        time14("SALE_TM").alias("SALE_TM"),
    )
    return filled.where((F.col("PRVC") != "") & (F.col("CTY") != ""))


def machine_profile(
    mac_a: DataFrame,
    loc_a: DataFrame,
    admin_b: DataFrame,
    provinces: DataFrame,
    cities: DataFrame,
    areas: DataFrame,
    store_map: DataFrame,
    stores: DataFrame,
    day: str,
) -> DataFrame:
    """TW_MAC_BASEINFO_D for ``day``: one row per machine (32 columns + data_dt).

    All per-machine inputs are de-duplicated on MID and joined on MID, so
    Spark shuffles each once and chains the joins on one partitioning; the
    province/city/area/store lookups are size-checked broadcasts.
    """
    ids = machine_ids(mac_a, admin_b)
    a = dedupe_by_key(mac_a, "MID")
    loc = dedupe_by_key(clean_locations(loc_a), "MID")
    b = dedupe_by_key(
        admin_b.withColumn("ACTV_TM", time14("ACTV_TM")).withColumn("ORDER_TM", time14("ORDER_TM")), "MID"
    )
    smap = dedupe_by_key(store_map, "MID")
    joined = (
        ids.join(a, "MID", "left")
        .join(loc, "MID", "left")
        .join(b.withColumnRenamed("PRDCT_TYPE", "B_PRDCT_TYPE"), "MID", "left")
        .join(smap, "MID", "left")
    )
    store_cols = stores.select(
        "ID",
        F.col("GROUND_NM").alias("STORE_NM"),
        "TAG_NM", "SUB_TAG_NM", "SUB_SCENE_CATGY_NM", "SUB_SCENE_NM", "BRND_NM", "SUB_BRND_NM",
    )
    lookups = [
        (provinces.withColumnRenamed("PRVC", "B_PRVC"), "SCENE_PRVC_ID", "PRVC_ID"),
        (cities.withColumnRenamed("CTY", "B_CTY"), "SCENE_CTY_ID", "CTY_ID"),
        (areas, "SCENE_AREA_ID", "AREA_ID"),
        (store_cols, "STORE_ID", "ID"),
    ]
    small = all_at_most([lk for lk, _, _ in lookups], BROADCAST_MAX_ROWS)
    for (lookup, fact_key, lookup_key), is_small in zip(lookups, small):
        joined = lookup_join(joined, lookup, fact_key, lookup_key, small=is_small)
    return joined.select(
        "MID",
        "MAC_NM",
        "SONG_WHSE_VER",
        "EXEC_VER",
        "UI_VER",
        "HARD_ID",
        "SALE_TM",
        "REV_TM",
        F.col("STORE_NM").alias("OPER_NM"),
        F.coalesce("PRVC", "B_PRVC").alias("PRVC"),
        F.coalesce("CTY", "B_CTY").alias("CTY"),
        "AREA",
        F.coalesce("ADDR_FMT", F.concat("SCENE_ADDR", "GROUND_NM")).alias("ADDR"),
        "STORE_NM",
        F.col("TAG_NM").alias("SCENCE_CATGY"),
        F.col("SUB_SCENE_CATGY_NM").alias("SUB_SCENCE_CATGY"),
        F.col("SUB_TAG_NM").alias("SCENE"),
        F.col("SUB_SCENE_NM").alias("SUB_SCENE"),
        F.col("BRND_NM").alias("BRND"),
        F.col("SUB_BRND_NM").alias("SUB_BRND"),
        F.col("PKG_NM").alias("PRDCT_NM"),
        F.lit(SYSTEM_A_PRODUCT_TYPE).alias("PRDCT_TYP"),
        business_mode("PKG_NM", "INV_RATE").alias("BUS_MODE"),
        "INV_RATE",
        "AGE_RATE",
        "COM_RATE",
        "PAR_RATE",
        F.coalesce("STS", "IS_ACTV").alias("IS_ACTV"),
        "ACTV_TM",
        F.coalesce("PAY_SW", "HAD_MPAY_FUNC").alias("PAY_SW"),
        F.col("STORE_NM").alias("PRTN_NM"),
        "CUR_LOGIN_TM",
        F.lit(day).alias(PARTITION_COL),
    )
