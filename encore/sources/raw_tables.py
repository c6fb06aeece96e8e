"""The raw (ODS) tables as written by the ingest and the imports.

A raw layer is a folder with one table per name below, Parquet or tab-joined
text, tables by day in ``data_dt=`` folders.  Reading declares the schema and
turns the texts that stand for a missing value into NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import schemas
from .schemas import PARTITION_COL
from .tables import _exists, normalize_nulls, read_delimited, read_table

#: field of ``RawTables`` -> (table, schema)
RAW_LAYER = {
    "play_log": ("TO_CLIENT_SONG_PLAY_OPERATE_REQ_D", schemas.PLAY_LOG),
    "song_info": ("TO_SONG_INFO_D", schemas.SONG_INFO),
    "mac_a": ("TO_YCAK_MAC_D", schemas.MAC_A),
    "mac_loc_a": ("TO_YCAK_MAC_LOC_D", schemas.MAC_LOC_A),
    "mac_b": ("TO_YCBK_MAC_ADMIN_MAP_D", schemas.MAC_ADMIN_B),
    "provinces": ("TO_YCBK_PRVC_D", schemas.PROVINCES),
    "cities": ("TO_YCBK_CITY_D", schemas.CITIES),
    "areas": ("TO_YCBK_AREA_D", schemas.AREAS),
    "store_map": ("TO_YCBK_MAC_STORE_MAP_D", schemas.STORE_MAP),
    "stores": ("TO_YCBK_STORE_D", schemas.STORES),
    "user_locations": ("TO_YCAK_USR_LOC_D", schemas.USER_LOCATIONS),
    "gazetteer": ("TO_GAZETTEER", schemas.GAZETTEER),
    "consumption": ("TO_YCAK_CNSM_D", schemas.CONSUMPTION),
    "users_wechat": ("TO_YCAK_USR_WX_D", schemas.USERS_WECHAT),
    "users_alipay": ("TO_YCAK_USR_ALI_D", schemas.USERS_ALIPAY),
    "users_qq": ("TO_YCAK_USR_QQ_D", schemas.USERS_QQ),
    "users_app": ("TO_YCAK_USR_D", schemas.USERS_APP),
    "logins": ("TO_YCAK_USR_LOGIN_D", schemas.LOGINS),
}


def read_raw(spark: SparkSession, root: str, field: str, fmt: str = "parquet") -> DataFrame:
    """One raw table; a table that was never written is empty."""
    name, schema = RAW_LAYER[field]
    path = f"{root}/{name}"
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    if fmt == "text":
        return read_delimited(spark, path, schema, partitioned=PARTITION_COL in schema.fieldNames())
    return normalize_nulls(read_table(spark, path, schema))


def write_raw(df: DataFrame, root: str, field: str, fmt: str = "parquet") -> None:
    """Writes a raw table as the imports leave it (full refresh)."""
    name, schema = RAW_LAYER[field]
    writer = df.select(*schema.fieldNames()).write.mode("overwrite")
    if PARTITION_COL in schema.fieldNames():
        writer = writer.partitionBy(PARTITION_COL)
    if fmt == "text":
        writer.option("sep", "\t").option("nullValue", "null").csv(f"{root}/{name}")
    else:
        writer.parquet(f"{root}/{name}")
