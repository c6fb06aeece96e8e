"""Explicit schemas of the raw (ODS) tables and of the partition column.

Readers always pass a schema: a ``data_dt=20240130/`` directory read without
one is inferred as an integer partition, which breaks string comparisons.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

PARTITION_COL = "data_dt"


def _struct(*fields, partitioned: bool = False) -> T.StructType:
    cols = [T.StructField(name, typ) for name, typ in fields]
    if partitioned:
        cols.append(T.StructField(PARTITION_COL, S))
    return T.StructType(cols)


PLAY_LOG = _struct(
    ("SONGID", S), ("MID", S), ("OPTRATE_TYPE", S), ("UID", S), ("CONSUME_TYPE", S),
    ("DUR_TIME", S), ("SESSION_ID", S), ("SONGNAME", S), ("PKG_ID", S), ("ORDER_ID", S),
    partitioned=True,
)

_SONG_INT_COLS = [
    "BPM_VAL", "STAR_LEVEL", "VIDEO_QLTY", "VIDEO_MK", "VIDEO_FTUR", "LYRIC_FTUR", "IMG_QLTY",
    "SUBTITLES_TYPE", "AUDIO_FMT", "ORI_SOUND_QLTY", "ORI_TRK", "ORI_TRK_VOL", "ACC_VER",
    "ACC_QLTY", "ACC_TRK_VOL", "ACC_TRK", "WIDTH", "HEIGHT", "VIDEO_RSVL", "SONG_VER",
]
SONG_INT_COLS = list(_SONG_INT_COLS)

SONG_INFO = _struct(
    ("NBR", S), ("NAME", S), ("OTHER_NAME", S), ("SOURCE", I), ("ALBUM", S), ("PRDCT", S),
    ("LANG", S), ("VIDEO_FORMAT", S), ("DUR", I), ("SINGER_INFO", S), ("POST_TIME", S),
    ("PINYIN_FST", S), ("PINYIN", S), ("SING_TYPE", I), ("ORI_SINGER", S), ("LYRICIST", S),
    ("COMPOSER", S), *[(c, I) for c in _SONG_INT_COLS], ("AUTH_CO", S), ("STATE", I),
    ("PRDCT_TYPE", S),
)

MAC_A = _struct(
    ("MID", S), ("SRL_ID", S), ("HARD_ID", S), ("SONG_WHSE_VER", S), ("EXEC_VER", S),
    ("UI_VER", S), ("STS", S), ("CUR_LOGIN_TM", S), ("PAY_SW", S), ("IS_ONLINE", S),
)
MAC_LOC_A = _struct(
    ("MID", S), ("PRVC", S), ("CTY", S), ("ADDR", S), ("ADDR_FMT", S), ("REV_TM", S), ("SALE_TM", S),
)
MAC_ADMIN_B = _struct(
    ("MID", S), ("PRDCT_TYPE", I), ("MAC_NM", S), ("PKG_NM", S), ("INV_RATE", D), ("AGE_RATE", D),
    ("COM_RATE", D), ("PAR_RATE", D), ("IS_ACTV", S), ("ACTV_TM", S), ("ORDER_TM", S),
    ("HAD_MPAY_FUNC", S), ("SCENE_PRVC_ID", S), ("SCENE_CTY_ID", S), ("SCENE_AREA_ID", S),
    ("SCENE_ADDR", S), ("GROUND_NM", S),
)
PROVINCES = _struct(("PRVC_ID", S), ("PRVC", S))
CITIES = _struct(("CTY_ID", S), ("CTY", S))
AREAS = _struct(("AREA_ID", S), ("AREA", S))
STORE_MAP = _struct(("MID", S), ("STORE_ID", S))
STORES = _struct(
    ("ID", S), ("GROUND_NM", S), ("TAG_NM", S), ("SUB_TAG_NM", S), ("SUB_SCENE_CATGY_NM", S),
    ("SUB_SCENE_NM", S), ("BRND_NM", S), ("SUB_BRND_NM", S),
)
USER_LOCATIONS = _struct(("UID", S), ("MID", S), ("LAT", S), ("LNG", S), partitioned=True)
LOGINS = _struct(("UID", S), partitioned=True)
CONSUMPTION = _struct(
    ("ID", S), ("TRD_ID", S), ("UID", L), ("MID", S), ("PRDCD_TYPE", S), ("PAY_TYPE", S),
    ("ACT_TM", S), ("PKG_ID", S), ("AMT", L), ("ORDR_ID", S), ("ACTV_NM", S), ("PKG_PRC", L),
    ("PKG_DSCNT", L), ("CPN_TYPE", S), ("ORDR_TYPE", I), partitioned=True,
)

_USER_COMMON = [
    ("UID", S), ("REG_MID", S), ("GDR", S), ("BIRTHDAY", S), ("MSISDN", S), ("LOC_ID", S),
    ("LOG_MDE", S), ("REG_TM", S), ("USR_EXP", I), ("SCORE", I), ("LEVEL", I),
]
USERS_WECHAT = _struct(*_USER_COMMON, ("WX_ID", S))
USERS_ALIPAY = _struct(*_USER_COMMON, ("ALY_ID", S), ("USR_TYPE", S), ("IS_CERT", S), ("IS_STDNT", S))
USERS_QQ = _struct(*_USER_COMMON, ("QQID", S))
USERS_APP = _struct(*_USER_COMMON, ("APP_ID", S))

GAZETTEER_PLACE_COLS = [
    "ADDR", "PRVC", "CTY", "CTY_CD", "DISTRICT", "AD_CD", "TOWN_SHIP", "TOWN_CD", "NB_NM", "NB_TP",
    "BD_NM", "BD_TP", "STREET", "STREET_NB", "STREET_LOC", "STREET_DRCTION", "STREET_DSTANCE", "BUS_INFO",
]
GAZETTEER = _struct(("place_id", L), ("lat", D), ("lng", D), *[(c, S) for c in GAZETTEER_PLACE_COLS])

STREAM_RECORD = _struct(("ts", T.TimestampType()), ("value", S))
