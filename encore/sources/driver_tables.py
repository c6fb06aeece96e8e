"""Raw (ODS) tables of the venue business, derived from the driver's tables.

The test environment provides TPC-H-like tables plus an ``events`` stream,
no karaoke data.  Each function below turns one driver table into one raw
table of the domain with row-level rules -- projections, a segment rule that
deals all customers over the channels, and joins to the two fixed geography
tables -- so every job downstream reads the whole driver data and its work
grows with it: machines with the suppliers, places with the customers.  The
expected results of the same derivations are written independently in SQL
for the DuckDB oracles.

Role mapping:

=====================  ==========================================
play log               ``events`` (song = ``props.k``)
raw client log lines   ``events`` rendered as ``&``-separated text
song catalog           ``part``
machine systems A, B   ``supplier``; province/city/area/store lookups from ``region``/``nation``
consumption orders     ``orders`` (days mapped onto the January 2024 business month)
user channels          ``customer`` split by market segment
logins, user GPS       ``events``
gazetteer              ``customer`` with ``nation`` and ``region``
=====================  ==========================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_of
from .schemas import PARTITION_COL, SONG_INT_COLS
from .tables import ensure_parallelism

#: Machines where a caller does not count the suppliers.
MACHINES = 100
SONG_NAME_PREFIX = "song-"

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, spread over the cores when its file is one row group."""
    path = f"{sf_dir}/{name}.parquet"
    return ensure_parallelism(spark.read.parquet(path), path)


def machine_count(spark: SparkSession, sf_dir: str) -> int:
    """Machines of the business: one per supplier (a count of the file's footer)."""
    return max(1, spark.read.parquet(f"{sf_dir}/supplier.parquet").count())


def _s(c: Column) -> Column:
    return c.cast("string")


def _case(key: Column, values: list, default=None) -> Column:
    """``CASE key WHEN 0 THEN values[0] WHEN 1 THEN values[1] ... END``."""
    expr = None
    for i, v in enumerate(values):
        val = v if isinstance(v, Column) else F.lit(v)
        expr = F.when(key == i, val) if expr is None else expr.when(key == i, val)
    if default is not None:
        expr = expr.otherwise(default if isinstance(default, Column) else F.lit(default))
    return expr


# --------------------------------------------------------------------------- play log

def play_log(events: DataFrame, machines: int = MACHINES) -> DataFrame:
    """TO_CLIENT_SONG_PLAY_OPERATE_REQ_D: one play operation per event."""
    song = F.get_json_object("props", "$.k")
    uid = _s(F.col("user_id"))
    day = day_of("ts")
    return events.select(
        song.alias("SONGID"),
        _s(F.col("user_id") % machines).alias("MID"),
        F.col("event_type").alias("OPTRATE_TYPE"),
        uid.alias("UID"),
        F.when(F.col("event_type") == "purchase", F.lit("1")).otherwise(F.lit("0")).alias("CONSUME_TYPE"),
        _s(F.floor("value")).alias("DUR_TIME"),
        F.concat(uid, F.lit("-"), day).alias("SESSION_ID"),
        F.concat(F.lit(SONG_NAME_PREFIX), song).alias("SONGNAME"),
        _s(F.col("user_id") % 5).alias("PKG_ID"),
        _s(F.col("event_id")).alias("ORDER_ID"),
        day.alias(PARTITION_COL),
    )


# fixed values of the stand-in log: request types, versions
LOGIN_REQUEST = "MINIK_CLIENT_ADVERTISEMENT_RECORD_REQ"


def client_log_lines(events: DataFrame, machines: int = MACHINES) -> DataFrame:
    """Raw ``&``-separated log lines (``value``), one per event.

    ``signup`` events become a non-play request; ``error`` events are
    malformed: even ids carry an empty last field (five parts once trailing
    empties are dropped), odd ids an extra ``&`` inside the payload.
    """
    from .client_log import PLAY_REQUEST

    song = F.get_json_object("props", "$.k").cast("int")
    payload = F.to_json(
        F.struct(
            song.alias("songid"),
            (F.col("user_id") % machines).alias("mid"),
            F.col("event_type").alias("optrate_type"),
            F.col("user_id").alias("uid"),
            F.when(F.col("event_type") == "purchase", F.lit("1")).otherwise(F.lit("0")).alias("consume_type"),
            F.floor("value").alias("dur_time"),
            F.concat(_s(F.col("user_id")), F.lit("-"), day_of("ts")).alias("session_id"),
            F.concat(F.lit(SONG_NAME_PREFIX), _s(song)).alias("songname"),
            (F.col("user_id") % 5).alias("pkg_id"),
            F.col("event_id").alias("order_id"),
        )
    )
    is_error = F.col("event_type") == "error"
    req = F.when(F.col("event_type") == "signup", F.lit(LOGIN_REQUEST)).otherwise(F.lit(PLAY_REQUEST))
    body = F.when(is_error & (F.col("event_id") % 2 == 1), F.concat(payload, F.lit("&x"))).otherwise(payload)
    ui = F.when(is_error & (F.col("event_id") % 2 == 0), F.lit("")).otherwise(F.lit("ui3"))
    line = F.concat_ws(
        "&",
        F.date_format("ts", "yyyyMMddHHmmss"),
        _s(F.col("user_id") % machines),
        req,
        body,
        F.lit("v2.1"),
        ui,
    )
    return events.select(line.alias("value"))


#: First instant of the stream, and how much faster than the events it runs:
#: the events' month becomes twelve minutes, so a window holds many records.
STREAM_START = "2024-01-01 00:00:00"
STREAM_SPEED = 3600


def play_records(events: DataFrame, machines: int = MACHINES) -> DataFrame:
    """Stream records (both topics): event time (UTC ``TIMESTAMP``, as watermarks
    require), machine, user (some without one), song id and name."""
    song = F.get_json_object("props", "$.k")
    start = F.unix_micros(F.lit(STREAM_START).cast("timestamp"))
    since = F.unix_micros(F.col("ts").cast("timestamp")) - start
    user = F.col("user_id")
    return events.select(
        F.timestamp_micros(start + F.floor(since / F.lit(STREAM_SPEED)).cast("bigint")).alias("ts"),
        _s(user % machines).alias("mid"),
        F.when(F.col("event_id") % 23 != 0, _s(user)).alias("uid"),
        song.alias("songid"),
        F.concat(F.lit(SONG_NAME_PREFIX), song).alias("songname"),
    )


def record_messages(events: DataFrame, machines: int = MACHINES) -> DataFrame:
    """The records as a message bus delivers them: (timestamp, value), the value
    JSON text; the messages of one song in 19 are cut off in the middle."""
    body = F.to_json(F.struct("mid", "uid", "songid", "songname"))
    return play_records(events, machines).select(
        F.col("ts").alias("timestamp"),
        F.when(F.pmod(F.col("songid").cast("bigint"), F.lit(19)) == 7, F.substring(body, 1, 12)).otherwise(body).alias("value"),
    )


# --------------------------------------------------------------------------- song catalog

#: Singers of the stand-in catalog.
SINGERS = 97


def song_catalog(part: DataFrame) -> DataFrame:
    """TO_SONG_INFO_D with the raw JSON / text encodings the cleaner must handle."""
    k = F.col("p_partkey")
    size = F.col("p_size")
    singer_id = _s(k % SINGERS)
    singer = F.concat(F.lit("singer-"), singer_id)
    one_singer = F.concat(F.lit('[{"name":"'), singer, F.lit('","id":"'), singer_id, F.lit('"}]'))
    two_singers = F.concat(
        F.lit('[{"name":"'), singer, F.lit('","id":"'), singer_id,
        F.lit('"},{"name":"'), F.col("p_type"), F.lit('","id":"'), _s(size), F.lit('"}]'),
    )
    ints = [(((size + i) % (i + 2)).cast("int")).alias(c) for i, c in enumerate(SONG_INT_COLS)]
    return part.select(
        _s(k).alias("NBR"),
        F.when(k % 10 == 3, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("NAME"),
        F.concat(F.col("p_name"), F.lit(" (live)")).alias("OTHER_NAME"),
        (size % 3).cast("int").alias("SOURCE"),
        _case(k % 5, [
            F.concat(F.lit('[{"name":"'), F.col("p_type"), F.lit('"}]')),
            F.concat(F.lit("best of 《"), F.col("p_type"), F.lit("》 vol."), _s(size)),
            '[{"id":7}]',
            "unknown",
        ], F.lit(None).cast("string")).alias("ALBUM"),
        F.concat(F.lit("label-"), F.col("p_brand")).alias("PRDCT"),
        F.when(size % 2 == 0, F.lit("国语")).otherwise(F.lit("粤语")).alias("LANG"),
        F.col("p_type").alias("VIDEO_FORMAT"),
        (size * 10).cast("int").alias("DUR"),
        _case(k % 4, [two_singers, one_singer, one_singer, "n/a"]).alias("SINGER_INFO"),
        _case(k % 4, [
            F.concat(F.lit("2019-"), F.lpad(_s(size % 12 + 1), 2, "0"), F.lit("-15 20:30:00.0")),
            _s(F.lit(1500000000000) + k * 3600000),
            "x",
        ], F.lit(None).cast("string")).alias("POST_TIME"),
        F.upper(F.substring("p_name", 1, 1)).alias("PINYIN_FST"),
        F.col("p_name").alias("PINYIN"),
        (k % 2).cast("int").alias("SING_TYPE"),
        F.col("p_brand").alias("ORI_SINGER"),
        F.concat(F.lit("lyricist-"), _s(size % 7)).alias("LYRICIST"),
        F.concat(F.lit("composer-"), _s(size % 5)).alias("COMPOSER"),
        *ints,
        _case(k % 4, [
            F.concat(F.lit('{"name":"'), F.col("p_brand"), F.lit(' Music"}')),
            "bad",
            F.lit(None).cast("string"),
            "{}",
        ]).alias("AUTH_CO"),
        (size % 2).cast("int").alias("STATE"),
        _case(k % 4, [
            F.concat(F.lit("["), _s(size), F.lit(".0,"), _s(size % 7), F.lit(".7]")),
            "",
            "[]",
        ], F.lit(None).cast("string")).alias("PRDCT_TYPE"),
    )


# --------------------------------------------------------------------------- machines

# fixed values of the stand-in: one raw address per nation key (0-based), in order
ADDRESSES = [
    "山西省太原市小店区",
    "北京市朝阳区",
    "重庆市城口县",
    "内蒙古自治区包头市",
    "新疆维吾尔自治区伊犁哈萨克自治州",
    "四川省甘孜州",
    "西藏自治区拉萨市",
    "上海市浦东新区",
    "天津市和平区",
    "广西壮族自治区南宁市青秀区",
    "宁夏回族自治区银川市兴庆区",
    "广东省深圳市南山区",
    "浙江省杭州市西湖区",
    "江西省南昌市红谷滩区",
    "湖北省武汉市洪山区",
    "重庆市渝中区",
    "新疆维吾尔自治区乌鲁木齐市天山区",
    "江苏省南京市鼓楼区",
    "香港特别行政区",
    "福建省厦门市思明区",
    "湖南省长沙市岳麓区",
    "云南省大理白族自治州",
    "山东省青岛市市南区",
    "河南省郑州市金水区",
    "吉林省延边朝鲜族自治州",
]
KNOWN_PROVINCE, KNOWN_CITY = "江西", "南昌"


# Which machines a source system knows (overlapping, neither complete), by id:
# used where the systems are put together (J6), not by the parsers of a system.

def known_to_a(supplier: DataFrame) -> DataFrame:
    return supplier.where(F.col("s_suppkey") % 10 != 3)


def known_to_b(supplier: DataFrame) -> DataFrame:
    return supplier.where(F.col("s_suppkey") % 10 != 7)


def known_location(supplier: DataFrame) -> DataFrame:
    return supplier.where(F.col("s_suppkey") % 11 != 5)


def known_store(supplier: DataFrame) -> DataFrame:
    return supplier.where(F.col("s_suppkey") % 8 != 6)


def machines_a(supplier: DataFrame) -> DataFrame:
    """TO_YCAK_MAC_D: system A's list of machines."""
    s = F.col("s_suppkey")
    return supplier.select(
        _s(s).alias("MID"),
        F.col("s_name").alias("SRL_ID"),
        F.concat(F.lit("HW"), _s(s)).alias("HARD_ID"),
        F.concat(F.lit("S"), _s(F.col("s_nationkey"))).alias("SONG_WHSE_VER"),
        F.concat(F.lit("E"), _s(s % 3)).alias("EXEC_VER"),
        F.lit("U1").alias("UI_VER"),
        F.when(F.col("s_acctbal") >= 0, F.lit("1")).otherwise(F.lit("0")).alias("STS"),
        F.concat(F.lit("202401"), F.lpad(_s(s % 30 + 1), 2, "0"), F.lit("083000")).alias("CUR_LOGIN_TM"),
        F.when(s % 2 == 0, F.lit("1")).otherwise(F.lit("0")).alias("PAY_SW"),
        F.when(s % 3 == 0, F.lit("0")).otherwise(F.lit("1")).alias("IS_ONLINE"),
    )


def machine_locations_a(supplier: DataFrame) -> DataFrame:
    """TO_YCAK_MAC_LOC_D: free-text address, province/city often missing."""
    s = F.col("s_suppkey")
    addr = F.element_at(F.array(*[F.lit(a) for a in ADDRESSES]), F.col("s_nationkey") + 1)
    null = F.lit(None).cast("string")
    return supplier.select(
        _s(s).alias("MID"),
        _case(s % 5, [KNOWN_PROVINCE, KNOWN_PROVINCE], null).alias("PRVC"),
        _case(s % 5, [KNOWN_CITY, null, KNOWN_CITY], null).alias("CTY"),
        addr.alias("ADDR"),
        F.when(s % 7 == 0, null).otherwise(F.concat(addr, F.lit("-"), _s(s))).alias("ADDR_FMT"),
        _case(s % 3, ["20230105093000", "20230105"], null).alias("REV_TM"),
        _case(s % 4, ["20221201", "bad"], "20221201120000").alias("SALE_TM"),
    )


def machines_b(supplier: DataFrame) -> DataFrame:
    """TO_YCBK_MAC_ADMIN_MAP_D: system B's contract view."""
    s = F.col("s_suppkey")
    null = F.lit(None).cast("string")
    return supplier.select(
        _s(s).alias("MID"),
        F.when(s % 6 == 1, F.lit(1)).otherwise(F.lit(2)).cast("int").alias("PRDCT_TYPE"),
        F.concat(F.lit("KTV-"), _s(s)).alias("MAC_NM"),
        F.when(s % 5 == 0, F.lit("联营版")).otherwise(F.lit("标准版")).alias("PKG_NM"),
        ((s * 7) % 150).cast("double").alias("INV_RATE"),
        (s % 10).cast("double").alias("AGE_RATE"),
        F.lit(20.0).alias("COM_RATE"),
        F.when(s % 9 == 0, F.lit(None).cast("double")).otherwise((s % 3).cast("double")).alias("PAR_RATE"),
        F.when(s % 2 == 0, F.lit("1")).otherwise(F.lit("0")).alias("IS_ACTV"),
        _case(s % 3, ["20230301101010", "20230301"], "n/a").alias("ACTV_TM"),
        _case(s % 2, ["20230201"], "20230201090000").alias("ORDER_TM"),
        F.when(s % 3 == 0, F.lit("0")).otherwise(F.lit("1")).alias("HAD_MPAY_FUNC"),
        _s(F.col("s_nationkey") % 5).alias("SCENE_PRVC_ID"),
        _s(F.col("s_nationkey")).alias("SCENE_CTY_ID"),
        _s((F.col("s_nationkey") + 1) % 25).alias("SCENE_AREA_ID"),
        F.when(s % 10 == 0, null).otherwise(F.concat(F.lit("No."), _s(s), F.lit(" Jiefang Rd "))).alias("SCENE_ADDR"),
        F.col("s_name").alias("GROUND_NM"),
    )


def provinces(region: DataFrame) -> DataFrame:
    return region.select(_s(F.col("r_regionkey")).alias("PRVC_ID"), F.col("r_name").alias("PRVC"))


def cities(nation: DataFrame) -> DataFrame:
    return nation.select(_s(F.col("n_nationkey")).alias("CTY_ID"), F.col("n_name").alias("CTY"))


def areas(nation: DataFrame) -> DataFrame:
    return nation.select(
        _s(F.col("n_nationkey")).alias("AREA_ID"), F.concat(F.col("n_name"), F.lit("-district")).alias("AREA")
    )


def store_map(supplier: DataFrame) -> DataFrame:
    s = F.col("s_suppkey")
    return supplier.select(
        _s(s).alias("MID"), _s(F.col("s_nationkey")).alias("STORE_ID")
    )


def stores(nation: DataFrame) -> DataFrame:
    n, r = F.col("n_nationkey"), F.col("n_regionkey")
    return nation.select(
        _s(n).alias("ID"),
        F.concat(F.lit("store-"), F.col("n_name")).alias("GROUND_NM"),
        F.when(r % 2 == 0, F.lit("KTV")).otherwise(F.lit("Mall")).alias("TAG_NM"),
        F.concat(F.lit("tag-"), _s(r)).alias("SUB_TAG_NM"),
        F.concat(F.lit("catgy-"), _s(n % 3)).alias("SUB_SCENE_CATGY_NM"),
        F.concat(F.lit("scene-"), _s(n % 4)).alias("SUB_SCENE_NM"),
        F.concat(F.lit("brand-"), _s(r)).alias("BRND_NM"),
        F.concat(F.lit("sub-brand-"), _s(n)).alias("SUB_BRND_NM"),
    )


# --------------------------------------------------------------------------- orders

BUSINESS_YEAR, BUSINESS_MONTH = 2024, 1


def consumption(orders: DataFrame, machines: int = MACHINES) -> DataFrame:
    """TO_YCAK_CNSM_D: orders as coin purchases (cents) on the business month."""
    o = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    day = F.date_format(
        F.make_date(F.lit(BUSINESS_YEAR), F.lit(BUSINESS_MONTH), F.dayofmonth("o_orderdate")), "yyyyMMdd"
    )
    status = F.col("o_orderstatus")
    return orders.select(
        _s(o).alias("ID"),
        F.concat(F.lit("T"), _s(o)).alias("TRD_ID"),
        F.col("o_custkey").alias("UID"),
        _s(F.col("o_custkey") % machines).alias("MID"),
        F.lit("2").alias("PRDCD_TYPE"),
        F.col("o_orderpriority").alias("PAY_TYPE"),
        F.concat(day, F.lpad(_s(o % 24), 2, "0"), F.lit("0000")).alias("ACT_TM"),
        F.when(o % 11 == 0, F.lit(None).cast("string")).otherwise(_s(o % 3)).alias("PKG_ID"),
        F.when(status == "O", -cents).otherwise(cents).alias("AMT"),
        _s(o).alias("ORDR_ID"),
        F.when(o % 4 == 0, F.lit("new-year")).otherwise(F.lit(None).cast("string")).alias("ACTV_NM"),
        cents.alias("PKG_PRC"),
        F.lit(0).cast("bigint").alias("PKG_DSCNT"),
        _s(o % 2).alias("CPN_TYPE"),
        F.when(status == "F", F.lit(1))
        .when(status == "P", F.lit(2))
        .when(o % 2 == 0, F.lit(3))
        .otherwise(F.lit(4))
        .cast("int")
        .alias("ORDR_TYPE"),
        day.alias(PARTITION_COL),
    )


# --------------------------------------------------------------------------- users

# fixed values of the stand-in: market segments of each user channel (all five)
CHANNEL_SEGMENTS = {
    "wechat": ["AUTOMOBILE"], "alipay": ["BUILDING"], "qq": ["FURNITURE"], "app": ["MACHINERY", "HOUSEHOLD"],
}


def _user_common(customer: DataFrame, segments: list[str], machines: int) -> tuple[DataFrame, list[Column]]:
    c = F.col("c_custkey")
    cols = [
        _s(c).alias("UID"),
        _s(c % machines).alias("REG_MID"),
        F.when(c % 7 == 6, F.lit(None).cast("string")).otherwise(_s(F.col("c_nationkey") % 3)).alias("GDR"),
        F.concat(_s(c % 30 + 1970), F.lit("-0"), _s(c % 9 + 1), F.lit("-1"), _s(c % 10)).alias("BIRTHDAY"),
        F.concat(F.lit("138"), _s(c + 10000000)).alias("MSISDN"),
        _s(F.col("c_nationkey")).alias("LOC_ID"),
        _s(c % 3).alias("LOG_MDE"),
        F.concat(
            F.date_format(F.make_date(F.lit(BUSINESS_YEAR), F.lit(BUSINESS_MONTH), (c % 30 + 1).cast("int")), "yyyyMMdd"),
            F.lpad(_s(c % 24), 2, "0"),
            F.lit("1500"),
        ).alias("REG_TM"),
        (c % 1000).cast("int").alias("USR_EXP"),
        (F.col("c_nationkey") * 10).cast("int").alias("SCORE"),
        (c % 5 + 1).cast("int").alias("LEVEL"),
    ]
    return customer.where(F.col("c_mktsegment").isin(segments)), cols


def users_wechat(customer: DataFrame, machines: int = MACHINES) -> DataFrame:
    df, cols = _user_common(customer, CHANNEL_SEGMENTS["wechat"], machines)
    return df.select(*cols, F.concat(F.lit("wx_"), _s(F.col("c_custkey"))).alias("WX_ID"))


def users_alipay(customer: DataFrame, machines: int = MACHINES) -> DataFrame:
    df, cols = _user_common(customer, CHANNEL_SEGMENTS["alipay"], machines)
    c = F.col("c_custkey")
    return df.select(
        *cols,
        F.concat(F.lit("ali_"), _s(c)).alias("ALY_ID"),
        _case(c % 3, [F.lit(None).cast("string"), "1"], "2").alias("USR_TYPE"),
        F.when(c % 2 == 0, F.lit("1")).otherwise(F.lit("0")).alias("IS_CERT"),
        F.when(c % 5 == 0, F.lit("1")).otherwise(F.lit("0")).alias("IS_STDNT"),
    )


def users_qq(customer: DataFrame, machines: int = MACHINES) -> DataFrame:
    df, cols = _user_common(customer, CHANNEL_SEGMENTS["qq"], machines)
    return df.select(*cols, F.concat(F.lit("qq_"), _s(F.col("c_custkey"))).alias("QQID"))


def users_app(customer: DataFrame, machines: int = MACHINES) -> DataFrame:
    df, cols = _user_common(customer, CHANNEL_SEGMENTS["app"], machines)
    return df.select(*cols, F.concat(F.lit("app_"), _s(F.col("c_custkey"))).alias("APP_ID"))


def user_rows_with_null_text(customer: DataFrame, machines: int = MACHINES) -> DataFrame:
    """Rows of a raw user table as text export leaves them: a missing value is
    the text ``null`` or blank."""
    c = F.col("c_custkey")
    return customer.select(
        _s(c).alias("UID"),
        F.when(c % 7 == 6, F.lit("null")).otherwise(_s(F.col("c_nationkey") % 3)).alias("GDR"),
        F.when(c % 5 == 1, F.lit("")).when(c % 5 == 2, F.lit("null")).otherwise(F.col("c_name")).alias("NAME"),
        F.when(c % 4 == 3, F.lit(None).cast("string")).otherwise(_s(c % machines)).alias("REG_MID"),
    )


def logins(events: DataFrame) -> DataFrame:
    """TO_YCAK_USR_LOGIN_D: one row per event (duplicates on purpose)."""
    return events.select(_s(F.col("user_id")).alias("UID"), day_of("ts").alias(PARTITION_COL))


#: Machine ids that users report, per machine of the business (most are unknown to it).
REPORTED_PER_MACHINE = 20


def _degrees(thousandths: Column) -> Column:
    """Whole thousandths of a degree (not negative) as text."""
    return F.concat(_s(F.floor(thousandths / 1000)), F.lit("."), F.lpad(_s(thousandths % 1000), 3, "0"))


def user_locations(events: DataFrame, machines: int = MACHINES) -> DataFrame:
    """TO_YCAK_USR_LOC_D: users report the machine they stand at.  Each machine
    has a spot of its own and some reports stray from it; a few machines are
    far away, report text or a latitude that does not exist; some errors
    report blanks."""
    e = F.col("event_id")
    m = e % (machines * REPORTED_PER_MACHINE)
    stray = F.when(F.col("user_id") % 7 == 0, F.lit(11)).otherwise(F.lit(0))
    blank = (F.col("event_type") == "error") & (e % 4 == 0)
    lat = F.when(m % 50 == 7, F.concat(F.lit("-"), _degrees(m * 37 % 60000))).when(m % 41 == 5, F.lit("north")).when(
        m % 43 == 9, F.lit("123.4")).otherwise(_degrees(18000 + (m * 7919 + stray) % 36000))
    lng = F.when(m % 50 == 7, F.concat(F.lit("-"), _degrees(m * 53 % 170000))).otherwise(_degrees(73000 + (m * 6007 + stray) % 62000))
    return events.select(
        _s(F.col("user_id")).alias("UID"),
        _s(m).alias("MID"),
        F.when(blank, F.lit("")).otherwise(lat).alias("LAT"),
        F.when(blank, F.lit("")).otherwise(lng).alias("LNG"),
        day_of("ts").alias(PARTITION_COL),
    )


def gazetteer(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Reference places for reverse geocoding: one per customer, so it grows
    with the data."""
    c, n = F.col("c_custkey"), F.col("n_nationkey")
    joined = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).join(
        region, nation["n_regionkey"] == region["r_regionkey"])
    return joined.select(
        c.cast("bigint").alias("place_id"),
        _degrees(18000 + c * 7577 % 36000).cast("double").alias("lat"),
        _degrees(73000 + c * 9973 % 62000).cast("double").alias("lng"),
        F.concat(F.col("r_name"), F.lit(" "), F.col("n_name")).alias("ADDR"),
        F.col("r_name").alias("PRVC"),
        F.col("n_name").alias("CTY"),
        _s(n).alias("CTY_CD"),
        F.concat(F.col("n_name"), F.lit("-D")).alias("DISTRICT"),
        _s(n + 100000).alias("AD_CD"),
        F.concat(F.lit("town-"), _s(n % 4)).alias("TOWN_SHIP"),
        _s(n * 1000).alias("TOWN_CD"),
        F.concat(F.lit("nb-"), _s(c)).alias("NB_NM"),
        F.lit("residential").alias("NB_TP"),
        F.concat(F.lit("bd-"), _s(n)).alias("BD_NM"),
        F.lit("mall").alias("BD_TP"),
        F.concat(F.col("n_name"), F.lit(" Street")).alias("STREET"),
        _s(n % 9 + 1).alias("STREET_NB"),
        _s(n).alias("STREET_LOC"),
        F.lit("N").alias("STREET_DRCTION"),
        _s(n * 10).alias("STREET_DSTANCE"),
        F.lit("[]").alias("BUS_INFO"),
    )
