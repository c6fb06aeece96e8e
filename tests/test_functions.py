"""Golden rows for the column expressions (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore import functions as E
from encore.functions.dates import days_before


def _one_col(spark, values, fn, typ=T.StringType()):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("c", typ)]))
    return [r[0] for r in df.select(fn(F.col("c"))).collect()]


def test_split_dropping_trailing(spark):
    lines = ["t&m&R&{}&v&u", "a&b&c&d&e&", "a&b&c&d&e&f&&", 'a&b&R&{"x":"1&2"}&v&u']
    kept = _one_col(spark, lines, lambda c: E.has_parts(E.split_dropping_trailing(c), 6))
    assert kept == [True, False, True, False]


def test_play_payload_numbers_as_text(spark):
    out = _one_col(spark, ['{"songid":12,"uid":"0"}'], E.play_payload)[0]
    assert out["songid"] == "12" and out["uid"] == "0"
    assert all(out[k] is None for k in ("mid", "optrate_type", "consume_type", "dur_time",
                                        "session_id", "songname", "pkg_id", "order_id"))


def test_album(spark):
    vals = ['[{"name":"X"}]', "x《Y》z", "abc", "[]", None, '[{"id":1}]']
    assert _one_col(spark, vals, E.album_name) == ["X", "《Y》", "暂无专辑", "暂无专辑", "暂无专辑", None]


def test_singers(spark):
    three = '[{"name":"A","id":1},{"name":"B","id":2},{"name":"C","id":3}]'
    got = [_one_col(spark, [three, "bad", None, "[]"], lambda c, i=i, f=f: E.singer_field(c, i, f))
           for i, f in ((0, "name"), (0, "id"), (1, "name"), (1, "id"))]
    assert [g[0] for g in got] == ["A", "1", "B", "2"]
    assert all(g[1:] == ["", "", ""] for g in got)


def test_company(spark):
    assert _one_col(spark, ['{"name":"Co"}', "bad", None, "{}"], E.auth_company) == ["Co", "乐心曲库", "乐心曲库", None]


def test_int_list(spark):
    got = _one_col(spark, ["[8.0,9.7]", "", "[]", None], lambda c: E.empty_to_null(E.int_list(c)))
    assert got == [[8, 9], None, None, None]


def test_post_time(spark):
    vals = ["2020-01-01 00:00:00.0", "1500000000000", "1.5E12", "x", None]
    assert _one_col(spark, vals, E.normalize_post_time) == [
        "2020-01-01 00:00:00", "2017-07-14 02:40:00", "2017-07-14 02:40:00", "", "",
    ]


def test_time14(spark):
    assert _one_col(spark, ["20200102030405", "20200102", "2020", None], E.time14) == [
        "20200102030405", "20200102000000", "19700101000000", "19700101000000",
    ]


def test_days_before():
    assert days_before("20210103", 7) == "20201227"
    assert days_before("20240301", 1) == "20240229"


def test_days_before_col(spark):
    assert _one_col(spark, ["20210103"], lambda c: E.days_before_col(c, 7)) == ["20201227"]


ADDRESSES = [
    ("山西省太原市小店区", "山西", "太原"),
    ("北京市朝阳区", "北京", "朝阳"),
    ("重庆市城口县", "重庆", "城口"),
    ("内蒙古自治区包头市", "内蒙古", "包头"),
    ("新疆维吾尔自治区伊犁哈萨克自治州", "新疆", "伊犁哈萨克自治"),
    ("四川省甘孜州", "四川", "甘孜"),
    ("西藏自治区拉萨市", "西藏", "拉萨"),
    ("新疆维吾尔自治区克拉玛依区白碱滩区", "新疆", "克拉玛依"),
    ("香港特别行政区", "", ""),
]


@pytest.mark.parametrize("addr,prov,city", ADDRESSES)
def test_address(spark, addr, prov, city):
    assert _one_col(spark, [addr], E.province_from_address) == [prov]
    assert _one_col(spark, [addr], E.city_from_address) == [city]


def test_fill_from_address(spark):
    df = spark.createDataFrame([("江西", None, "湖北省武汉市洪山区"), (None, None, None)], "p string, c string, a string")
    rows = df.select(
        E.fill_from_address("p", "a", E.province_from_address).alias("p"),
        E.fill_from_address("c", "a", E.city_from_address).alias("c"),
    ).collect()
    assert [tuple(r) for r in rows] == [("江西", "武汉"), ("", "")]


def test_codes(spark):
    assert _one_col(spark, [1, 2, 3, 4, 9], E.abnormal_type, T.IntegerType()) == [0, 1, 2, 2, None]
    df = spark.createDataFrame([("联营版", 100.0), ("A", 50.0), ("A", 100.0), ("A", None)], "p string, r double")
    assert [r[0] for r in df.select(E.business_mode("p", "r")).collect()] == ["联营", "联营", "卖断", "卖断"]
    assert _one_col(spark, ["1", "4", "9", None], E.channel_label) == ["微信", "APP", "未知", "未知"]
    assert _one_col(spark, ["0", "1", "2", None], E.gender_label) == ["不明", "男", "女", "不明"]


def test_abs_amount(spark):
    assert _one_col(spark, [-5, 7], F.abs, T.LongType()) == [5, 7]


def test_rsi_golden(spark):
    df = spark.createDataFrame([(1, 0, 10, 14, 3, 60, 5)], "a long, l long, b long, s7 long, t7 long, s30 long, t30 long")
    r = df.select(
        E.rsi_one_day("a", "l"), E.rsi_one_day("b", "l"),
        E.rsi_n_days("s7", "t7", "l", "l", 7), E.rsi_n_days("s30", "t30", "l", "l", 30),
    ).first()
    for got, want in zip(r, (1.22042753, 14.60567040, 9.29380303, 11.75189111)):
        assert math.isclose(got, want, abs_tol=1e-7)


def test_singer_fields_one_parse_equals_per_field(spark):
    vals = ['[{"name":"A","id":1},{"name":"B","id":2},{"name":"C","id":3}]', '[{"name":"A","id":"x"}]',
            "bad", None, "[]", '["a"]', '{"name":"A"}']
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    one = df.select(*E.singer_fields("c")).collect()
    per = df.select(*[E.singer_field("c", i, f) for f, i in (("name", 0), ("name", 1), ("id", 0), ("id", 1))]).collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in per]


def test_post_time_independent_of_session_zone(spark):
    vals = ["2020-01-01 00:00:00.0", "1500000000000", "x"]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        shanghai = _one_col(spark, vals, E.normalize_post_time)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert shanghai == _one_col(spark, vals, E.normalize_post_time) == ["2020-01-01 00:00:00", "2017-07-14 02:40:00", ""]
    assert _one_col(spark, ["1500000000000"], lambda c: E.normalize_post_time(c, zone="Asia/Shanghai")) == [
        "2017-07-14 10:40:00"
    ]
