"""String column expressions: log splitting, address parsing, blanks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import as_col, ColumnOrName


def split_dropping_trailing(c: ColumnOrName, sep: str = "&") -> Column:
    """Split like ``java.lang.String.split``: trailing empty parts are removed.

    ``a&b&`` gives ``[a, b]`` (Spark's ``split`` alone would give ``[a, b, '']``).
    """
    quoted = re.escape(sep)
    if len(sep) == 1:
        trimmed = F.rtrim(as_col(c), F.lit(sep))  # plain trailing-character trim, no regex
    else:
        trimmed = F.regexp_replace(as_col(c), f"({quoted})+$", "")
    return F.split(trimmed, quoted)


def has_parts(parts: Column, n: int) -> Column:
    return F.size(parts) == F.lit(n)


def blank_to_null(c: ColumnOrName) -> Column:
    """Raw layers carry ``''`` and the text ``null`` for missing values."""
    col = as_col(c)
    return F.when((col == F.lit("")) | (F.lower(col) == F.lit("null")), F.lit(None).cast("string")).otherwise(col)


def null_to_empty(c: ColumnOrName) -> Column:
    return F.coalesce(as_col(c).cast("string"), F.lit(""))


# ---------------------------------------------------------------------------
# Address parsing.  Fixed values of the data model:
# the province-level names matched in the free-text address, in the order
# they are tested, each with the short name it maps to.
# ---------------------------------------------------------------------------
# fixed values: (address marker, short province name), tested in this order
PROVINCE_MARKERS = [
    ("内蒙古自治区", "内蒙古"),
    ("宁夏回族自治区", "宁夏"),
    ("西藏自治区", "西藏"),
    ("广西壮族自治区", "广西"),
    ("新疆维吾尔自治区", "新疆"),
    ("北京市", "北京"),
    ("上海市", "上海"),
    ("重庆市", "重庆"),
    ("天津市", "天津"),
]
# fixed values: the province suffix and the city-level suffixes used to cut names
PROVINCE_SUFFIX = "省"
REGION_SUFFIX = "区"
CITY_SUFFIX = "市"
COUNTY_SUFFIX = "县"
PREFECTURE_SUFFIX = "州"

# Autonomous regions whose city sits between the first 区 and the next 市.
_REGION_CITY = ["内蒙古自治区", "宁夏回族自治区", "广西壮族自治区", "西藏自治区"]
_XINJIANG = "新疆维吾尔自治区"
_MUNICIPAL_DISTRICT = ["北京市", "上海市", "天津市"]
_CHONGQING = "重庆市"


def _between(addr: Column, start: str, end: str) -> Column:
    """Text after the first ``start`` up to the first ``end`` after it, '' if absent."""
    return F.regexp_extract(addr, f"^[^{start}]*{start}([^{end}]*){end}", 1)


def _after(addr: Column, start: str) -> Column:
    return F.regexp_extract(addr, f"^[^{start}]*{start}(.*)$", 1)


def province_from_address(c: ColumnOrName) -> Column:
    """Short province name from a Chinese address; '' when no rule applies."""
    addr = as_col(c)
    expr = None
    for marker, short in PROVINCE_MARKERS:
        cond = addr.contains(marker)
        expr = F.when(cond, F.lit(short)) if expr is None else expr.when(cond, F.lit(short))
    expr = expr.when(addr.contains(PROVINCE_SUFFIX), F.substring_index(addr, PROVINCE_SUFFIX, 1))
    return F.when(addr.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit("")))


def city_from_address(c: ColumnOrName) -> Column:
    """City (suffix removed) from a Chinese address; '' when no rule applies.

    Rules in order: autonomous regions 区…市; Xinjiang 区…市, else between the
    first two 区, else 区…州; Beijing/Shanghai/Tianjin 市…区; Chongqing 市…区
    else 市…县; provinces 省…市 else 省…州.  Unlike the original helper nothing
    throws: a missing delimiter yields ''.
    """
    addr = as_col(c)
    region = _between(addr, REGION_SUFFIX, CITY_SUFFIX)
    after_region = _after(addr, REGION_SUFFIX)
    xinjiang = (
        F.when(region != "", region)
        .when(after_region.contains(REGION_SUFFIX), _between(addr, REGION_SUFFIX, REGION_SUFFIX))
        .when(after_region.contains(PREFECTURE_SUFFIX), _between(addr, REGION_SUFFIX, PREFECTURE_SUFFIX))
        .otherwise(F.lit(""))
    )
    after_city = _after(addr, CITY_SUFFIX)
    chongqing = (
        F.when(after_city.contains(REGION_SUFFIX), _between(addr, CITY_SUFFIX, REGION_SUFFIX))
        .when(after_city.contains(COUNTY_SUFFIX), _between(addr, CITY_SUFFIX, COUNTY_SUFFIX))
        .otherwise(F.lit(""))
    )
    after_province = _after(addr, PROVINCE_SUFFIX)
    province = (
        F.when(after_province.contains(CITY_SUFFIX), _between(addr, PROVINCE_SUFFIX, CITY_SUFFIX))
        .when(after_province.contains(PREFECTURE_SUFFIX), _between(addr, PROVINCE_SUFFIX, PREFECTURE_SUFFIX))
        .otherwise(F.lit(""))
    )
    is_region = None
    for marker in _REGION_CITY:
        cond = addr.contains(marker)
        is_region = cond if is_region is None else (is_region | cond)
    is_municipal = None
    for marker in _MUNICIPAL_DISTRICT:
        cond = addr.contains(marker)
        is_municipal = cond if is_municipal is None else (is_municipal | cond)
    expr = (
        F.when(addr.isNull(), F.lit(None).cast("string"))
        .when(is_region, region)
        .when(addr.contains(_XINJIANG), xinjiang)
        .when(is_municipal, _between(addr, CITY_SUFFIX, REGION_SUFFIX))
        .when(addr.contains(_CHONGQING), chongqing)
        .when(addr.contains(PROVINCE_SUFFIX), province)
        .otherwise(F.lit(""))
    )
    return expr


def fill_from_address(known: ColumnOrName, addr: ColumnOrName, parser) -> Column:
    """Keep a known value, else parse it out of the address, else ''."""
    return F.coalesce(as_col(known), parser(addr), F.lit(""))
