"""Code maps.  The codes and labels below are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import as_col, ColumnOrName

# fixed values: order type -> abnormal type (0 normal, 1 abnormal, 2 merchant refund)
ORDER_TYPE_TO_ABNORMAL = [(1, 0), (2, 1), (3, 2), (4, 2)]
# fixed values: registration channel code -> label, and the fallback label
CHANNEL_LABELS = [("1", "微信"), ("2", "支付宝"), ("3", "QQ"), ("4", "APP")]
UNKNOWN_CHANNEL = "未知"
# fixed values: gender code -> label, and the fallback label
GENDER_LABELS = [("0", "不明"), ("1", "男"), ("2", "女")]
UNKNOWN_GENDER = "不明"
# fixed values: business modes and the package name that implies revenue sharing
SHARED_PACKAGE = "联营版"
MODE_SHARED = "联营"
MODE_SOLD = "卖断"
FULL_RATE = 100
# fixed values: channel codes of the four user systems
CHANNEL_WECHAT, CHANNEL_ALIPAY, CHANNEL_QQ, CHANNEL_APP = "1", "2", "3", "4"
# fixed value: user type of a person
USER_TYPE_PERSON = "2"


def _map(col: Column, pairs, default=None) -> Column:
    expr = None
    for code, value in pairs:
        cond = col == F.lit(code)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def abnormal_type(c: ColumnOrName) -> Column:
    return _map(as_col(c), ORDER_TYPE_TO_ABNORMAL).cast("int")


def channel_label(c: ColumnOrName) -> Column:
    return _map(as_col(c), CHANNEL_LABELS, UNKNOWN_CHANNEL)


def gender_label(c: ColumnOrName) -> Column:
    return _map(as_col(c), GENDER_LABELS, UNKNOWN_GENDER)


def business_mode(package: ColumnOrName, investor_rate: ColumnOrName) -> Column:
    pkg, rate = as_col(package), as_col(investor_rate)
    return (
        F.when(pkg == F.lit(SHARED_PACKAGE), F.lit(MODE_SHARED))
        .when(rate < F.lit(FULL_RATE), F.lit(MODE_SHARED))
        .otherwise(F.lit(MODE_SOLD))
    )
