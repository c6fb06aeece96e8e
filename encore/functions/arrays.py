"""Array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import as_col, ColumnOrName


def int_list(c: ColumnOrName) -> Column:
    """``[8.0,9.7]`` -> ``[8, 9]``: each element read as a double, truncated to int.

    Blank text gives an empty array; unreadable elements are skipped.
    """
    col = F.trim(as_col(c))
    body = F.regexp_replace(F.regexp_replace(col, r"^\[", ""), r"\]$", "")
    parts = F.split(body, ",")
    values = F.transform(parts, lambda x: F.trim(x).try_cast("double").try_cast("int"))
    parsed = F.filter(values, lambda x: x.isNotNull())
    return F.when(col == "", F.array().cast("array<int>")).otherwise(parsed)


def empty_to_null(c: ColumnOrName) -> Column:
    col = as_col(c)
    return F.when(F.size(col) > 0, col)
