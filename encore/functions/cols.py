from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed_null(spark_type: str) -> Column:
    """NULL literal with a type, so unions and writes never see a void column."""
    return F.lit(None).cast(spark_type)
