"""JSON text fields as column expressions (strict JSON; unparsable = NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cols import as_col, ColumnOrName

# fixed values: fallbacks for an album that cannot be read and for an
# unreadable licensing company
NO_ALBUM = "暂无专辑"
DEFAULT_COMPANY = "乐心曲库"

# fixed values: payload keys of a song-play request, in log order
PLAY_KEYS = [
    "songid",
    "mid",
    "optrate_type",
    "uid",
    "consume_type",
    "dur_time",
    "session_id",
    "songname",
    "pkg_id",
    "order_id",
]

CORRUPT = "_corrupt_record"
PLAY_PAYLOAD_SCHEMA = T.StructType(
    [T.StructField(k, T.StringType()) for k in PLAY_KEYS] + [T.StructField(CORRUPT, T.StringType())]
)


def play_payload(c: ColumnOrName) -> Column:
    """Parse a play payload once into a struct of ten text fields.

    Numbers come back as their text (``12`` -> ``"12"``); missing keys are
    NULL.  Text that is not a JSON object lands in ``_corrupt_record`` (the
    other fields NULL), so callers can drop and count it.
    """
    return F.from_json(as_col(c), PLAY_PAYLOAD_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})


def is_parsed(payload: Column) -> Column:
    return payload.isNotNull() & payload.getField(CORRUPT).isNull()


def album_name(c: ColumnOrName) -> Column:
    """Album name: JSON array element 0 ``name``; else the 《…》 span; else the default."""
    col = as_col(c)
    first = F.get_json_object(col, "$[0]")
    bracketed = F.nullif(F.regexp_extract(col, "《[^》]*》", 0), F.lit(""))
    return (
        F.when(first.isNotNull(), F.get_json_object(col, "$[0].name"))
        .otherwise(F.coalesce(bracketed, F.lit(NO_ALBUM)))
    )


def singer_field(c: ColumnOrName, index: int, field: str) -> Column:
    """Name or id of the singer at ``index`` (0 or 1) of a JSON array; '' when absent."""
    return F.coalesce(F.get_json_object(as_col(c), f"$[{index}].{field}"), F.lit(""))


SINGERS_SCHEMA = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.StringType())]))


def singer_fields(c: ColumnOrName) -> list[Column]:
    """``[SINGER1, SINGER2, SINGER1ID, SINGER2ID]`` from ONE parse of the JSON
    array (same results as four ``singer_field`` calls)."""
    col = as_col(c)
    # from_json would wrap a lone object into a one-element array; only arrays count
    arr = F.when(F.ltrim(col).startswith("["), F.from_json(col, SINGERS_SCHEMA))
    out = []
    for field in ("name", "id"):
        for i in (0, 1):
            out.append(F.coalesce(F.get(arr, i).getField(field), F.lit("")))
    return [out[0], out[1], out[2], out[3]]


def auth_company(c: ColumnOrName) -> Column:
    """``name`` of a JSON object (NULL if the key is missing); default if unparsable."""
    col = as_col(c)
    parsable = F.json_object_keys(col).isNotNull()
    return F.when(parsable, F.get_json_object(col, "$.name")).otherwise(F.lit(DEFAULT_COMPANY))
