"""Column-expression builders.  All run inside whole-stage codegen; no Python UDFs."""

from .arrays import empty_to_null, int_list
from .codes import abnormal_type, business_mode, channel_label, gender_label
from .cols import as_col, typed_null
from .dates import (
    date_part,
    clock_part,
    day_of,
    days_before,
    days_before_col,
    normalize_post_time,
    time14,
)
from .json_fields import album_name, auth_company, play_payload, singer_field, singer_fields
from .scores import rsi_n_days, rsi_one_day
from .text import (
    blank_to_null,
    city_from_address,
    fill_from_address,
    has_parts,
    null_to_empty,
    province_from_address,
    split_dropping_trailing,
)

__all__ = [
    "album_name",
    "abnormal_type",
    "as_col",
    "auth_company",
    "blank_to_null",
    "business_mode",
    "channel_label",
    "city_from_address",
    "clock_part",
    "date_part",
    "day_of",
    "days_before",
    "days_before_col",
    "empty_to_null",
    "fill_from_address",
    "gender_label",
    "has_parts",
    "int_list",
    "normalize_post_time",
    "null_to_empty",
    "play_payload",
    "province_from_address",
    "rsi_n_days",
    "rsi_one_day",
    "singer_field",
    "singer_fields",
    "split_dropping_trailing",
    "time14",
    "typed_null",
]
