"""Popularity index (RSI) expressions.

Fixed values of the index: play and like weights, the share of the
average-per-day term versus the best-day term, and the final scale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import as_col, ColumnOrName

# fixed values of the popularity index
PLAY_WEIGHT = 0.8
LIKE_WEIGHT = 0.2
AVERAGE_SHARE = 0.63
TOP_SHARE = 0.37
SCALE = 10


def _ln1p(c: Column) -> Column:
    return F.log(c + F.lit(1))


def rsi_one_day(plays: ColumnOrName, likes: ColumnOrName) -> Column:
    """``10 * (0.63*0.8*ln(plays+1) + 0.63*0.2*ln(likes+1))^2``."""
    p, l = as_col(plays), as_col(likes)
    inner = _ln1p(p / F.lit(1)) * AVERAGE_SHARE * PLAY_WEIGHT + _ln1p(l / F.lit(1)) * AVERAGE_SHARE * LIKE_WEIGHT
    return F.pow(inner, 2) * SCALE


def rsi_n_days(
    plays: ColumnOrName, top_plays: ColumnOrName, likes: ColumnOrName, top_likes: ColumnOrName, days: int
) -> Column:
    """Blend of the per-day average and the best day over an ``days`` horizon."""
    p, tp, l, tl = (as_col(x) for x in (plays, top_plays, likes, top_likes))
    play_part = _ln1p(p / F.lit(days)) * AVERAGE_SHARE + _ln1p(tp) * TOP_SHARE
    like_part = _ln1p(l / F.lit(days)) * AVERAGE_SHARE + _ln1p(tl) * TOP_SHARE
    return F.pow(play_part * PLAY_WEIGHT + like_part * LIKE_WEIGHT, 2) * SCALE
