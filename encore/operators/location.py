"""Machine location (J7): most-reported coordinate of each machine over the
last 30 days, reverse-geocoded, plus yesterday's rows for machines that
were not located today."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import DAY_FMT, days_before
from ..functions.text import null_to_empty
from ..session import materialize
from ..sources.schemas import GAZETTEER_PLACE_COLS, PARTITION_COL
from ..sources.tables import between_days
from .geo import nearest_place
from .ranking import mode_per_key

WINDOW_DAYS = 30
LOCATION_COLS = ["MID", "X", "Y", "CNT", *GAZETTEER_PLACE_COLS]


def _blank(c: str):
    return (F.col(c) == "") | F.col(c).isNull()


def coordinate_counts(user_locations: DataFrame, day: str, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Distinct reporters per (machine, lat, lng): a user's repeats count once."""
    rows = between_days(user_locations, days_before(day, window_days), day).select("UID", "MID", "LAT", "LNG")
    return (
        rows.distinct()
        .groupBy("MID", "LAT", "LNG")
        .agg(F.count(F.lit(1)).alias("CNT"))
        .select("MID", F.col("LAT").alias("X"), F.col("LNG").alias("Y"), "CNT")
    )


def mode_location(user_locations: DataFrame, day: str, window_days: int = WINDOW_DAYS,
                  drop_blank_first: bool = False) -> DataFrame:
    """Most frequent coordinate per machine (ties: smallest X, then Y).

    By default blank coordinates are removed *after* choosing the mode, so a
    machine whose most reported position is blank has no location today.
    """
    counts = coordinate_counts(user_locations, day, window_days)
    if drop_blank_first:
        counts = counts.where(~_blank("X") & ~_blank("Y"))
    best = mode_per_key(counts, "MID", "CNT", ["X", "Y"])
    return best.where(~_blank("X") & ~_blank("Y")).select("MID", "X", "Y", F.col("CNT").cast("int").alias("CNT"))


def locate(modes: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Attach the nearest place; unmatched place fields become ''."""
    placed = nearest_place(modes, gazetteer, "MID", "X", "Y", GAZETTEER_PLACE_COLS)
    return placed.select("MID", "X", "Y", "CNT", *[null_to_empty(c).alias(c) for c in GAZETTEER_PLACE_COLS])


def roll_forward(today: DataFrame, yesterday: DataFrame | None, day: str) -> DataFrame:
    """Today's rows plus yesterday's rows of machines absent today (anti-join + union)."""
    result = today.select(*LOCATION_COLS)
    if yesterday is not None:
        carried = yesterday.select(*LOCATION_COLS).join(today.select("MID"), "MID", "left_anti")
        result = carried.unionByName(result)
    return result.withColumn(PARTITION_COL, F.lit(day))


def machine_location(user_locations: DataFrame, gazetteer: DataFrame, day: str,
                     yesterday: DataFrame | None = None, window_days: int = WINDOW_DAYS,
                     drop_blank_first: bool = False) -> DataFrame:
    """TW_MAC_LOC_D for ``day`` (22 columns + data_dt)."""
    today = locate(mode_location(user_locations, day, window_days, drop_blank_first), gazetteer)
    return roll_forward(today, yesterday, day)


def mode_locations_for_days(user_locations: DataFrame, days: list[str], window_days: int = WINDOW_DAYS,
                            drop_blank_first: bool = False) -> DataFrame:
    """``mode_location`` for several days from ONE scan: each report is tagged
    with every requested day whose window holds it (at most ``len(days)``
    tags), then votes and modes are computed per (day, machine)."""
    lo = days_before(min(days), window_days)
    rows = between_days(user_locations, lo, max(days)).select("UID", "MID", "LAT", "LNG", PARTITION_COL)
    tags = F.array(*[
        F.when(F.col(PARTITION_COL).between(F.lit(days_before(d, window_days)), F.lit(d)), F.lit(d)) for d in days
    ])
    tagged = rows.select("UID", "MID", "LAT", "LNG", F.explode(F.filter(tags, lambda x: x.isNotNull())).alias("day"))
    counts = (
        tagged.distinct()
        .groupBy("day", "MID", "LAT", "LNG")
        .agg(F.count(F.lit(1)).alias("CNT"))
        .select("day", "MID", F.col("LAT").alias("X"), F.col("LNG").alias("Y"), "CNT")
    )
    if drop_blank_first:
        counts = counts.where(~_blank("X") & ~_blank("Y"))
    best = mode_per_key(counts, ["day", "MID"], "CNT", ["X", "Y"])
    return best.where(~_blank("X") & ~_blank("Y")).select(
        "day", "MID", "X", "Y", F.col("CNT").cast("int").alias("CNT")
    )


def locate_days(modes: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """``locate`` for (day, machine) points in one nearest-place pass."""
    keyed = modes.withColumn("_pk", F.concat_ws("|", "day", "MID"))
    placed = nearest_place(keyed, gazetteer, "_pk", "X", "Y", GAZETTEER_PLACE_COLS)
    return placed.select(
        "day", "MID", "X", "Y", "CNT", *[null_to_empty(c).alias(c) for c in GAZETTEER_PLACE_COLS]
    )


def machine_location_with_yesterday(user_locations: DataFrame, gazetteer: DataFrame, day: str,
                                    window_days: int = WINDOW_DAYS) -> DataFrame:
    """TW_MAC_LOC_D for ``day`` when yesterday's snapshot is not stored: both
    days' locations from one scan and one nearest-place pass, then the
    roll-forward."""
    prev = days_before(day, 1)
    located = locate_days(mode_locations_for_days(user_locations, [prev, day], window_days), gazetteer)
    today = located.where(F.col("day") == day).drop("day")
    yesterday = located.where(F.col("day") == prev).drop("day")
    return roll_forward(today, yesterday, day)


def _number(day: str | Column) -> Column:
    """Days since the epoch of a ``yyyyMMdd`` day."""
    return F.unix_date(F.to_date(F.lit(day) if isinstance(day, str) else day, DAY_FMT))


def _text(number: Column) -> Column:
    return F.date_format(F.date_from_unix_date(number), DAY_FMT)


def coordinate_counts_range(user_locations: DataFrame, first: str, last: str, window_days: int = WINDOW_DAYS) -> DataFrame:
    """``coordinate_counts`` of every day of a range from one scan.

    A user's report of a spot counts on its day and the ``window_days`` after
    it, once, however often it is repeated: it is one interval that ends where
    the next report's begins.  An interval is +1 on its first day and -1 after
    its last, so a running sum per spot over these few rows gives the count of
    every day; nothing is repeated per day before the reports are counted."""
    spot = ["MID", "LAT", "LNG"]
    seen = between_days(user_locations, days_before(first, window_days), last).select("UID", *spot, _number(F.col(PARTITION_COL)).alias("d")).distinct()
    again = F.lead("d").over(Window.partitionBy("UID", *spot).orderBy("d"))
    spans = seen.select(*spot, F.greatest("d", _number(first)).alias("a"), F.least(again, F.col("d") + window_days + 1).alias("b")).where("b > a")
    steps = spans.select(*spot, F.explode(F.array(
        F.struct(F.col("a").alias("d"), F.lit(1).alias("n")), F.struct(F.col("b").alias("d"), F.lit(-1).alias("n")))).alias("s"))
    steps = steps.groupBy(*spot, "s.d").agg(F.sum("s.n").alias("n"))
    along = Window.partitionBy(*spot).orderBy("d")
    runs = steps.select(*spot, "d", F.sum("n").over(along).alias("CNT"), F.lead("d").over(along).alias("next"))
    until = F.least(F.coalesce("next", _number(last) + 1), _number(last) + 1)
    runs = runs.withColumn("until", until).where("CNT > 0 and d < until")
    return runs.select(F.explode(F.sequence("d", F.col("until") - 1)).alias("d"), "MID", F.col("LAT").alias("X"), F.col("LNG").alias("Y"), "CNT").select(
        _text(F.col("d")).alias("day"), "MID", "X", "Y", "CNT")


def carry_forward(located: DataFrame, first: str, last: str, before: DataFrame | None = None) -> DataFrame:
    """Locations of every day of a range, each machine with its last located
    day's row (as ``roll_forward`` day after day would give).  ``located``:
    (day, MID, ...) rows of the days in the range; ``before``: the snapshot of
    the day before it."""
    rows = located.select(_number(F.col("day")).alias("d"), *LOCATION_COLS)
    if before is not None:
        rows = rows.unionByName(before.select((_number(first) - 1).alias("d"), *LOCATION_COLS))
    following = F.lead("d").over(Window.partitionBy("MID").orderBy("d"))  # a row a day at most
    rows = rows.withColumn("until", F.coalesce(following, _number(last) + 1)).withColumn("from", F.greatest("d", _number(first)))
    rows = rows.where("from < until")
    return rows.select(*LOCATION_COLS, F.explode(F.sequence("from", F.col("until") - 1)).alias("d")).select(*LOCATION_COLS, _text(F.col("d")).alias(PARTITION_COL))


def machine_location_range(user_locations: DataFrame, gazetteer: DataFrame, first: str, last: str, yesterday: DataFrame | None = None,
                           window_days: int = WINDOW_DAYS, drop_blank_first: bool = False) -> DataFrame:
    """TW_MAC_LOC_D of every day of a range in one job: one scan of the
    reports, one nearest-place pass over the distinct spots, one carry."""
    counts = coordinate_counts_range(user_locations, first, last, window_days)
    if drop_blank_first:
        counts = counts.where(~_blank("X") & ~_blank("Y"))
    best = materialize(mode_per_key(counts, ["day", "MID"], "CNT", ["X", "Y"]).where(~_blank("X") & ~_blank("Y")))
    # a spot is looked up once, for all machines and days
    spots = nearest_place(best.select("X", "Y").distinct(), gazetteer, "X", "X", "Y", GAZETTEER_PLACE_COLS)
    spots = spots.select("X", "Y", *[null_to_empty(c).alias(c) for c in GAZETTEER_PLACE_COLS])
    located = best.select("day", "MID", "X", "Y", F.col("CNT").cast("int").alias("CNT")).join(spots, ["X", "Y"])
    return carry_forward(located, first, last, yesterday)
