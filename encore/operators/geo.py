"""Reverse geocoding as a distributed nearest-place join (JN8).

The original called a web map service ten points at a time from inside
``mapPartitions``.  Here the place table is a DataFrame (a gazetteer), and the
nearest place of every point is found in a fixed number of jobs:

* *Tree, built once.*  Places are sorted along a space-filling curve (Morton
  order of latitude and longitude) and cut into buckets of neighbours.  A
  bucket's box is the least one around its places as points of the unit
  sphere, so neither the poles nor the date line are special.  There are at
  most ``MAX_BUCKETS`` boxes, whatever the gazetteer (buckets grow beyond
  that), and only the boxes and one place of each are sent to the tasks.
* *Search.*  A task puts the boxes under a tree (runs of ``FAN`` boxes, level
  by level) and takes a batch of points down it side by side.  The place kept
  with a node and the far corner of its box bound a point's nearest distance
  from above, the near face of a box bounds it from below; nodes that cannot
  hold the nearest place are left.  What remains are a few buckets per point.
* *Join.*  Points and places meet by bucket; the exact distance decides (ties:
  smallest ``place_id``).

A point far from every place, or among very many, keeps a handful of buckets.
Nothing is capped: every bucket that the bounds leave is compared, and every
point comes back.  Only ids, coordinates and distances take part; the names
are joined at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import materialize

# fixed value: mean Earth radius (km)
EARTH_RADIUS_KM = 6371.0088


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp = p2 - p1
    dl = F.radians(lng2) - F.radians(lng1)
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    root = F.sqrt(a)
    # clamp rounding above 1; NULL stays NULL (least() alone would skip it)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.when(root > 1.0, F.lit(1.0)).otherwise(root))


#: Places of a bucket, while there are at most MAX_BUCKETS.
BUCKET = 4
#: Boxes sent to the tasks (80 bytes each).
MAX_BUCKETS = 1 << 19
#: Nodes below a node of the tree.
FAN = 16
#: Points taken down the tree side by side.
SIDE_BY_SIDE = 4096
#: Slack of the bounds against rounding (squared chord of the unit sphere).
SLACK = 1e-13
#: Bits of a coordinate on the curve.
CURVE_BITS = 26


def usable_coordinate(c: Column, most: float) -> Column:
    """The coordinate as a double; NULL if it is no number or out of range."""
    value = c.try_cast("double")
    return F.when(value.between(-most, most), value)  # NaN is greater than any number


def _spread(c: Column) -> Column:
    """The bits of a number, each followed by a zero."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def curve_key(lat: Column, lng: Column) -> Column:
    """Place on the Morton curve."""
    n = 1 << CURVE_BITS

    def step(c: Column, low: float, span: float) -> Column:
        return F.least(F.floor((c - F.lit(low)) * F.lit(n / span)).cast("bigint"), F.lit(n - 1))

    return F.shiftleft(_spread(step(lat, -90.0, 180.0)), 1).bitwiseOR(_spread(step(lng, -180.0, 360.0)))


def unit_vector(lat: Column, lng: Column) -> list[Column]:
    p, q = F.radians(lat), F.radians(lng)
    return [F.cos(p) * F.cos(q), F.cos(p) * F.sin(q), F.sin(p)]


class BoxTree:
    """Boxes (in curve order) and one place of each, under a tree."""

    def __init__(self, low: np.ndarray, high: np.ndarray, place: np.ndarray):
        self.levels = [(low, high, place)]
        while len(low) > FAN:
            first = np.arange(0, len(low), FAN)
            low, high, place = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first), place[first]
            self.levels.append((low, high, place))

    def candidates(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, box) of the boxes that may hold a point's nearest place."""
        q = np.repeat(np.arange(len(points)), len(self.levels[-1][0]))
        node = np.tile(np.arange(len(self.levels[-1][0])), len(points))
        best = np.full(len(points), np.inf)
        for level in range(len(self.levels) - 1, -1, -1):
            low, high, place = (x[node] for x in self.levels[level])
            at = points[q]
            near = (np.maximum(np.maximum(low - at, at - high), 0) ** 2).sum(axis=1)
            most = np.minimum((np.maximum(at - low, high - at) ** 2).sum(axis=1), ((at - place) ** 2).sum(axis=1))
            np.minimum.at(best, q, most)
            keep = near <= best[q] + SLACK
            q, node = q[keep], node[keep]
            if level:
                size = len(self.levels[level - 1][0])
                many = np.minimum(FAN, size - FAN * node)
                q = np.repeat(q, many)
                node = np.repeat(FAN * node, many) + np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many)
        return q, node


def _route(tree):
    """(_k, _lat, _lng, x, y, z) -> (_k, _lat, _lng, bucket)."""
    def run(batches):
        names, boxes = tree.value
        held = BoxTree(*boxes)
        for batch in batches:
            for begin in range(0, batch.num_rows, SIDE_BY_SIDE):
                some = batch.slice(begin, SIDE_BY_SIDE)
                points = np.column_stack([some.column(c).to_numpy() for c in (3, 4, 5)])
                q, node = held.candidates(points)
                where = pa.array(q)
                yield pa.RecordBatch.from_arrays([*(some.column(c).take(where) for c in range(3)), pa.array(names[node])], ["_k", "_lat", "_lng", "bucket"])

    return run


def nearest_place(points: DataFrame, places: DataFrame, key: str, lat: str, lng: str, place_cols: list[str]) -> DataFrame:
    """``points`` -> every point column + ``place_id, distance_km, *place_cols``.

    Every point with a usable coordinate gets the exact nearest place; a
    point without one (NULL, text that is no number, NaN, out of range), or
    an empty gazetteer, gives NULLs.  ``key`` names the points in messages
    only: rows are told apart by position, so repeated keys are points of
    their own.
    """
    spark = points.sparkSession
    rows = materialize(points.withColumn("_k", F.monotonically_increasing_id()))
    usable = places.select("place_id", usable_coordinate(F.col("lat"), 90.0).alias("_plat"), usable_coordinate(F.col("lng"), 180.0).alias("_plng")).where(
        "_plat is not null and _plng is not null")
    sorted_ = usable.withColumn("_z", curve_key(F.col("_plat"), F.col("_plng"))).repartitionByRange("_z").sortWithinPartitions("_z", "place_id")
    seen = Observation()
    placed = materialize(sorted_.select("_plat", "_plng", "place_id", F.monotonically_increasing_id().alias("_o")).observe(seen, F.count(F.lit(1)).alias("n")))
    n = seen.get.get("n", 0)
    if not n:
        return rows.select(*[F.col(c) for c in points.columns], F.lit(None).cast("long").alias("place_id"), F.lit(None).cast("double").alias("distance_km"),
                           *[F.lit(None).cast(places.schema[c].dataType).alias(c) for c in place_cols])
    # numbers run on along the curve, so places with one quotient are neighbours
    x, y, z = unit_vector(F.col("_plat"), F.col("_plng"))
    placed = placed.select("_plat", "_plng", "place_id", x.alias("x"), y.alias("y"), z.alias("z"), F.expr(f"_o div {max(BUCKET, -(-n // MAX_BUCKETS))}").alias("bucket"))
    axes = ("x", "y", "z")
    boxes = placed.groupBy("bucket").agg(*[F.min(a).alias(f"l{a}") for a in axes], *[F.max(a).alias(f"h{a}") for a in axes],
                                         F.min(F.struct("place_id", *axes)).alias("p"))
    boxes = boxes.select("bucket", "lx", "ly", "lz", "hx", "hy", "hz", *[F.col(f"p.{a}").alias(f"p{a}") for a in axes]).toArrow()
    boxes = boxes.sort_by("bucket")
    columns = [boxes.column(i).to_numpy() for i in range(10)]
    tree = spark.sparkContext.broadcast((columns[0], tuple(np.column_stack(columns[i:i + 3]) for i in (1, 4, 7))))

    here = rows.select("_k", usable_coordinate(F.col(lat), 90.0).alias("_lat"), usable_coordinate(F.col(lng), 180.0).alias("_lng")).where(
        "_lat is not null and _lng is not null")
    routed = here.select("*", *unit_vector(F.col("_lat"), F.col("_lng"))).mapInArrow(_route(tree), "_k long, _lat double, _lng double, bucket long")
    best = materialize(routed.join(placed.select("bucket", "_plat", "_plng", "place_id"), "bucket").groupBy("_k").agg(F.min(F.struct(
        haversine_km(F.col("_lat"), F.col("_lng"), F.col("_plat"), F.col("_plng")).alias("distance_km"), "place_id")).alias("_b")).select(
        "_k", "_b.place_id", "_b.distance_km"))
    # names of the places that were found; of a repeated place the first
    names = places.select("place_id", *place_cols).join(best.select("place_id").distinct(), "place_id", "left_semi")
    if place_cols:
        names = names.groupBy("place_id").agg(F.min(F.struct(*place_cols)).alias("_n"))
        best = best.join(names, "place_id", "left")
    named = [F.col(f"_n.{c}").alias(c) for c in place_cols]
    return rows.join(best, "_k", "left").select(*[F.col(c) for c in points.columns], "place_id", "distance_km", *named)
