"""Nearest-place join against brute force."""

import math
import random

from encore.operators.geo import EARTH_RADIUS_KM, nearest_place

COLS = ["ADDR"]


def _hav(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    dp, dl = p2 - p1, math.radians(d) - math.radians(b)
    h = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h)))


def _check(spark, points, places):
    pts = spark.createDataFrame(points, "k string, lat double, lng double")
    plc = spark.createDataFrame(places, "place_id long, lat double, lng double, ADDR string")
    got = {r.k: r.place_id for r in nearest_place(pts, plc, "k", "lat", "lng", COLS).collect()}
    assert set(nearest_place(pts, plc, "k", "lat", "lng", COLS).columns) >= {"k", "lat", "lng", "place_id"}
    for k, la, ln in points:
        if la is None or ln is None:
            assert got[k] is None
            continue
        best = min(places, key=lambda p: (_hav(la, ln, p[1], p[2]), p[0]))
        assert got[k] == best[0], (k, la, ln)
    assert len(got) == len(points)


def test_dense_and_sparse(spark):
    rng = random.Random(7)
    places = [(i, rng.uniform(20, 45), rng.uniform(75, 130), f"p{i}") for i in range(60)]
    points = [(f"m{i}", rng.uniform(18, 47), rng.uniform(70, 135)) for i in range(80)]
    points.append(("none", None, None))
    _check(spark, points, places)


def test_far_points_and_high_latitude(spark):
    places = [(1, 10.0, 10.0, "a"), (2, 10.0, 10.9, "b"), (3, 80.0, 0.0, "c")]
    points = [("x", 10.0, 10.44), ("y", 10.0, 10.46), ("z", -60.0, 170.0), ("n", 85.0, 170.0)]
    _check(spark, points, places)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_lat = st.floats(min_value=-85, max_value=85, allow_nan=False)
_lng = st.floats(min_value=-180, max_value=179.999, allow_nan=False)


@settings(max_examples=8, deadline=None, derandomize=True)
@given(
    st.lists(st.tuples(_lat, _lng), min_size=1, max_size=12, unique=True),
    st.lists(st.tuples(_lat, _lng), min_size=1, max_size=15),
)
def test_global_random_points(spark, places, points):
    plc = [(i, la, ln, f"p{i}") for i, (la, ln) in enumerate(places)]
    pts = [(f"m{i}", la, ln) for i, (la, ln) in enumerate(points)]
    pdf = spark.createDataFrame(pts, "k string, lat double, lng double")
    gdf = spark.createDataFrame(plc, "place_id long, lat double, lng double, ADDR string")
    got = {r.k: (r.place_id, r.distance_km) for r in nearest_place(pdf, gdf, "k", "lat", "lng", COLS).collect()}
    for k, la, ln in pts:
        best = min(plc, key=lambda p: (_hav(la, ln, p[1], p[2]), p[0]))
        # equal distance to float precision counts as a tie (either place is nearest)
        assert abs(got[k][1] - _hav(la, ln, best[1], best[2])) < 1e-6, (k, la, ln, got[k], best)


def test_across_the_antimeridian(spark):
    places = [(1, 10.0, -179.9, "east of the line"), (2, 10.0, 178.0, "west")]
    points = [("x", 10.0, 179.9), ("y", 10.0, -179.5), ("z", 10.0, 178.9)]
    _check(spark, points, places)


def test_every_point_comes_back(spark):
    """Malformed, far and repeated points; places on one spot and at the edges."""
    points = [("a", "abc", "1"), ("b", "", ""), ("c", "NaN", "3"), ("d", "91", "0"), ("e", "0", "-180.5"), ("f", None, "1"),
              ("g", "0", "0"), ("g", "0", "0"), ("h", "90", "180"), ("i", "-90", "-180"), ("j", "1e1", " 10 ")]
    pts = spark.createDataFrame(points, "k string, lat string, lng string")
    places = [(5, 10.0, 10.0, "x"), (4, 10.0, 10.0, "y"), (6, 90.0, 0.0, "pole"), (7, -90.0, 180.0, "south"), (8, None, 1.0, "none")]
    plc = spark.createDataFrame(places, "place_id long, lat double, lng double, ADDR string")
    got = sorted((r.k, r.place_id, r.ADDR) for r in nearest_place(pts, plc, "k", "lat", "lng", COLS).collect())
    none = [(k, None, None) for k in "abcdef"]
    assert got == [*none, ("g", 4, "y"), ("g", 4, "y"), ("h", 6, "pole"), ("i", 7, "south"), ("j", 4, "y")]
    empty = nearest_place(pts, plc.limit(0), "k", "lat", "lng", COLS)
    assert empty.count() == len(points) and empty.where("place_id is not null").count() == 0


def test_few_buckets_per_point(spark):
    """Near, far and central points keep a handful of buckets, also in a dense city."""
    import numpy as np

    from encore.operators import geo

    rng = np.random.default_rng(3)
    lat = np.concatenate((rng.uniform(20, 45, 20_000), rng.normal(31, 0.05, 20_000)))
    lng = np.concatenate((rng.uniform(75, 130, 20_000), rng.normal(121, 0.05, 20_000)))
    vec = lambda a, b: np.column_stack((np.cos(np.radians(a)) * np.cos(np.radians(b)), np.cos(np.radians(a)) * np.sin(np.radians(b)), np.sin(np.radians(a))))
    frame = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lng, strict=True))], "i int, lat double, lng double")
    order = [r["i"] for r in frame.orderBy(geo.curve_key(geo.F.col("lat"), geo.F.col("lng"))).select("i").collect()]
    places = vec(lat, lng)[order]
    first = np.arange(0, len(places), geo.BUCKET)
    tree = geo.BoxTree(np.minimum.reduceat(places, first), np.maximum.reduceat(places, first), places[first])
    points = vec(np.concatenate((rng.uniform(-90, 90, 300), rng.normal(31, 0.05, 300), rng.uniform(20, 45, 300))),
                 np.concatenate((rng.uniform(-180, 180, 300), rng.normal(121, 0.05, 300), rng.uniform(75, 130, 300))))
    q, node = tree.candidates(points)
    nearest = ((points[:, None, :] - places[None, :, :]) ** 2).sum(axis=2).argmin(axis=1) // geo.BUCKET
    kept = set(zip(q.tolist(), node.tolist(), strict=True))
    assert all((i, int(b)) in kept for i, b in enumerate(nearest))
    compared = np.bincount(q) * geo.BUCKET  # of 40,000 places
    assert compared.mean() <= 100 and compared.max() <= 1000


def _jobs(spark, run) -> int:
    """Jobs that ``run`` starts."""
    group = f"count-{id(run)}"
    spark.sparkContext.setJobGroup(group, group)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_the_gazetteer(spark):
    rng = random.Random(5)
    pts = spark.createDataFrame([(f"m{i}", rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(50)], "k string, lat double, lng double")

    def lookup(n):
        plc = spark.createDataFrame([(i, rng.uniform(-80, 80), rng.uniform(-180, 180), "p") for i in range(n)], "place_id long, lat double, lng double, ADDR string")
        return lambda: nearest_place(pts, plc, "k", "lat", "lng", COLS).collect()

    few, many = _jobs(spark, lookup(10)), _jobs(spark, lookup(20_000))
    assert few <= many <= few + 2


def test_large_buckets_stay_exact(spark, monkeypatch):
    """More places than boxes: buckets grow, results stay."""
    from encore.operators import geo

    monkeypatch.setattr(geo, "MAX_BUCKETS", 5)
    rng = random.Random(9)
    places = [(i, rng.uniform(-89, 89), rng.uniform(-180, 180), f"p{i}") for i in range(700)]
    points = [(f"m{i}", rng.uniform(-89, 89), rng.uniform(-180, 180)) for i in range(60)]
    _check(spark, points, places)
