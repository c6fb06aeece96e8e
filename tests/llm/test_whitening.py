import math

import numpy as np
import pytest

from encore.llm import whitening as W
from encore.llm.queries import op13_whitening, table

from .test_queries import COLUMNS, SMALL

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=8):
    kept = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in kept]
    n = len(x)
    s = [sum(col) for col in zip(*x, strict=True)]
    dev = [sum((n * a - b) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    centred = np.array(x, float) - np.array(s) / n
    e, vec = np.linalg.eigh(centred.T @ centred / n)
    e, vec = e[::-1], vec[:, ::-1]
    return [i for i, _ in kept], n, dev, centred, e, vec


def compare(got, rows, k, distinct=True):
    ids, n, dev, centred, e, vec = brute(rows)
    assert len(got) == len(ids) * k
    by = {}
    for r in got:
        by.setdefault(r["component"], {}).setdefault(r["vec_id"], []).append(r)
    assert sorted(by) == list(range(1, k + 1))
    trace = e.sum()
    for comp, found in by.items():
        for i, d in zip(ids, dev, strict=True):
            assert all(r["n"] == n and r["identity_error"] < 1e-8 for r in found[i])
            assert d in {r["deviation"] for r in found[i]}
            assert abs(found[i][0]["explained"] * trace / e[comp - 1] - 1) < 1e-9
        if distinct:
            want = centred @ vec[:, comp - 1] / np.sqrt(e[comp - 1])
            have = np.array([found[i][0]["whitened"] for i in ids])
            sign = np.sign(want @ have)
            assert np.abs(have * sign - want).max() < 1e-8


def test_equals_eigenvectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(5, 12))
    rows = [(i, (base[i % 5] + 0.3 * rng.normal(size=12)).tolist()) for i in range(200)]
    rows += [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11)]
    frame = spark.createDataFrame([(*r, 1, [1], "a") for r in rows], SCHEMA + ", n int, x array<int>, component string").repartition(3)
    compare(W.whiten(frame).collect(), rows, 8)


def test_close_deviations(spark, monkeypatch):
    """Isotropic noise: neighbouring eigenvalues are close, none may be missed;
    the sums of tasks are added in between."""
    monkeypatch.setattr(W, "TASKS", 1)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    compare(W.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect(), rows, 8)


def test_repeated_deviations(spark):
    """A cross along the axes: all eigenvalues are equal, every one is found."""
    rows = [(2 * d + s, [(1.0 if s else -1.0) if i == d else 0.0 for i in range(12)]) for d in range(12) for s in (0, 1)]
    compare(W.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), rows, 8, distinct=False)


def test_low_rank_ties_and_repeated_rows(spark):
    rng = np.random.default_rng(3)
    a, b = (rng.integers(-4, 5, 9).astype(float) for _ in range(2))
    rows = [(i % 37, (a * (i % 7) + b * (i % 5)).tolist()) for i in range(70)]
    got = W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 140 and {r["component"] for r in got} == {1, 2} and all(r["identity_error"] < 1e-8 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 2.0])], [(1, [1.0, 1.0]), (2, [1.0, 1.0])], [(None, None)]])
def test_nothing_to_scale(spark, rows):
    assert W.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_short_huge_and_nameless_rows(spark):
    rows = [(None, [1.0, 2.0]), (1, [3.0]), (2, [1e30, 0.0]), (2, [])]
    got = W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) in (4, 8) and sum(r["vec_id"] is None for r in got) * 4 == len(got)
    small = [(i, [i * 1.0, 5.0 - i]) for i in range(4)]
    filled = W.whiten(spark.createDataFrame([(0, [0.0, 5.0]), (1, [1.0])], SCHEMA)).collect()
    want = W.whiten(spark.createDataFrame([(0, [0.0, 5.0]), (1, [1.0, 0.0])], SCHEMA)).collect()
    assert [r["deviation"] for r in filled] == [r["deviation"] for r in want] and len(small) == 4


def test_wide_embeddings_end_early(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(9, 40)) * (2.0 ** -np.arange(9))[:, None]
    rows = [(i, (rng.normal(size=9) @ base).tolist()) for i in range(150)]
    got = W.whiten(spark.createDataFrame(rows, SCHEMA), components=3, max_steps=30).collect()
    compare(got, rows, 3)


def test_large_deviations_are_exact():
    centre = W.Centre(10 ** 6, [7, 10 ** 12])
    x = np.array([[1 << 40, 5], [3, 10 ** 6]])
    assert centre.deviation(x) == [((10 ** 6 * (1 << 40)) - 7) ** 2 + (5 * 10 ** 6 - 10 ** 12) ** 2, (3 * 10 ** 6 - 7) ** 2]


def test_registered_query_equals_eigenvectors(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "embeddings").select("vec_id", "embedding").collect()]
    got = op13_whitening(spark, SMALL)
    assert got.columns == COLUMNS["op13"].split()
    compare(got.collect(), rows, 8)
