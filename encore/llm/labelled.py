"""Bounded labelled samples and a small logistic fit for the classifiers.

A classifier is fitted on at most ``limit`` labelled documents, a documented
bound: the ones with the smallest hash of their id, so the choice does not
depend on partitioning.  Scoring reads every document.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import Workspace


def bucket_of(id_col: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(buckets))


def labelled_sample(ws: Workspace, docs: DataFrame, labels: DataFrame, label_col: str, learn: Column,
                    limit: int) -> DataFrame:
    """(doc_id, text, label, half) of at most ``limit`` labelled documents
    whose label row satisfies ``learn``; ids with contradicting labels are
    left out; half is 0 or 1 by the id."""
    one = labels.where(learn & F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label_col).alias("label"), F.max(label_col).alias("top"))
    one = ws.put(one.where("label = top").withColumn("order", F.xxhash64("doc_id", F.lit("sample"))))
    # a share by hash that holds about twice the sample, so that few rows of
    # a large table are sorted for it
    share = min(1.0, 2 * limit / max(1, one.count()))
    few = one.where(F.pmod("order", F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    chosen = ws.put(few.orderBy(F.pmod("order", F.lit(1 << 30)), "doc_id").limit(limit).select(
        "doc_id", F.col("label").cast("int").alias("label"), F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int").alias("half")))
    # at most ``limit`` rows of 16 bytes
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    return ws.put(rows)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 30) -> dict:
    """Newton's method on standardised columns; {mean, scale, weight, bias}."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = sigmoid(a @ w)
        grad = a.T @ (p - y) + ridge * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return {"mean": mean, "scale": scale, "weight": w[1:], "bias": w[0]}


def apply_logistic(model: dict, x: np.ndarray) -> np.ndarray:
    return sigmoid(((x - model["mean"]) / model["scale"]) @ model["weight"] + model["bias"])
