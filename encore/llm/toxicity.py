"""Toxicity: a linear classifier on character n-grams whose features are
scaled by naive Bayes log-count ratios.

A text's features are the hashed byte n-grams (A-Z lower-cased, one space at
each end) that occur in it.  On the labelled sample, r = log of the ratio of
a feature's smoothed document shares in the two classes; a feature that
occurs takes the value r, and a logistic regression is fitted over the
``keep`` features whose documents are least like a draw from all (the largest
deviations of the toxic count in standard deviations).

The fit reads at most ``sample`` labelled documents; the counts per feature
are summed in Spark, the regression sees a sparse matrix of the sample.
Scoring is one scan of all texts without a shuffle; a long text is worked
through in pieces that overlap by the longest n-gram.

Defined cases: null counts as empty; an empty text gets the score of no
feature; without labelled documents of both classes every score is the share
of label 1 (0.5 without labels).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import TEXT_BATCH, Workspace, texts_of
from encore.llm.labelled import labelled_sample, sigmoid

NGRAMS = (4, 5)
BITS = 18
#: Bytes worked through at once.
PIECE = 1 << 19


def _cells(data: bytes):
    """Hashed n-grams of one piece, one array per length."""
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    code = b
    for n in range(2, max(NGRAMS) + 1):
        if len(b) < n:
            return
        code = code[:len(b) - n + 1] | (b[n - 1:] << np.uint64(8 * (n - 1)))
        if n in NGRAMS:
            yield (((code * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype(np.int32)


def _pieces(text: bytes):
    data = b" " + text.lower() + b" "
    step = PIECE - max(NGRAMS) + 1
    for at in range(0, max(1, len(data) - max(NGRAMS) + 1), step):
        yield data[at:at + PIECE]


def present(text: bytes) -> np.ndarray:
    """All cells that occur in a text."""
    on = np.zeros(1 << BITS, dtype=bool)
    for piece in _pieces(text):
        for cells in _cells(piece):
            on[cells] = True
    return np.flatnonzero(on)


def present_of(text: bytes, place: np.ndarray) -> np.ndarray:
    """The chosen features (place >= 0) that occur in a text."""
    found = [np.empty(0, np.int32)]
    for piece in _pieces(text):
        for cells in _cells(piece):
            at = place[cells]
            found.append(at[at >= 0])
    at = np.sort(np.concatenate(found))
    return at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at


def _class_counts(batches):
    """Documents per feature and class in this partition."""
    counts = np.zeros((2, 1 << BITS), dtype=np.int64)
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
            counts[label][present(text)] += 1
    cells = np.flatnonzero(counts.any(axis=0))
    for at in range(0, len(cells), 50_000):
        some = cells[at:at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(counts[0][some]), pa.array(counts[1][some])], ["cell", "clean", "toxic"])


def _place(cells: np.ndarray) -> np.ndarray:
    out = np.full(1 << BITS, -1, dtype=np.int32)
    out[cells] = np.arange(len(cells), dtype=np.int32)
    return out


def _chosen_rows(cells):
    def run(batches):
        place = _place(cells.value)
        for batch in batches:
            rows = [present_of(t, place) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], ["label", "on"])

    return run


def _score_rows(model, id_col: str):
    def run(batches):
        cells, weight, bias = model.value
        place = _place(cells)
        for batch in batches:
            z = np.array([bias + weight[present_of(t, place)].sum() for t in texts_of(batch)], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(z))], [id_col, "score"])

    return run


def fit(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, r: np.ndarray, ridge: float = 2e-4, rounds: int = 400,
        rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic regression over the scaled sparse features (full-batch Adam);
    returns the weight per feature (times r) and the bias."""
    n, m, value = len(y), len(r), r[cols]
    w, bias = np.zeros(m), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    for i in range(1, rounds + 1):
        e = (sigmoid(bias + np.bincount(rows, value * w[cols], n)) - y) / n
        grad = np.append(np.bincount(cols, value * e[rows], m) + ridge * w, e.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        step = rate * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.999**i)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    return w * r, float(bias)


def toxicity_scores(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", learn: Column | None = None,
                    sample: int = 16_000, keep: int = 2_048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (id_col, score) for every row of ``docs``."""
    spark = docs.sparkSession
    ws = Workspace(spark, "toxicity")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    learn = F.lit(True) if learn is None else learn
    known = labelled_sample(ws, texts, labels, label_col, learn, sample)
    size = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        prior = known.agg(F.coalesce(F.avg("label"), F.lit(0.5))).first()[0]
        return texts.select(F.col("doc_id").alias(id_col), F.lit(float(prior)).alias("score"))

    counts = known.select("label", "text").mapInArrow(_class_counts, "cell int, clean long, toxic long").groupBy("cell").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("clean + toxic >= 3")
    ratio = F.log((F.col("toxic") + 1) / (size[1] + 2)) - F.log((F.col("clean") + 1) / (size[0] + 2))
    every, share = size[0] + size[1], size[1] / (size[0] + size[1])
    n = F.col("clean") + F.col("toxic")
    spread = F.greatest(n * share * (1 - share) * (1 - n / (every + 1)), F.lit(1e-9))
    best = counts.select("cell", ratio.alias("r"), (F.abs(F.col("toxic") - n * share) / F.sqrt(spread)).alias("rank"))
    best = best.orderBy(F.desc("rank"), "cell").limit(keep).collect()  # at most ``keep`` rows
    cells = np.array([b["cell"] for b in best], dtype=np.int64)
    r = np.array([b["r"] for b in best], dtype=np.float64)

    matrix = ws.put(known.select("label", "text").mapInArrow(
        _chosen_rows(spark.sparkContext.broadcast(cells)), "label int, on array<int>")).toArrow()  # at most ``sample`` rows
    on = matrix.column("on").combine_chunks()
    lengths = np.diff(on.offsets.to_numpy())
    weight, bias = fit(np.repeat(np.arange(len(lengths)), lengths), on.flatten().to_numpy().astype(np.int64),
                       matrix.column("label").to_numpy().astype(np.float64), r)
    model = spark.sparkContext.broadcast((cells, weight, bias))
    ws.drop(known)
    return ws.put(texts.mapInArrow(_score_rows(model, id_col), f"{id_col} long, score double"), text_batch=TEXT_BATCH)
