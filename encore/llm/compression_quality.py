"""Quality from compression: two zstandard dictionaries, one trained on good
and one on bad labelled text, compress every text block by block; the
difference of the compressed sizes, normalised, becomes a calibrated score.

Blocks are short (BLOCK bytes), so the dictionary, and not what the text has
said already, decides the size throughout a long text.  The calibration is a
logistic fit on the normalised differences, the better of the two compression
ratios and the length, over labelled documents that the dictionaries were not
trained on.

The fit reads at most ``sample`` labelled documents (half for the
dictionaries, at most ``dict_docs`` per class and DICT_BYTES of each; half for
the calibration).  Scoring is one scan of all texts without a shuffle.

Defined cases: null counts as empty; an empty text gets the score that the
calibration gives a text of no bytes; where a class has no labelled document,
or too little text for a dictionary, every score is the share of label 1
(0.5 without labels).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import TEXT_BATCH, Workspace, texts_of, tidy
from encore.llm.labelled import apply_logistic, fit_logistic, labelled_sample

BLOCK = 512
LEVEL = 3
DICT_SIZE = 65536
#: Bytes of one labelled document that a dictionary is trained on.
DICT_BYTES = 8192
FEATURES = 8


def _blocks(data: bytes) -> list[bytes]:
    return [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)] or [b""]


def _compressors(good: bytes, bad: bytes):
    import zstandard

    out = []
    for raw in (good, bad):
        trained = zstandard.ZstdCompressionDict(raw)
        trained.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=False,
                                            write_checksum=False, write_dict_id=False))
    return out


def features(data: bytes, good, bad) -> list[float]:
    """What the calibration sees of a text: compressed sizes and length only."""
    a = b = 0
    for block in _blocks(data):
        a += len(good.compress(block))
        b += len(bad.compress(block))
    n = len(data) + 1
    apart, per_byte, ratio = (b - a) / max(1, min(a, b)), (b - a) / n, min(a, b) / n
    return [apart, per_byte, ratio, ratio * ratio, math.log(n), apart * abs(apart), apart * ratio, 1 / (ratio + 0.02)]


def _feature_rows(dicts):
    @tidy
    def run(batches):
        good, bad = _compressors(*dicts.value)
        for batch in batches:
            rows = [features(x, good, bad) for x in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["label", "x"])

    return run


def _score_rows(dicts, model: dict, id_col: str):
    @tidy
    def run(batches):
        good, bad = _compressors(*dicts.value)
        for batch in batches:
            x = np.array([features(t, good, bad) for t in texts_of(batch)]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(apply_logistic(model, x))], [id_col, "score"])

    return run


def train_dictionary(samples: list[bytes]) -> bytes | None:
    """A dictionary from blocks of texts; None where there is too little."""
    import zstandard

    blocks = [b for s in samples for b in (s[i:i + 1024] for i in range(0, len(s), 1024)) if len(b) >= 8]
    try:
        return zstandard.train_dictionary(DICT_SIZE, blocks).as_bytes()
    except zstandard.ZstdError:
        return None


def training_bytes(id_col: str, text_col: str, most: int) -> Column:
    """Blocks of 1024 bytes, at most ``most`` bytes in all, from the whole
    text, chosen by a hash of id and place and kept in order."""
    data = F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8")
    every = F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length(data) / 1024).cast("int") - 1, F.lit(0)))
    dealt = F.array_sort(F.transform(every, lambda i: F.struct(F.xxhash64(F.col(id_col), i).alias("h"), i.alias("i"))))
    chosen = F.array_sort(F.transform(F.slice(dealt, 1, most // 1024), lambda x: x["i"]))
    parts = F.transform(chosen, lambda i: F.hex(F.substring(data, i * 1024 + 1, F.lit(1024))))
    return F.unhex(F.array_join(parts, ""))


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", learn: Column | None = None,
                   sample: int = 16_000, dict_docs: int = 1_000, dict_bytes: int = DICT_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (id_col, score) for every row of ``docs``.  The dictionaries are
    trained on up to ``dict_docs`` texts a class, up to ``dict_bytes`` of each."""
    spark = docs.sparkSession
    ws = Workspace(spark, "compression")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    learn = F.lit(True) if learn is None else learn
    known = labelled_sample(ws, texts, labels, label_col, learn, sample)

    # at most 2 * dict_docs rows of dict_bytes bytes
    dicts: list[bytes | None] = []
    for label in (1, 0):
        some = known.where((F.col("half") == 0) & (F.col("label") == label)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(dict_docs)
        data = some.select(training_bytes("doc_id", "text", dict_bytes).alias("b")).collect()
        dicts.append(train_dictionary([bytes(r["b"]) for r in data]))
    rest = known.where("half = 1")
    share = {r["label"]: r["n"] for r in rest.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if None in dicts or len(share) < 2:
        prior = known.agg(F.coalesce(F.avg("label"), F.lit(0.5))).first()[0]
        return texts.select(F.col("doc_id").alias(id_col), F.lit(float(prior)).alias("score"))
    shared = spark.sparkContext.broadcast(tuple(dicts))  # two dictionaries of DICT_SIZE bytes
    fitted = ws.put(rest.select("label", "text").mapInArrow(_feature_rows(shared), "label int, x array<double>")).collect()
    model = fit_logistic(np.array([r["x"] for r in fitted]), np.array([float(r["label"]) for r in fitted]))
    ws.drop(known)
    scored = texts.mapInArrow(_score_rows(shared, model, id_col), f"{id_col} long, score double")
    return ws.put(scored, text_batch=TEXT_BATCH)
