import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import compression_quality as C
from encore.llm import toxicity as X
from encore.llm.queries import CUT, op6_toxicity, op9_compression_quality, table
from encore.llm.labelled import bucket_of, fit_logistic, labelled_sample

from .test_queries import SMALL

DOCS = "doc_id long, text string, label int, score string, quality int"
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=700):
    rng = random.Random(21)
    syllable = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of"]
    word = lambda: "".join(rng.choice(syllable) for _ in range(rng.randrange(1, 5)))
    docs, labels = [], []
    for i in range(n):
        good, toxic = rng.random() < 0.7, rng.random() < 0.25
        words = [word() for _ in range(rng.randrange(20, 200))]
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "nitwit", "vermin"]))
        if not good:
            words = [w + rng.choice(["$$$", "%%%", "###"]) for w in words] if rng.random() < 0.5 else [words[0]] * len(words)
        docs.append((i, " ".join(words), 0, "x", 1))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def frames(spark):
    docs, labels = corpus()
    docs += [(None, None, 0, "x", 1), (10_000, "", 0, "x", 1), (10_001, "blockhead " * 40_000, 0, "x", 1), (10_001, "blockhead " * 40_000, 0, "x", 1)]
    labels += [(None, 1, 1), (5, 1 - labels[5][1], 1 - labels[5][2]), (20_000, 1, 0), (10_000, None, None)]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize(("score", "column", "accuracy"), [(C.quality_scores, "quality", 0.97), (X.toxicity_scores, "toxic", 0.9)])
def test_held_out_accuracy(frames, score, column, accuracy):
    docs, labels = frames
    got = score(docs, labels, learn=bucket_of("doc_id", 3) != 1)
    assert got.columns == ["doc_id", "score"] and got.count() == docs.count()
    assert got.where("score is null or not score between 0 and 1").count() == 0
    held = got.join(labels, "doc_id").where((bucket_of("doc_id", 3) == 1) & F.col(column).isNotNull() & (F.col("doc_id") != 5))
    right = held.agg(F.avg(((F.col("score") >= 0.5).cast("int") == F.col(column)).cast("int"))).first()[0]
    assert right >= accuracy
    twins = [r["score"] for r in got.where("doc_id = 10001").collect()]
    assert len(twins) == 2 and twins[0] == twins[1]


@pytest.mark.parametrize(("score", "column"), [(C.quality_scores, "quality"), (X.toxicity_scores, "toxic")])
def test_without_labels(spark, score, column):
    docs = spark.createDataFrame([(1, "a", 0, "x", 1), (2, None, 0, "x", 1)], DOCS)
    assert [r["score"] for r in score(docs, spark.createDataFrame([], LABELS)).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1, 1)], LABELS)
    assert [r["score"] for r in score(docs, one).collect()] == [1.0, 1.0]
    assert score(docs.limit(0), one).count() == 0


def test_sample_is_bounded_and_leaves_contradictions_out(spark, frames):
    from encore.llm.common import Workspace

    docs, labels = frames
    ws = Workspace(spark, "sample")
    every = labelled_sample(ws, docs.select("doc_id", "text"), labels, "toxic", F.lit(True), 10**6)
    assert every.where("doc_id = 5").count() == 0 and every.where("doc_id is null").count() == 0
    assert labelled_sample(ws, docs.select("doc_id", "text"), labels, "toxic", F.lit(True), 50).count() == 50


def test_features_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(1)
    text = bytes(rng.choice(b"abcd ABC") for _ in range(5000))
    whole = X.present(text)
    monkeypatch.setattr(X, "PIECE", 64)
    assert (X.present(text) == whole).all()
    place = np.full(1 << X.BITS, -1, dtype=np.int32)
    place[whole[::2]] = np.arange(len(whole[::2]))
    assert (X.present_of(text, place) == np.arange(len(whole[::2]))).all()


def test_log_count_ratio_fit_separates():
    rows, cols, y = np.array([0, 0, 1, 2, 2, 3]), np.array([0, 1, 1, 0, 2, 2]), np.array([1.0, 0.0, 1.0, 0.0])
    weight, bias = X.fit(rows, cols, y, np.array([2.0, -1.0, 0.5]))
    z = bias + np.bincount(rows, weight[cols], 4)
    assert ((z > 0) == (y == 1)).all()


def test_calibration_is_calibrated():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20_000, 1))
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(float)
    model = fit_logistic(x, y)
    assert model["weight"][0] / model["scale"][0] == pytest.approx(2, rel=0.1)


def test_dictionaries_see_whole_texts(spark):
    from encore.llm.compression_quality import training_bytes

    long = "".join(f"{i:01023d} " for i in range(100))
    rows = [(1, "short é text"), (2, None), (3, long), (4, long), (5, "é" * 3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: bytes(r[1]) for r in frame.select("doc_id", training_bytes("doc_id", "text", 8192)).collect()}
    assert got[1] == "short é text".encode() and got[2] == b"" and got[5] == ("é" * 3000).encode()
    for i in (3, 4):
        chosen = [int(x) for x in got[i].split()]
        assert len(got[i]) == 8192 and chosen == sorted(set(chosen)) and max(chosen) > 8
    assert got[3] != got[4]


def _caught(monkeypatch, module):
    """What the scoring step of a fitted classifier is given."""
    seen = []
    score = module._score_rows
    monkeypatch.setattr(module, "_score_rows", lambda *a: seen.append(a) or score(*a))
    return seen


def _compare(spark, rows, score, buckets, held):
    """Rows of a registered query against a plain score of each text."""
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SMALL, "documents").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        i = r["doc_id"]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % buckets == held)
        assert r["score"] == pytest.approx(score(texts[i].encode()), abs=1e-9)
        assert r["predicted"] == int(r["score"] >= CUT)


def test_quality_query_equals_plain_scores(spark, monkeypatch):
    """From the two dictionaries and the calibration, with plain arithmetic."""
    import zstandard

    seen = _caught(monkeypatch, C)
    rows = op9_compression_quality(spark, SMALL).collect()
    (dicts, model, _), = seen

    def size(data, dictionary):
        packer = zstandard.ZstdCompressor(level=C.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False,
                                          write_checksum=False, write_dict_id=False)
        return sum(len(packer.compress(data[i:i + C.BLOCK])) for i in range(0, max(len(data), 1), C.BLOCK))

    def score(data):
        a, b = (size(data, d) for d in dicts.value)
        n, least = len(data) + 1, min(a, b)
        apart, ratio = (b - a) / max(1, least), least / n
        x = [apart, (b - a) / n, ratio, ratio ** 2, math.log(n), apart * abs(apart), apart * ratio, 1 / (ratio + 0.02)]
        z = model["bias"] + sum(w * (v - m) / s for w, v, m, s in zip(model["weight"], x, model["mean"], model["scale"], strict=True))
        return 1 / (1 + math.exp(-max(-40, min(40, z))))

    _compare(spark, rows, score, 4, 2)


def test_toxicity_query_equals_plain_scores(spark, monkeypatch):
    """From the weights of the chosen n-grams, gram by gram."""
    seen = _caught(monkeypatch, X)
    rows = op6_toxicity(spark, SMALL).collect()
    (model, _), = seen
    cells, weight, bias = model.value
    by_cell = dict(zip(cells.tolist(), weight.tolist(), strict=True))
    full = (1 << 64) - 1

    def score(data):
        data = b" " + data.lower() + b" "
        on = set()
        for n in X.NGRAMS:
            for i in range(len(data) - n + 1):
                code = int.from_bytes(data[i:i + n], "little")
                on.add((((code * 0x9E3779B97F4A7C15 + n) & full) * 0xD6E8FEB86659FD93 & full) >> (64 - X.BITS))
        z = bias + sum(by_cell.get(c, 0.0) for c in on)
        return 1 / (1 + math.exp(-max(-40, min(40, z))))

    _compare(spark, rows, score, 3, 1)


def test_log_count_ratios_of_the_model(spark, monkeypatch):
    """The ratios that scale the features, recounted over the learned documents."""
    docs, labels = corpus(200)
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    seen = []
    fit = X.fit
    monkeypatch.setattr(X, "fit", lambda rows, cols, y, r: seen.append((cols, y, r)) or fit(rows, cols, y, r))
    caught = _caught(monkeypatch, X)
    X.toxicity_scores(*frames).collect()
    (_, y, r), = seen
    cells = caught[0][0].value[0]
    toxic = {i: t for i, _, t in labels}
    on = {i: set(X.present(t.encode()).tolist()) for i, t, *_ in docs}
    n1 = sum(toxic.values())
    assert len(y) == 200 and y.sum() == n1
    for cell, got in list(zip(cells.tolist(), r.tolist(), strict=True))[::17]:
        a = sum(cell in on[i] for i in on if toxic[i])
        b = sum(cell in on[i] for i in on if not toxic[i])
        assert got == pytest.approx(math.log((a + 1) / (n1 + 2)) - math.log((b + 1) / (200 - n1 + 2)))
