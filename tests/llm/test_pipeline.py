import random

import pytest

import corpus_pipeline as C
from encore.llm.mixing import MARGINALS  # noqa: F401 (the targets name these)

from .test_exact_dedup import normal
from .test_ngram_jaccard import brute as near_brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def rows():
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 7)))
    out = [(None, None), (None, "null id text"), (None, "null id text"), (500, ""), (501, None), (502, " ")]
    for i in range(60):
        base = [word() for _ in range(rng.choice([3, 30, 120]))]
        out.append((i * 3, " ".join(base)))
        if rng.random() < 0.4:
            out.append((i * 3 + 1, "  ".join(base)))
        if rng.random() < 0.4:
            base[rng.randrange(len(base))] = "edit"
            out.append((i * 3 + 2, " ".join(base)))
    out.append(out[10])
    return [(i, t, rng.choice(["en", "de"]), rng.choice(["src0", "src1"]), 0, "clash") for i, t in out]


@pytest.fixture(scope="module")
def table_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.createDataFrame(rows(), SCHEMA)
    docs.drop("score").write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], int((r[0] or 0) % 2), 0) for r in rows() if r[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").distinct().write.parquet(f"{folder}/labels.parquet")
    return folder


def test_exact_stage_equals_brute_force(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    out = C.exact(spark, docs, "")
    assert out.columns == docs.columns
    first = {}
    for r in rows():
        if r[0] is not None:
            key = normal(r[1])
            first[key] = min(first.get(key, r[0]), r[0])
    got = sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None)
    assert got == sorted(first.values())


def test_near_stage_equals_brute_force(spark):
    docs = C.exact(spark, spark.createDataFrame(rows(), SCHEMA), "")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None]
    out = C.near(spark, docs, "")
    assert out.columns == docs.columns
    want = sorted(i for i, _, component in near_brute(texts, 5, 80) if i == component)
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == want


def test_every_stage_keeps_columns_and_rows_whole(spark, table_dir):
    docs = C.table(spark, table_dir, "documents")
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    for _, stage in C.STAGES[:-1]:
        after = stage(spark, docs, table_dir)
        assert after.columns == docs.columns
        assert {(r["doc_id"], r["text"]) for r in after.collect()} <= texts
    out = C.run(spark, table_dir)
    assert out.count() > 0 and out.where("n_tokens != size(token_ids)").count() == 0


def test_empty_table(spark, table_dir):
    docs = C.table(spark, table_dir, "documents").limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, docs, table_dir).count() == 0


def test_last_stage_decodes_its_ids(spark, monkeypatch):
    texts = {1: "the of and", 2: "", 3: None, 4: " a  b▁c é日 ", 5: "x y " * 6000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = C.tokens(spark, docs, "")
    assert out.columns == ["doc_id", "token_ids", "n_tokens", "round_trip"]
    assert sorted((r["doc_id"], r["round_trip"]) for r in out.collect()) == [(i, True) for i in texts]
    encode = C.encode
    monkeypatch.setattr(C, "encode", lambda docs, path: encode(docs, path).withColumn("token_ids", C.F.slice("token_ids", 1, 2)))
    assert {r["doc_id"] for r in C.tokens(spark, docs, "").where("round_trip").collect()} == {2, 3}
