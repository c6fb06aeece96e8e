import pytest

from encore.llm import token_counts as K

SCHEMA = "doc_id long, text string, digest string, n_tokens int"
P = pytest.importorskip("public_tokenizers")


def texts():
    return [None, "", "one two", "one two", "<s> </s> é 😀 \n", "long " * 5000, "x" * 3000, " lead", "<|endoftext|>", "one two "]


def expected(name, all_texts):
    path = str(P.path(name))
    if name.endswith(".model"):
        import sentencepiece

        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in all_texts])]
    from tokenizers import Tokenizer

    return [len(x.ids) for x in Tokenizer.from_file(path).encode_batch([t or "" for t in all_texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_counts_equal_the_library(spark, tmp_path, name):
    rows = list(enumerate(texts()))
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    got = sorted(tuple(r) for r in K.token_counts(frame, str(P.path(name)), str(tmp_path / "cache")).collect())
    want = expected(name, texts())
    assert got == [(i, len((t or "").encode()), n, n > 4096) for (i, t), n in zip(rows, want, strict=True)]


def test_only_distinct_misses_are_encoded(spark, tmp_path, monkeypatch):
    path, cache = str(P.path("piece_bpe_32k.model")), str(tmp_path / "cache")
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts())], SCHEMA)
    K.token_counts(frame, path, cache)
    stored = spark.read.parquet(cache)
    assert stored.count() == 8  # null and "" are one, so are the two "one two"
    more = frame.union(spark.createDataFrame([(50, "new", "x", 1), (51, "new", "x", 1), (51, "new", "x", 1)], SCHEMA))
    got = K.token_counts(more, path, cache)
    assert got.count() == 13 and spark.read.parquet(cache).count() == 9
    K.token_counts(more, str(P.path("byte_bpe_50k.json")), cache)
    assert spark.read.parquet(cache).groupBy("tokenizer").count().count() == 2


def test_empty_null_and_repeated_rows(spark, tmp_path):
    path = str(P.path("piece_bpe_32k.model"))
    assert K.token_counts(spark.createDataFrame([], SCHEMA), path, str(tmp_path / "a")).count() == 0
    rows = [(None, "a b", None, None), (None, "a b", None, None), (1, "a b", None, None), (1, "c", None, None), (None, None, None, None)]
    got = K.token_counts(spark.createDataFrame(rows, SCHEMA), path, str(tmp_path / "b")).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == [("1", 1), ("1", 2), ("None", 0), ("None", 2), ("None", 2)]
