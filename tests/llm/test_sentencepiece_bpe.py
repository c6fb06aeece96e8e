import random

import pytest

from encore.llm import sentencepiece_bpe as B
from encore.llm.queries import op10_token_counts, table
from encore.llm.sentencepiece_scan import decode

from .test_queries import SMALL
from .test_sentencepiece_scan import PATH, samples


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(8)
    giant = "".join(rng.choice("the of an\nd é x") for _ in range(5000))
    solid = "".join(rng.choice("theofand") for _ in range(700))
    cut = ["a" * 98 + " b", "a" * 99 + " b", "a" * 100 + "  b", " " * 99 + "▁ x", "x" * 99 + "  "]
    return [None, "", " ", "the of", "the of", giant, solid, f"{giant} {solid} {giant} ", " " * 150, *cut, *samples(60, 3)]


@pytest.mark.parametrize("chunk", [1, 7, 100, 1 << 14])
def test_texts_equal_the_library(spark, library, chunk):
    some = texts() if chunk > 1 else texts()[8:]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(some)], "doc_id long, text string, ids string")
    out = decode(B.encode(frame, PATH, chunk=chunk), PATH)
    assert out.columns == ["doc_id", "text", "ids", "token_ids", "decoded"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(some)
    for i, t in enumerate(some):
        assert got[i]["token_ids"] == library.encode(t or ""), repr(t)
        assert got[i]["decoded"] == (t or "").replace("▁", " ")


@pytest.mark.parametrize("chunk", [50, 1 << 14])
def test_documents_equal_the_library_and_op10(spark, library, chunk):
    docs = table(spark, SMALL, "documents")
    want = {r["doc_id"]: library.encode(r["text"] or "") for r in docs.collect()}
    assert {r["doc_id"]: r["token_ids"] for r in B.encode(docs, PATH, chunk=chunk).collect()} == want
    assert {r["doc_id"]: r["n_tokens"] for r in op10_token_counts(spark, SMALL).collect()} == {i: len(x) for i, x in want.items()}


def test_unigram_models_take_the_scan_and_others_are_refused(spark, tmp_path):
    frame = spark.createDataFrame([(1, "the of and")], "doc_id long, text string")
    for kind, name in ((1, "unigram"), (3, "word")):
        model = B._proto(PATH)
        model.trainer_spec.model_type = kind
        (tmp_path / name).write_bytes(model.SerializeToString())
    assert B.encode(frame, str(tmp_path / "unigram")).first()["token_ids"]
    with pytest.raises(ValueError, match="neither"):
        B.encode(frame, str(tmp_path / "word"))
    assert B.encode(frame.limit(0), PATH).count() == 0
