import hashlib
import random

import numpy as np
import pytest

from encore.llm import sentencepiece_scan as S
from encore.llm.queries import op4_sentencepiece, table

from .test_queries import MID, SMALL

P = pytest.importorskip("public_tokenizers")
PATH = str(P.path("piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, ids string, no int"


@pytest.fixture(scope="module")
def pieces():
    return S.Pieces(PATH)


@pytest.fixture(scope="module")
def library():
    """The library with the same pieces and scores, as a unigram model."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=unigram_file().SerializeToString())


def unigram_file():
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    model = model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for piece, score in zip(model.pieces, S.Pieces(PATH).scores, strict=True):
        piece.score = score
    return model


def viterbi(pieces, text):
    """One pass over the whole text, in exact sixteenths."""
    full = S.normalised(text)
    ids = {pieces.names[i]: int(i) for i in np.flatnonzero(pieces.normal)}
    best, back = [0] + [None] * len(full), [None] * (len(full) + 1)
    for s in range(len(full)):
        options = [(n, ids[full[s:s + n]]) for n in range(1, pieces.longest + 1) if s + n <= len(full) and full[s:s + n] in ids]
        if not any(n == 1 for n, _ in options):
            options.append((1, -1))
        for n, i in options:
            total = best[s] + int(16 * (pieces.scores[i] if i >= 0 else pieces.unknown_score))
            if best[s + n] is None or total > best[s + n]:
                best[s + n], back[s + n] = total, (s, i)
    out, at = [], len(full)
    while at:
        s, i = back[at]
        out = ([i] if i >= 0 else [int(b) for b in pieces.byte_ids[list(full[s].encode("utf-8", "surrogatepass"))]]) + out
        at = s
    return out


def samples(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        alphabet = rng.choice(["ab the", "abc \n▁é日", "aaaa  b", "the of ation", "x=_.. ", "😀́ z"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 120)))
        yield text.replace(" ", "") if rng.random() < 0.3 else text


def test_whole_texts_equal_plain_viterbi(pieces):
    some = list(samples(150, 1))
    for text, got in zip(some, S.encode_batch(pieces, some), strict=True):
        assert got.tolist() == viterbi(pieces, text)


def test_scores_are_sixteenths_of_logarithms(pieces):
    own = pieces.scores[pieces.normal]
    assert (16 * own == np.round(16 * own)).all() and abs(np.exp(own).sum() - 1) < 0.05


def test_texts_equal_the_library(pieces, library):
    some = ["the of and", "hello world", "representatives of the", "he the shehe", "IllegalArgumentException in addEventListener", *samples(150, 5)]
    for text, got in zip(some, S.encode_batch(pieces, some), strict=True):
        assert got.tolist() == library.encode(text)


@pytest.mark.parametrize("chunk", [50, S.CHUNK])
def test_documents_equal_the_library(spark, library, chunk):
    docs = table(spark, SMALL, "documents")
    got = {r["doc_id"]: r["token_ids"] for r in S.encode(docs, PATH, chunk=chunk).collect()}
    assert got == {r["doc_id"]: library.encode(r["text"] or "") for r in docs.collect()}


def test_the_query_goes_through_the_scan(spark, library, monkeypatch):
    """Long documents of the registered query pass by the matrices."""
    seen = []
    scanned = S._scanned
    monkeypatch.setattr(S, "_scanned", lambda ws, chunks, path: seen.append(chunks.select("rid", "no", "m")) or scanned(ws, chunks, path))
    got = {r["doc_id"]: r for r in op4_sentencepiece(spark, MID).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, MID, "documents").collect()}
    long = [i for i, t in texts.items() if len(t) >= S.CHUNK]
    rows = seen[0].collect()
    assert long and len({r["rid"] for r in rows}) == len(long) and len(rows) > len(long) and all(len(r["m"]) == S.Pieces(PATH).longest ** 2 for r in rows)
    for i in long:
        ids = library.encode(texts[i])
        assert got[i]["n_pieces"] == len(ids) and got[i]["pieces_sha256"] == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()


def test_unigram_files_keep_their_scores(spark, tmp_path, library):
    (tmp_path / "unigram").write_bytes(unigram_file().SerializeToString())
    frame = spark.createDataFrame([(1, "the of and " * 40)], "doc_id long, text string")
    assert S.encode(frame, str(tmp_path / "unigram"), chunk=64).first()["token_ids"] == library.encode("the of and " * 40)


def test_round_trip(pieces):
    for text in samples(100, 2):
        ids = S.encode_batch(pieces, [text])[0]
        assert pieces.decode(ids.tolist()) == text.replace("▁", " ")


@pytest.mark.parametrize("chunk", [1, 2, 5, 17, 40])
def test_chunks_combine_to_the_whole(pieces, chunk):
    for text in samples(40, chunk):
        rows = S.chunk_rows(text, chunk, pieces.longest)
        chunks = [S.Chunk(pieces, S.code_points(part), size) for _, part, size in rows]
        vector = np.full(pieces.longest, -np.inf)
        vector[0] = 0
        vectors = []
        for c in chunks:
            vectors.append(vector)
            vector = S.max_plus(vector[None, :], c.matrix())[0]
        state, leave = 0, []
        for c, v in zip(chunks[::-1], vectors[::-1], strict=True):
            leave.append(state)
            state = c.entry_states(v)[state]
        got = [int(i) for c, v, s in zip(chunks, vectors, leave[::-1], strict=True) for i in c.tokens(v, s)]
        assert state == 0 and got == viterbi(pieces, text)


def test_products_are_associative(pieces):
    rows = S.chunk_rows("abthetheofation" * 6, 20, pieces.longest)
    m = [S.Chunk(pieces, S.code_points(part), size).matrix() for _, part, size in rows][:3]
    left, right = S.max_plus(S.max_plus(m[0], m[1]), m[2]), S.max_plus(m[0], S.max_plus(m[1], m[2]))
    assert np.array_equal(left, right)


@pytest.mark.parametrize("deal", [S.DEAL, 1000])
def test_tables_with_giant_null_and_repeated_texts(spark, pieces, monkeypatch, deal):
    monkeypatch.setattr(S, "DEAL", deal)
    rng = random.Random(8)
    giant = "".join(rng.choice("the of an\nd é x") for _ in range(5000))
    solid = "".join(rng.choice("theofand") for _ in range(700))
    texts = [None, "", "the of", "the of", giant, solid, giant + " tail", " " * 150]
    frame = spark.createDataFrame([(i if i else None, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    out = S.decode(S.encode(frame, PATH, chunk=100), PATH)
    assert out.columns == ["doc_id", "text", "ids", "no", "token_ids", "decoded"]
    got = {r["doc_id"] or 0: r for r in out.collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i]["token_ids"] == viterbi(pieces, t or "") and got[i]["decoded"] == (t or "")
    assert S.encode(frame.limit(0), PATH).count() == 0
    only = S.encode_only(frame, PATH, chunk=100)
    assert only.columns == ["doc_id", "ids", "no", "token_ids", "n_tokens", "round_trip"]
    assert all(r["round_trip"] and r["token_ids"] == got[r["doc_id"] or 0]["token_ids"] for r in only.collect())
    digests = {r["doc_id"] or 0: r for r in S.token_digests(frame, PATH, chunk=100).collect()}
    assert all(digests[i]["round_trip"] and digests[i]["n_pieces"] == len(got[i]["token_ids"]) for i in got)
