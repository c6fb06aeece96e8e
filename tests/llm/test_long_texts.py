"""Very long texts, with the sizes of pieces and chunks that production uses."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from encore.llm import exact_dedup, mixing, quality_rules, suffix_dedup, token_counts, warc
from encore.llm.queries import MIX_TARGETS, tokenizer_path

WORDS = ["".join(x) for x in itertools.product("aeioubcd", repeat=4)]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def long():
    """Two texts of over 2^20 bytes that share a passage, and a copy."""
    a, b = prose(1, 260_000), prose(2, 260_000)
    passage = prose(3, 400)
    texts = [a[:700_000] + passage + a[700_000:], b + passage, b + passage, prose(4, 50)]
    assert min(map(len, texts[:3])) > 1 << 20
    return texts


def test_repeats_across_pieces(spark, long):
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(
        spark.createDataFrame(list(enumerate(long)), "doc_id long, text string"), length=400).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    data = [t.encode() for t in long]
    seen: dict[int, int] = {}
    for d in data:
        for i in range(len(d) - 399):
            h = hash(d[i:i + 400])
            seen[h] = seen.get(h, 0) + 1
    for i, d in enumerate(data):
        gone = np.zeros(len(d) + 1, dtype=int)
        for k in range(len(d) - 399):
            if seen[hash(d[k:k + 400])] > 1:
                gone[k] += 1
                gone[k + 400] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        assert tuple(got[i])[1:] == (len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())


def test_copies_of_long_texts(spark, long):
    """Texts of several pieces and chunks, equal but for white space, and one
    that differs in its last character."""
    rows = [(1, long[0]), (2, long[0].replace(" ", " \n\t")), (3, long[0][:-1] + "!"), (4, long[1]), (5, long[2])]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (3, 1), 4: (4, 2), 5: (4, 2)}


def test_rules_and_mixing_read_whole_texts(spark, long):
    rows = [(i, t, "en", "src1") for i, t in enumerate(long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    rules = {r["doc_id"]: r for r in quality_rules.quality_rules(docs).collect()}
    mixed = {r["doc_id"]: r for r in mixing.mix(docs, MIX_TARGETS).collect()}
    for i, t in enumerate(long):
        words = re.findall(r"[^\x20\x09-\x0d]+", t)
        assert (rules[i]["n_words"], rules[i]["word_chars"]) == (len(words), sum(map(len, words)))
        assert (mixed[i]["n_tokens"], mixed[i]["topic"]) == (len(words), "long" if len(t) >= 5000 else "short" if len(t) < 1000 else "article")


def test_tokens_of_long_texts_and_of_many_copies(spark, long, tmp_path):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=tokenizer_path())
    rows = [(0, long[0])] + [(i, long[3]) for i in range(1, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, tokenizer_path(), f"{tmp_path}/cache").collect()}
    few = len(library.encode(long[3]))
    assert got == {0: len(library.encode(long[0]))} | {i: few for i in range(1, 400)}


def test_archives_of_several_blocks(spark, long):
    """Payloads larger than an archive, and equal ones."""
    big = long[0] * 5
    rows = [(1, "u", big), (2, "u", long[1]), (3, "u", big), (4, "u", "")]
    got = {r["page_id"]: tuple(r)[1:] for r in warc.warc_round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()}
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    assert len(big) > warc.ARCHIVE_BYTES
    assert got == {1: (len(big), sha(big), "revisit", 3), 2: (len(long[1]), sha(long[1]), "response", None), 3: (len(big), sha(big), "response", None),
                   4: (0, sha(""), "response", None)}
