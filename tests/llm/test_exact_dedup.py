import hashlib
import random
import re

import pytest

from encore.llm import exact_dedup as E


def normal(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    return sorted((i, min(groups[normal(t)]), len(groups[normal(t)]), i == min(groups[normal(t)]),
                   hashlib.sha256(normal(t).encode()).hexdigest()) for i, t in rows)


def corpus():
    rng = random.Random(11)
    texts = [None, "", " ", "\n", " a", "a", "a ", "a\t b", "a b", "a\n\nb", "ab", "é  x", "é \tx", " ", "y" * 700]
    for _ in range(12):
        base = "".join(rng.choice("ab  \t\né€😀") for _ in range(rng.randrange(1, 400)))
        texts += [base, base.replace(" ", "  "), base + "!", re.sub(r"\s+", lambda m: m[0] + "\n", base)]
    return list(enumerate(texts))


@pytest.mark.parametrize("piece", [E.PIECE_CHARS, 7])
def test_equals_brute_force(spark, piece):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, kept int, rid string")
    got = sorted(tuple(r) for r in E.exact_groups(docs, piece_chars=piece).collect())
    assert got == brute(rows)


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(E, "CHUNK", 8)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc") for _ in range(12)) for _ in range(60)]
    rows = list(enumerate(texts + texts[:20]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in E.exact_groups(docs, primes=(5, 3)).collect()) == brute(rows)


def test_empty_null_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert E.exact_groups(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "t"), (5, "t"), (5, "t"), (None, "u"), (None, "u")]
    got = E.exact_groups(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5 and sum(r["kept"] for r in got) == 2
    assert {(r["keep_id"], r["group_size"]) for r in got if r["text_sha256"] == hashlib.sha256(b"t").hexdigest()} == {(5, 3)}


def test_fingerprints_compose():
    rng = random.Random(2)
    data = bytes(rng.randrange(256) for _ in range(200_000))
    for cut in (0, 1, 65_536, 100_001, 200_000):
        left, right = data[:cut], data[cut:]
        assert E.combine(E.fingerprint(left), E.fingerprint(right), len(right)) == E.fingerprint(data)


def test_large_groups_are_dealt_over_salts(spark, monkeypatch):
    """A group of copies larger than a salt, with texts of several chunks, and
    one collision inside it."""
    monkeypatch.setattr(E, "SALTED", 7)
    monkeypatch.setattr(E, "CHUNK", 64)
    rng = random.Random(6)
    body = "".join(rng.choice("abcdef ") for _ in range(300))
    rows = [(i, body.replace(" ", " " * (1 + i % 3))) for i in range(90)]
    rows += [(200 + i, "".join(rng.choice("ab") for _ in range(5))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(tuple(r) for r in E.exact_groups(docs, primes=(5, 3)).collect()) == brute(rows)
