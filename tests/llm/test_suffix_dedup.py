import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import suffix_dedup as S
from encore.llm.common import Workspace


def brute(texts, length):
    """Removed bytes by definition: every window counted over the corpus."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=int)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, length):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [noise(length + rng.randrange(-2, 60)) for _ in range(4)]
    texts = [None, "", "x", noise(length - 1), noise(length)]
    for _ in range(30):
        texts.append(noise(rng.randrange(300)) + rng.choice(shared) + noise(rng.randrange(200)))
    texts += [texts[6], texts[6], texts[7][:150] + texts[8], "of " * 300, "of " * 200 + noise(80), "a" * 500, "a" * length]
    base = noise(600)
    for _ in range(8):
        at = rng.randrange(600)
        texts.append(base[:at] + "#" + base[at + 1:])
    texts.append(noise(200) + shared[0] + noise(50) + shared[0] + shared[1])
    return texts


@pytest.mark.parametrize("group", [S.GROUP, 3])
def test_equals_brute_force(spark, group):
    length = 80
    texts = corpus(7, length)
    docs = spark.createDataFrame([(i, t, "s", i) for i, t in enumerate(texts)], "doc_id long, text string, key string, place int")
    rows = S.remove_repeats(docs, length=length, batches=5, group=group).orderBy("doc_id").collect()
    got = [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows]
    assert got == brute(texts, length)
    assert all(sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"] for r in rows)


def test_empty_repeated_and_null_rows(spark):
    schema = "doc_id long, text string"
    assert S.remove_repeats(spark.createDataFrame([], schema), length=80).count() == 0
    text = "".join(chr(97 + (i * i) % 23) for i in range(100))
    rows = S.remove_repeats(spark.createDataFrame([(None, text), (None, text), (3, text[:90])], schema), length=80).collect()
    assert sorted((r["n_bytes"], r["n_removed"]) for r in rows) == [(90, 90), (100, 100), (100, 100)]


def test_sparse_suffixes_cover_every_window_and_pieces_agree(monkeypatch):
    rng = random.Random(3)
    text = bytes(rng.choice(b"ab c") for _ in range(3000)) + b"z" * 300
    places, keys = S.sparse_suffixes(text, 80)
    width = 80 - 20 + 1
    assert all(((places >= i) & (places < i + width)).any() for i in range(len(text) - 79))
    monkeypatch.setattr(S, "PIECE", 97)
    again = S.sparse_suffixes(text, 80)
    assert (again[0] == places).all() and (again[1] == keys).all()


def suffixes(spark, rows):
    """(gram, text) pairs as rows of a batch."""
    made = [(g.encode(), i, t == "twice", t_no, t_no) for g, i, t, t_no in rows]
    return spark.createDataFrame(made, "gram binary, key long, twice boolean, a long, b long")


def test_levels_merge_geometrically_and_find_what_meets(spark):
    family = S.SuffixFamily(Workspace(spark, "levels"))
    for i in range(5):
        family.add(suffixes(spark, [(f"g{k}", k, "twice" if k == 6 else "", i) for k in range(i, i + 3)]))
    assert [n for n, *_ in family.levels] == [4, 1]
    assert sorted(r["key"] for r in family.hit_keys().collect()) == [1, 2, 3, 4, 5, 6]
    array = spark.table(family.levels[0][1])
    assert sorted(bytes(r["gram"]) for r in array.collect()) == [f"g{k}".encode() for k in range(6)]
    family.close()


def test_merge_scan_reads_levels_without_exchange_or_sort(spark):
    family = S.SuffixFamily(Workspace(spark, "levels"))
    for i in range(3):
        family.add(suffixes(spark, [(f"g{k:04}", k, "", i) for k in range(i * 500, i * 500 + 900)]))
    with family._in_order():
        plan = family.merged(family.levels[0][1], family.levels[1][1], "inner")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "SortMergeJoin" in physical and "Exchange" not in physical and "Sort [" not in physical
    family.close()


def test_later_batch_against_stored_levels(spark):
    length = 80
    texts = corpus(11, length)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    half = len(texts) // 2
    ws = Workspace(spark, "stored")
    schema = "doc_id long, n_bytes long, sha binary, keys array<long>, twice array<boolean>, grams array<binary>"
    scan = ws.put(docs.mapInArrow(S._scan(length), schema))
    first = S.SuffixFamily(ws)
    first.add(S.suffix_rows(scan.where(F.col("doc_id") < half)))
    earlier = first.hit_keys()
    later = S.SuffixFamily.open(ws, first.buckets, [(n, path) for n, _, path in first.levels])
    later.add(S.suffix_rows(scan.where(F.col("doc_id") >= half)))
    keys = ws.put(earlier.union(later.hit_keys()).distinct())
    rows = S.hit_spans(ws, docs, scan, keys, length, S.GROUP).orderBy("doc_id").collect()
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows] == brute(texts, length)


def test_bytes_decide_not_hashes(spark):
    """Thue-Morse words and their complements collide in polynomials modulo
    2**64; here they must stay apart, and equal keys of unlike grams too."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba")), "x" + word[:1024], "y" + word[1024:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = S.remove_repeats(docs, length=400).orderBy("doc_id").collect()
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows] == brute(texts, 400)
    bodies = [b"12" + b"gram" + b"12345678", b"12" + b"marg" + b"12345678", b"02" + b"gram" + b"12345678"]
    out = S.repeated_offsets(bodies, np.array([2, 2, 2]), 12)
    assert out[:, 0].tolist() == [True, False, True] and out[:, 1].tolist() == [True, False, True]
    assert not out[:, 2:].any()
    for offset, have, value in S.window_classes(bodies, np.array([2, 2, 2]), 12):
        same = [bool((value == v).sum() > 1) for v in value]
        assert same == out[have, offset].tolist()
