import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from encore.llm import simhash as S
from encore.llm.common import Workspace
from encore.llm.queries import op12_simhash, table

from .test_queries import MID


def fp_of(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    m = min(3, len(words))
    hashes = [xxh64_intdigest(" ".join(words[i:i + m]).encode(), 42) for i in range(len(words) - m + 1)]
    bits = np.array(hashes, dtype=np.uint64)[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)
    return sum(1 << b for b, n in enumerate(bits.sum(axis=0).tolist()) if 2 * n > len(hashes))


def components(prints):
    """Smallest id reachable over pairs at most two bits apart."""
    up = list(range(len(prints)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                up[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(prints))]


def brute(rows):
    prints = [fp_of(t) for _, t in rows]
    least = {}
    comp = components(prints)
    for (i, _), c in zip(rows, comp, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((i, f"{p:016x}", least.get(c)) for (i, _), p, c in zip(rows, prints, comp, strict=True)), key=str)


def corpus():
    rng = random.Random(8)
    words = [f"W{i}" for i in range(60)] + ["é", "😀x", "ÀB", "to"]
    texts = [None, "", " \n\t", "a", "A", "a b", "a  B", "a b c", "A\tB\nc", "x " * 500]
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randrange(1, 150))]
        texts.append(" ".join(base))
        for _ in range(3):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(words)
            texts.append("  ".join(near))
    return [(i, t) for i, t in enumerate(texts)] + [(None, "a b c"), (None, "only here it is"), (3, "a"), (3, "a")]


def test_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, fp string, comp int, path int")
    assert sorted((tuple(r) for r in S.simhash_components(docs).collect()), key=str) == brute(rows)


def test_long_text_is_hashed_whole():
    rng = random.Random(5)
    text = " ".join(str(rng.randrange(10 ** 6)) for _ in range(150_000))
    words = text.split()
    hashes = np.array([xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(len(words) - 2)], dtype=np.uint64)
    want = sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(hashes))
    assert S.fingerprint(text.encode()) == want


@pytest.mark.parametrize("most", [4096, 40, 3])
def test_links_in_dense_groups(spark, most, monkeypatch):
    """Many fingerprints that share most bits: nodes are split, nothing is lost."""
    monkeypatch.setattr(S, "FRONT", 512)
    rng = random.Random(most)
    seeds = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    prints = {0, (1 << 64) - 1}
    for s in seeds:
        for _ in range(120):
            prints.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))))
        for _ in range(60):
            prints.add(s ^ rng.getrandbits(12))
    prints = sorted(prints)
    fps = spark.createDataFrame([(S._signed(p),) for p in prints], "fp long")
    edges = S.near_links(Workspace(spark, "test"), fps, most=most).collect()
    at = {S._signed(p): i for i, p in enumerate(prints)}
    up = list(range(len(prints)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        up[max(top(at[a]), top(at[b]))] = min(top(at[a]), top(at[b]))
    assert [top(i) for i in range(len(prints))] == components(prints)


def test_tree_finds_every_pair():
    rng = np.random.default_rng(3)
    for n in (1, 2, 17, 300):
        fp = np.unique(rng.integers(0, 1 << 11, n).astype(np.uint64) << np.uint64(3))
        fp = np.concatenate((fp, fp + np.uint64(1 << 40)))
        start = np.array([0, len(fp) // 2])
        node = np.repeat([0, 1], len(fp) // 2)
        a, b = S.GrayTree(fp, start).links(node, 2)
        want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if node[i] == node[j] and (int(fp[i]) ^ int(fp[j])).bit_count() <= 2}
        assert set(zip(a.tolist(), b.tolist(), strict=True)) == want and len(a) == len(want)


def test_gray_rank(spark):
    codes = [i ^ (i >> 1) for i in range(64)]
    got = spark.createDataFrame([(c,) for c in codes], "fp long").select(S.gray_rank(S.F.col("fp"))).collect()
    assert [r[0] for r in got] == list(range(64))


def test_registered_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, MID, "documents").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op12_simhash(spark, MID).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert S.simhash_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []
