import random

import numpy as np
import pytest

from encore.llm import ngram_jaccard as J
from encore.llm.ngram_jaccard import ngram_components
from encore.llm.text import word_hashes

WORD = "the of and to in cat dog sun moon tree river stone cloud leaf bird fish".split()


def sets_of(text, k):
    import re

    words = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)])


def brute(rows, k, t):
    sets = [(i, sets_of(x, k)) for i, x in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1:]:
            if x and y and 100 * len(x & y) >= t * len(x | y):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return sorted((i, len(x), find(i)) for i, x in sets)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(WORD) if rng.random() < 0.5 else "w%d" % rng.randrange(500)
    rows, n = [], 0
    rows += [(n := n + 1, x) for x in (None, "", " \t\n", "one", "One", "one two", "ONE  two", "one two three", "É x y")]
    for _ in range(25):
        base = [word() for _ in range(rng.choice([4, 9, 11, 13, 21, 26, 31, 60, 140, 400]))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 15))):
                at = rng.randrange(len(copy))
                edit = rng.random()
                if edit < 0.4:
                    copy[at] = word()
                elif edit < 0.7:
                    copy.insert(at, word())
                elif len(copy) > 2:
                    del copy[at]
            text = " ".join(copy)
            rows.append((n := n + 1, text.upper() if rng.random() < 0.2 else text))
    passage = [word() for _ in range(60)]
    for _ in range(25):
        rows.append((n := n + 1, " ".join([word() for _ in range(rng.randrange(40))] + passage)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "k", "t", "block"), [(1, 3, 90, 512), (2, 5, 80, 4), (3, 2, 60, 2)])
def test_equals_brute_force(spark, monkeypatch, seed, k, t, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, x, "a", i) for i, x in rows], "doc_id long, text string, n string, id long")
    got = sorted(tuple(r)[:3] for r in J.ngram_components(docs, k=k, t=t).collect())
    assert got == brute(rows, k, t)


def test_empty_table_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert J.ngram_components(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d"), (4, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, None)]
    got = J.ngram_components(spark.createDataFrame(rows, schema), k=3, t=90).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got if r["doc_id"]) == [(4, 4), (7, 4), (7, 4)]
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None, None]


def test_boundary_follows_cost():
    assert J.boundary({12: 100, 500: 10}, 90, 0.0) == 1 or J.light_cost(12, 90) <= J.heavy_cost(12, 90, 0.0)
    assert J.boundary({12: 100, 500: 10}, 90, 100.0) > 12
    assert J.boundary({40: 100}, 80, 1.0) <= 40


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 400), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 63, 20, dtype=np.uint64)]))
        p, q = J.bitmap(a), J.bitmap(b)
        w = min(len(p), len(q))
        differ = int(np.bitwise_count(J.fold(p, w) ^ J.fold(q, w)).sum())
        assert differ <= len(np.setxor1d(a, b))


def test_bitmaps_tell_sets_that_share_much_apart():
    """Sets of one base that are a little too far apart to link: no pair of
    them is a candidate, whatever their number."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 700, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(700) < 0.91], rng.integers(0, 1 << 63, 63, dtype=np.uint64)])) for _ in range(40)]
    maps = [J.bitmap(s) for s in sets]
    near = [(i, j) for i in range(40) for j in range(i)]
    assert not any(180 * len(np.intersect1d(sets[i], sets[j])) >= 80 * (len(sets[i]) + len(sets[j])) for i, j in near)
    assert not any(J.may_link(len(sets[i]), len(sets[j]), int(np.bitwise_count(maps[i] ^ maps[j]).sum()), 80) for i, j in near)


def test_lists_with_the_same_members_are_compared_once(spark):
    lists = {1: [7, 8, 9], 2: [9, 8, 7], 3: [7, 8], 4: [7, 7, 8, 9], 5: [8, 8, 7, 9], 6: [7, 8, 9], 7: [20, 21], 8: [-7, 3], 9: [3, -7]}
    rows = [(token, i, 100, 20 if i > 19 else i) for token, ids in lists.items() for i in ids]
    rows += [(10, 7, 100, 7), (10, 8, 101, 8)]  # another size is another member
    members = spark.createDataFrame(rows, "token long, id long, n int, comp long")
    assert sorted(r["token"] for r in J.lists_to_compare(members).collect()) == [1, 3, 4, 5, 8, 10]


def test_pairs_too_far_apart_are_no_candidates(spark, monkeypatch):
    """Texts that share most shingles, but too few to link, meet in many lists;
    no pair of them goes on to the exact count."""
    emitted = []
    put = J.Workspace.put

    def counted(self, df, *args, **options):
        out = put(self, df, *args, **options)
        emitted.append((out.columns, out.count(), options))
        return out

    monkeypatch.setattr(J.Workspace, "put", counted)
    base = [f"w{i}" for i in range(700)]
    rows = []
    for m in range(11):
        words = list(base)
        for at in range(5 * m, 700, 58):  # five shingles each
            words[at] = f"edit{m}x{at}"
        rows.append((m, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.ngram_components(docs, k=5, t=80, links=False).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(m, m) for m in range(11)]
    assert [n for columns, n, options in emitted if options == {"text_batch": 4096}] == [0]


def test_sketch_blocks_round_trip():
    rng = np.random.default_rng(1)
    for share in (0.0, 0.01, 0.9):
        cells = (rng.integers(1, 1 << 32, J.CELLS_PER_BLOCK) * (rng.random(J.CELLS_PER_BLOCK) < share)).astype(np.uint32)
        assert (J.unpack_cells(J.pack_cells(cells)) == cells).all()


def links_of(rows, k, t):
    sets = [(i, sets_of(x, k)) for i, x in rows]
    return sorted((i, sum(1 for a, (_, y) in enumerate(sets) if a != b and x and y and 100 * len(x & y) >= t * len(x | y)))
                  for b, (i, x) in enumerate(sets))


def group_of_near_copies(seed, members):
    rng = random.Random(seed)
    out = []
    for size in (12, 150):
        base = [rng.choice(WORD) + str(rng.randrange(300)) for _ in range(size)]
        for m in range(members):
            out.append(" ".join([*base[:size // 2], *base[size // 2 + 1 + m % 2:], f"edit{m}"]))
    return out


@pytest.mark.parametrize(("seed", "k", "t", "block", "held"), [(1, 3, 90, 1024, 1 << 27), (2, 5, 80, 7, 1 << 27), (3, 2, 60, 3, 0)])
def test_links_equal_brute_force(spark, monkeypatch, seed, k, t, block, held):
    monkeypatch.setattr(J, "COUNT_SETS", block)
    monkeypatch.setattr(J, "COUNT_BYTES", held)
    rows = corpus(seed)
    rows += [(1000 + i, x) for i, x in enumerate(group_of_near_copies(seed, 30))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_links"]) for r in J.ngram_components(docs, k=k, t=t).collect())
    assert got == links_of(rows, k, t)


def test_all_links_of_a_group_are_counted(spark):
    base = [f"w{i}" for i in range(300)]
    rows = [(m, " ".join([*base, f"edit{m}"])) for m in range(40)]
    got = J.ngram_components(spark.createDataFrame([*rows, (None, rows[0][1])], "doc_id long, text string"), k=3, t=90).collect()
    assert sorted((r["n_links"], r["doc_id"] is None) for r in got) == [(0, True)] + [(39, False)] * 40


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("size", [64, 1024, 2048, 8192, 1 << 19])
def test_patterns_that_defeat_power_of_two_hashes(spark, size):
    one = thue_morse(size)
    two = one.translate(str.maketrans("ab", "ba"))
    texts = [one, two, f"{one} x y", f"{two} x y", f"p {one} x", f"p {two} x", one.upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_components(docs, k=3, t=90).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 0}


def test_words_of_long_texts_hash_alike_in_any_place():
    words = [f"w{i}" for i in range(90_000)] + ["z" * 5000, "z" * 5001, "é" * 3000]
    whole = word_hashes([" ".join(words).encode()])[0]
    alone = word_hashes([w.encode() for w in words])
    assert whole.tolist() == [int(a[0]) for a in alone] and len(set(whole.tolist())) == len(words)


def test_without_link_counts(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "A b  c"), (3, None)], "doc_id long, text string")
    got = ngram_components(docs, k=3, t=90, links=False)
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and sorted(map(tuple, got.collect())) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]
