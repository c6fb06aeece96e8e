import hashlib
import random
import re
import zlib

import pytest

from encore.llm import conversation_trie as C
from encore.llm.queries import op11_conversation_trie, table

from .test_queries import COLUMNS, MID

SCHEMA = "conv_id long, turn long, role string, text string"


def own(rows):
    out = {}
    for c, t, r, x in rows:
        if c is not None:
            out.setdefault(c, []).append((t, r or "", x or ""))
    key = lambda v: (v[0] is not None, v[0] or 0, v[1], hashlib.sha256(f"{len(v[1])}:{v[1]}{v[2]}".encode()).digest())
    return {c: [(r, x) for _, r, x in sorted(v, key=key)] for c, v in out.items()}


def rebuilt(rows):
    at = own(rows)
    out = {}
    for c, turns in at.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = at.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    """Rows of the trie by sets of prefixes."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = (len(nodes[p]) - 1) * words + sum(saved[k] for k in kids.get(p, []))
    out = []
    for p, members in nodes.items():
        ends = sorted(c for c in members if len(convs[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[1]))


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[0], r[1]))


def corpus(seed):
    rng = random.Random(seed)
    said = ["hi", "hi  there", "", None, "a b c", "\t x\ny ", "é  z", "1:x", "word " * 300]
    rows = []
    for c in [*range(-25, 60), 200, 205, 219]:
        if rng.random() < 0.15:
            continue
        n = rng.choice([1, 1, 2, 3, 5, 9])
        for t in range(n):
            turn = rng.choice([t, t, t, None, 2])
            rows.append((c, turn, rng.choice(["user", "assistant", None, "", "u"]), rng.choice(said[:3] if t < 2 else said)))
    same = [(t, "user", "same old words") for t in range(7)]
    rows += [(c, *x) for c in range(300, 360) for x in same[:7 if c % 3 else 4]]
    rows += [(None, 1, "user", "nobody's"), rows[0]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("segment", "block"), [(2048, 100_000), (2048, 5), (3, 6), (1, 1)])
def test_equals_brute_force(spark, segment, block):
    rows = corpus(segment * 7 + block)
    table = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(C.rebuilt_trie(table, segment=segment, block=block)) == brute(rebuilt(rows))


def test_one_long_conversation(spark):
    """A third of all rows in one conversation, over several layers."""
    rows = [(7, t, "user", f"w{t % 5}") for t in range(900)] + [(40 + t, k, "user", f"w{k}") for t in range(300) for k in range(4)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(C.conversation_trie(table, segment=64, block=200)) == brute(own(rows))


def test_empty_table_clashing_columns_and_lone_rows(spark):
    assert C.rebuilt_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert C.rebuilt_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []
    extra = ", depth int, tid string, key string, words int, part int, ord long, n_convs int, layer int, more boolean"
    rows = [(3, 1, None, None), (20, None, None, None)]
    table = spark.createDataFrame([(*r, 1, "x", "y", 2, 3, 4, 5, 6, True) for r in rows], SCHEMA + extra)
    assert rows_of(C.rebuilt_trie(table)) == brute(rebuilt(rows))


def test_tree_is_balanced():
    tree = C.Tree()
    for i in C._balanced(1000):
        tree.insert([0, i], 1, i)
    depth = {}
    for x in range(1, len(tree.sym)):
        for side in (tree.lo[x], tree.hi[x]):
            if side > 0:
                depth[side] = depth.get(x, 0) + 1
    assert max(depth.values()) <= 10


def test_registered_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, MID, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = op11_conversation_trie(spark, MID)
    assert got.columns == COLUMNS["op11"].split()
    assert rows_of(got) == brute(rebuilt(rows))
