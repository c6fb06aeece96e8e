"""Near duplicates by SimHash fingerprints in a Gray-order hierarchical index.

A text's fingerprint has a bit where more than half of its word shingles'
hashes (XXH64, repeats included) have it.  Fingerprints link when they differ
in at most two of the 64 bits; documents with one fingerprint are one row from
the start.

The index is a tree of masked bit patterns over the distinct fingerprints:

* upper nodes: two fingerprints with at most two differences agree on at least
  one third of any set of bits.  So every fingerprint goes under three nodes,
  one per third (the third's mask and its own bits under it), and a search
  enters only nodes it has no difference to.  A node with more than ``most``
  fingerprints is not searched but split: its free bits are cut in thirds
  again.  A node at the fourth level has 13 free bits, so at most 8192
  fingerprints: no node that is searched is larger than that, whatever the
  data;
* lower nodes: the fingerprints of an upper node are sorted by their rank in
  the Gray code, where neighbours differ in few bits, and runs of ``FAN`` make
  a node, level by level.  A node factors out the bits that all below it share
  (mask and pattern).  A search adds up the differences on the bits that are
  new at each node and leaves out the whole group once they exceed two; what
  reaches a leaf has been compared on all bits.

Each node's links are folded to one row per fingerprint (the smallest one of
its component there) before they leave the task; the components of these links
are the components of all links.

Defined cases: A-Z are lower-cased; texts with fewer words than ``k`` have one
shingle, the whole sequence; null, empty and blank texts have fingerprint
zero, which links like any other; repeated rows come back as often; rows with
a null id are linked, and named by the smallest id reachable (null, if there
is none); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import Workspace, components, grouped, keep_ids, texts_of
from encore.llm.text import cut_at_white

SEED = 42
#: Fingerprints that differ in at most this many bits link.
DISTANCE = 2
#: Nodes below a node of the lower tree.
FAN = 16
#: Fingerprints of an upper node that is searched as it is.
MOST = 4096
#: Pairs of a query and a node that are looked at side by side.
FRONT = 1 << 20
#: Fingerprints searched side by side, whole nodes of them.
CHUNK = 1 << 16


def fingerprint(text: bytes, k: int = 3) -> int:
    """SimHash of a text; its words are worked through in pieces."""
    from xxhash import xxh64_intdigest

    ones, total = np.zeros(64, np.int64), 0
    words: list[bytes] = []
    for piece in cut_at_white(text):
        words += piece.lower().split()  # bytes: A-Z, and white space as the contract has it
        if len(words) < k:
            continue
        body = b" ".join(words)
        end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        begin = (end - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
        hashes = np.array([xxh64_intdigest(body[a:b], SEED) for a, b in zip(begin, (end[k - 1:] - 1).tolist())], dtype="<u8")  # noqa: B905 (begins without an end are left over)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
        words = words[-(k - 1):] if k > 1 else []
    if not total:
        return xxh64_intdigest(b" ".join(words), SEED) if words else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _fingerprints(k: int):
    def run(batches):
        for batch in batches:
            values = np.array([fingerprint(t, k) for t in texts_of(batch)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(values, pa.int64())], ["doc_id", "fp"])

    return run


def gray_rank(fp: Column) -> Column:
    """Place of a bit pattern in the sequence of the Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def thirds(mask: int) -> list[int]:
    """Masks of the thirds of the bits that ``mask`` leaves free."""
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    size = [len(free) // 3 + (i < len(free) % 3) for i in range(3)]
    cuts = [0, size[0], size[0] + size[1], len(free)]
    return [sum(1 << b for b in free[cuts[i]:cuts[i + 1]]) for i in range(3)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _under(rows: DataFrame, paths: dict[str, int]) -> tuple[DataFrame, dict[str, int]]:
    """Every fingerprint under the three nodes below its node: (fp, path,
    pattern); and the masks of the new paths."""
    masks = {f"{path}{i}": mask | third for path, mask in paths.items() for i, third in enumerate(thirds(mask))}
    at = F.create_map(*[x for path in paths for x in (
        F.lit(path), F.array(*[F.struct(F.lit(f"{path}{i}").alias("path"), F.lit(_signed(masks[f"{path}{i}"])).alias("mask")) for i in range(3)]))])
    below = rows.select("fp", F.explode(F.element_at(at, F.col("path"))).alias("n"))
    return below.select("fp", F.col("n.path").alias("path"), F.col("fp").bitwiseAND(F.col("n.mask")).alias("pattern")), masks


_ALL = ~np.uint64(0)


class GrayTree:
    """The lower trees of some upper nodes, side by side.  ``fp``: the
    fingerprints, sorted by upper node and Gray rank; ``start``: where each
    upper node begins."""

    def __init__(self, fp: np.ndarray, start: np.ndarray):
        self.fp = fp
        end = np.append(start[1:], len(fp))
        # levels from the leaves up: mask and pattern of each node, its first and last child, the last fingerprint below it
        mask, pattern = np.full(len(fp), _ALL), fp
        self.levels = [(mask, pattern, None, None, np.arange(len(fp)))]
        tail = np.arange(len(fp))
        while True:
            count = end - start
            groups = -(-count // FAN)
            first = np.repeat(start, groups) + FAN * (np.arange(groups.sum()) - np.repeat(np.cumsum(groups) - groups, groups))
            last = np.minimum(first + FAN, np.repeat(end, groups))
            both = np.bitwise_and.reduceat(pattern & mask, first), np.bitwise_or.reduceat(pattern | ~mask, first)
            shared = np.bitwise_and.reduceat(mask, first) & ~(both[0] ^ both[1])
            mask, pattern, tail = shared, both[0] & shared, tail[last - 1]
            self.levels.append((mask, pattern, first, last, tail))
            start = np.cumsum(groups) - groups
            end = start + groups
            if (groups == 1).all():
                break
        self.roots = start  # of each upper node

    def links(self, node_of: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places (a < b) of one upper node at most ``distance`` apart."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        top = len(self.levels) - 1
        begin = 0
        step = max(1, FRONT // FAN)
        while begin < len(self.fp):
            query = np.arange(begin, min(begin + step, len(self.fp)))
            stack = [(top, query, self.roots[node_of[query]], np.zeros(len(query), np.uint64), np.zeros(len(query), np.uint8))]
            while stack:
                level, q, at, known, apart = stack.pop()
                mask, pattern, first, last, tail = self.levels[level]
                apart = apart + np.bitwise_count((self.fp[q] ^ pattern[at]) & mask[at] & ~known)
                keep = (apart <= distance) & (tail[at] > q)  # pairs are met from their first place
                q, at, apart = q[keep], at[keep], apart[keep]
                if not len(q):
                    continue
                if level == 0:
                    found.append((q, at))
                    continue
                many = last[at] - first[at]
                row = np.repeat(np.arange(len(q)), many)
                child = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + first[at][row]
                known = mask[at][row]
                for i in range(0, len(row), FRONT):
                    part = slice(i, i + FRONT)
                    stack.append((level - 1, q[row[part]], child[part], known[part], apart[row[part]]))
            begin += step
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def fold(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place of each place's component."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[a], least[b])
        now = least.copy()
        np.minimum.at(now, least[a], low)
        np.minimum.at(now, least[b], low)
        while not np.array_equal(now, hop := now[now]):
            now = hop
        if np.array_equal(now, least):
            return least
        least = now


def _search(distance: int):
    """Links of whole upper nodes, folded: (a, b)."""
    def links(tables: list[pa.Table]) -> pa.RecordBatch | None:
        sizes = np.array([t.num_rows for t in tables])
        fp = np.concatenate([t.column("fp").to_numpy() for t in tables]).view(np.uint64)
        node_of = np.repeat(np.arange(len(sizes)), sizes)
        a, b = GrayTree(fp, np.cumsum(sizes) - sizes).links(node_of, distance)
        least = fold(len(fp), a, b)
        rows = np.flatnonzero(least != np.arange(len(fp)))
        value = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(value[rows]), pa.array(value[least[rows]])], ["a", "b"]) if len(rows) else None

    def run(batches):
        held: list[pa.Table] = []
        size = 0
        for table in grouped(batches, ["path", "pattern"]):
            if table.num_rows == 1:
                continue
            held.append(table)
            size += table.num_rows
            if size >= CHUNK:
                if out := links(held):
                    yield out
                held, size = [], 0
        if held and (out := links(held)):
            yield out

    return run


def near_links(ws: Workspace, fps: DataFrame, distance: int = DISTANCE, most: int = MOST) -> DataFrame:
    """(a, b): links between distinct fingerprints, enough of them to have
    the components of all links.  ``fps``: distinct ``fp``."""
    if distance > 2:
        raise ValueError("thirds find pairs of up to two differences")
    rows, paths = fps.select("fp", F.lit("").alias("path")), {"": 0}
    edges = []
    for level in range(1, 5):
        rows, paths = _under(rows, paths)
        rows = ws.put(rows)
        if level < 4:
            large = ws.put(rows.groupBy("path", "pattern").agg(F.count("*").alias("n")).where(F.col("n") > most).select("path", "pattern"))
            split = not large.isEmpty()
        else:
            split = False
        small = keep_ids(rows, large, ["path", "pattern"], "left_anti") if split else rows
        dealt = small.withColumn("rank", gray_rank(F.col("fp"))).repartition("path", "pattern").sortWithinPartitions("path", "pattern", "rank")
        edges.append(ws.put(dealt.select("path", "pattern", "fp").mapInArrow(_search(distance), "a long, b long"), text_batch=10_000))
        if not split:
            break
        rows = ws.put(keep_ids(rows, large, ["path", "pattern"]))
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return out


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, distance: int = DISTANCE,
                       most: int = MOST) -> DataFrame:
    """Returns (id_col, fingerprint as 16 hexadecimal digits, component_id)."""
    ws = Workspace(docs.sparkSession, "simhash")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = ws.put(rows.mapInArrow(_fingerprints(k), "doc_id long, fp long"))
    nodes = ws.put(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    stars = ws.put(components(ws, near_links(ws, nodes.select("fp"), distance, most)).select(F.col("id").alias("fp"), "comp"))
    named = ws.put(nodes.join(stars, "fp", "left").withColumn("comp", F.coalesce("comp", "fp")))
    ids = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    labels = ws.put(named.join(ids, "comp").select("fp", "component_id"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(labels, "fp").select(F.col("doc_id").alias(id_col), digits.alias("fingerprint"), "component_id")
