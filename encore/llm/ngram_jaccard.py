"""Near-duplicate documents: size-aware heavy-light Jaccard join on word n-grams.

A document's set holds its distinct k-word shingles (A-Z lower-cased; fewer
than k words: the whole sequence as one shingle).  Two documents link when
``100 * |A & B| >= t * |A | B|``.

1. *Exact copies of a set* collapse to one representative by a 128-bit set
   fingerprint, so a group of copies is one row from here on.
2. *Order.*  Two count sketches over all documents, of shingles and of words
   (fixed size, summed per block of cells), give every shingle a frequency
   class: the larger of its own count above the sketch's noise, which finds
   passages that many documents share, and of the count that its words'
   frequencies make likely, which finds chance combinations of common words
   at any corpus size.  The order (class, hash) puts both last.  It only
   steers cost: any one order gives the same links.
3. *Light sets* (fewer than x shingles) emit one key per subset that a linked
   partner may share: all subsets with at most ``n - ceil(t n)`` elements
   left out.  Sets that meet on a key of s elements link when s is enough for
   their sizes; linking each to the smallest set of the key keeps the
   component whole.
4. *Heavy sets* scan inverted lists: a linked pair shares one of the first
   ``n - ceil(t n) + 1`` shingles of either set in that order, so only those
   are listed.  The boundary x is the cheapest by estimated emitted rows:
   subsets against list entries times the mean length of the lists they meet.
5. *First pass over the lists:* every member meets three fixed members of its
   list (linear in the list).  An upper bound on the overlap from bitmaps
   (two sets differ in at least as many elements as their bitmaps in bits;
   a bit is the parity of its cell, so what both sets have cancels and hides
   nothing) and then the exact count decide.
6. *Second pass:* lists whose members are not one component yet are compared
   in blocks of about BLOCK members, all block pairs in parallel; of lists with
   the same members, which hold the same pairs, one is compared.  Only pairs
   of different components that pass sizes and bitmaps are emitted, and
   verified exactly.  Nothing is capped: a list of any length is compared
   whole, and a group whose members the first pass joined costs nothing here.
7. *Counting.*  Linked sets are in one component, so the links of a set are
   counted there.  Where steps 3 to 6 verified every pair of a component, they
   are the count; the sets of any other component are compared in blocks, all
   block pairs in parallel and every pair in one of them, by exact overlap.
   Only counts per set leave a block, never pairs.

Defined cases: a null or empty text, or one of white space, has no shingle,
links with nothing and is its own component.  Rows with equal id and text are
copies; a row with a null id has a null component and takes no part.  Columns
other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import Workspace, components, grouped, keep_ids, maybe_small, texts_of, tidy
from encore.llm.text import mix, shingle_hashes, shingles, word_hashes

#: Cells of the count sketches (one byte each where they are broadcast).
SKETCH_BITS = 22
WORD_BITS = 20
CELLS_PER_BLOCK = 4096
#: Sets of this many shingles or more are always heavy.
MAX_LIGHT = 64
BLOCK = 512
#: Sets and shingles of a block, on average, where links are counted.
COUNT_SETS = 512
COUNT_SHINGLES = 1 << 17
#: Bytes of bit rows that counting holds; beyond that it looks shingles up.
COUNT_BYTES = 32 << 20
LEAST_BITS = 1024
#: Longest inverted list whose members are put in order of size in one task.
WINDOWED = 1000
#: Steps of a frequency class per doubling.
STEPS = 4


def least_overlap(n: int, t: int) -> int:
    """Fewest elements that a partner shares with a set of n elements."""
    return -(-t * n // 100)


def light_cost(n: int, t: int) -> int:
    return sum(comb(n, d) for d in range(n - least_overlap(n, t) + 1))


def heavy_cost(n: int, t: int, mean_list: float) -> float:
    return (n - least_overlap(n, t) + 1) * (1 + mean_list)


def boundary(sizes: dict[int, int], t: int, mean_list: float) -> int:
    """The x in 1..MAX_LIGHT with the least estimated cost: sets under x emit
    subsets, sets of ceil(t x) elements or more are listed."""

    def cost(x: int) -> float:
        return sum(c * light_cost(n, t) for n, c in sizes.items() if n < x) + sum(
            c * heavy_cost(n, t, mean_list) for n, c in sizes.items() if n >= least_overlap(x, t))

    return min(range(1, MAX_LIGHT + 1), key=lambda x: (cost(x), x))


def _cell(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _word_cell(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - WORD_BITS)).astype(np.int64) + (1 << SKETCH_BITS)


def _new_sketch(kind) -> np.ndarray:
    """Cells of the shingles, then of the words."""
    return np.zeros((1 << SKETCH_BITS) + (1 << WORD_BITS), dtype=kind)


def pack_cells(cells: np.ndarray) -> bytes:
    """Counters of one block, small ones as bytes, deflated."""
    large = np.flatnonzero(cells >= 255)
    body = np.minimum(cells, 255).astype(np.uint8).tobytes() + large.astype("<u2").tobytes() + cells[large].astype("<u4").tobytes()
    return zlib.compress(body, 1)


def unpack_cells(data: bytes) -> np.ndarray:
    body = zlib.decompress(data)
    out = np.frombuffer(body, np.uint8, CELLS_PER_BLOCK).astype(np.uint64)
    n = (len(body) - CELLS_PER_BLOCK) // 6
    out[np.frombuffer(body, "<u2", n, CELLS_PER_BLOCK)] = np.frombuffer(body, "<u4", n, CELLS_PER_BLOCK + 2 * n)
    return out


def _fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over the set (any order, signed)."""
    a = mix(tokens).sum(dtype=np.uint64)
    b = mix(tokens ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _words(batches, id_col: str, text_col: str):
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index(id_col)).to_pylist()
        yield from zip(ids, word_hashes(texts_of(batch, text_col)), strict=True)


PROFILE = "id long, n int, f1 long, f2 long, block int, cells binary"


def _profile(id_col: str, text_col: str, k: int):
    @tidy
    def run(batches):
        sketch = _new_sketch(np.uint32)
        rows: list[tuple] = []

        def out():
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            nulls = [None] * len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int64()), pa.array(nulls, pa.int32()), pa.array(nulls, pa.binary())],
                ["id", "n", "f1", "f2", "block", "cells"])

        for i, words in _words(batches, id_col, text_col):
            tokens = shingles(words, k)
            rows.append((i, len(tokens), *_fingerprint(tokens)))
            np.add.at(sketch, _cell(tokens), 1)
            np.add.at(sketch, _word_cell(words), 1)
            if len(rows) >= 10_000:
                yield out()
                rows = []
        if rows:
            yield out()
        sketch = sketch.reshape(-1, CELLS_PER_BLOCK)
        every = np.flatnonzero(sketch.any(axis=1)).tolist()
        for at in range(0, len(every), 256):
            blocks = every[at:at + 256]
            none = pa.nulls(len(blocks), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, pa.nulls(len(blocks), pa.int32()), none, none, pa.array(blocks, pa.int32()),
                 pa.array([pack_cells(sketch[b]) for b in blocks], pa.binary())],
                ["id", "n", "f1", "f2", "block", "cells"])

    return run


def _add_cells(batches):
    """Sum of the cells of each block, as steps of the logarithm (one byte per
    cell); a partition holds whole blocks."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = unpack_cells(cells)
            total[b] = total[b] + part if b in total else part
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([_steps(v).tobytes() for v in total.values()], pa.binary())],
            ["block", "cells"])


INDEX = "id long, n int, f1 long, f2 long, prefix array<long>, bitmap binary, keys array<struct<k1:long,k2:long,s:int>>"


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Parity of the elements in each hash cell, at least as many cells as
    elements.  Bits of two sets differ where an odd number of the elements of
    one set alone fall, whatever they have in common."""
    bits = LEAST_BITS
    while bits < len(tokens):
        bits *= 2
    on = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(on.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap that the same set has with fewer words."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def may_link(n_a, n_b, differ, t: int):
    """Whether sets of these sizes that differ in at least ``differ``
    elements can link: overlap is at most (n_a + n_b - differ) / 2."""
    top = (n_a + n_b - differ) // 2
    return (100 + t) * top >= t * (n_a + n_b)


def _subset_keys(tokens: np.ndarray, t: int) -> list[tuple[int, int, int]]:
    """(key, key, size) of every subset that leaves out at most n - ceil(t n)
    elements; keys are sums, so leaving out is subtracting."""
    one, two = mix(tokens), mix(tokens ^ np.uint64(0x9E3779B97F4A7C15))
    n = len(tokens)
    level = [(int(one.sum(dtype=np.uint64)), int(two.sum(dtype=np.uint64)), 0)]
    out, full = [], (1 << 64) - 1
    values = list(zip(one.tolist(), two.tolist(), strict=True))
    for left_out in range(n - least_overlap(n, t) + 1):
        size = n - left_out
        if size:
            out += [((a + size) & full, b, size) for a, b, _ in level]
        level = [((a - values[i][0]) & full, (b - values[i][1]) & full, i + 1)
                 for a, b, first in level for i in range(first, n)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    return [(signed(a), signed(b), s) for a, b, s in out]


def _steps(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.round(STEPS * np.log2(counts.astype(np.float64) + 1)), 255).astype(np.uint8)


def frequency_classes(steps: np.ndarray) -> tuple[np.ndarray, float, float]:
    """From the sketches in steps of the logarithm: one byte per cell (steps of
    the count above the noise for shingles, of the count for words), log2 of
    all words, and the mean number of other sets that a shingle of a quiet
    cell is likely to be met in."""
    value = 2.0 ** (np.arange(256) / STEPS) - 1  # count of a step
    own = np.bincount(steps[:1 << SKETCH_BITS], minlength=256)
    words = np.bincount(steps[1 << SKETCH_BITS:], minlength=256)
    middle = value[int(np.searchsorted(np.cumsum(own), own.sum() / 2))]
    noise = middle + 6 * np.sqrt(middle + 1)
    table = np.round(STEPS * np.log2(np.maximum(value - noise, 1))).astype(np.uint8)
    classes = np.concatenate([table[steps[:1 << SKETCH_BITS]], steps[1 << SKETCH_BITS:]])
    quiet = np.where(value <= noise, own, 0)
    total, cells = float((quiet * value).sum()), max(1, int(quiet.sum()))
    met = float((quiet * value**2).sum()) / total - total / cells - 1 if total else 0.0
    return classes, float(np.log2(max((words * value).sum(), 1))), max(0.0, met)


def ordered(words: np.ndarray, k: int, classes: np.ndarray, log_total: float) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingles, their frequency classes)."""
    tokens = shingle_hashes(words, k)
    m = min(k, len(words))
    common = classes[_word_cell(words)].astype(np.float64)
    likely = np.full(len(tokens), -(m - 1) * STEPS * log_total)
    for j in range(m):
        likely += common[j:len(words) - m + 1 + j]
    order = np.argsort(tokens)
    tokens, likely = tokens[order], likely[order]
    first = np.concatenate(([True], tokens[1:] != tokens[:-1]))
    tokens = tokens[first]
    return tokens, np.maximum(classes[_cell(tokens)], np.maximum(likely[first], 0)).astype(np.int64)


def _index(id_col: str, text_col: str, k: int, t: int, x: int, classes):
    listed = least_overlap(x, t)

    @tidy
    def run(batches):
        kind = pa.struct([("k1", pa.int64()), ("k2", pa.int64()), ("s", pa.int32())])
        rows: list[tuple] = []

        def out():
            c = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.int64()),
                 pa.array(c[4], pa.list_(pa.int64())), pa.array(c[5], pa.binary()), pa.array(c[6], pa.list_(kind))],
                ["id", "n", "f1", "f2", "prefix", "bitmap", "keys"])

        for i, words in _words(batches, id_col, text_col):
            if not len(words) or i is None:
                continue
            tokens, rank = ordered(words, k, *classes.value)
            n = len(tokens)
            prefix = np.empty(0, np.uint64)
            if n >= listed:
                # classes first, hashes within a class: the tokens are sorted by hash
                prefix = tokens[np.argsort(rank, kind="stable")[:n - least_overlap(n, t) + 1]]
            keys = [dict(k1=a, k2=b, s=s) for a, b, s in _subset_keys(tokens, t)] if n < x else []
            rows.append((i, n, *_fingerprint(tokens), prefix.view(np.int64), bitmap(tokens).tobytes(), keys))
            if len(rows) >= 1000:
                yield out()
                rows = []
        if rows:
            yield out()

    return run


def _bitmap_filter(t: int):
    """Pairs (a, b, na, nb, ma, mb) that sizes and bitmaps allow."""

    @tidy
    def run(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
            keep = np.zeros(len(na), dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                w = min(len(p), len(q))
                keep[i] = may_link(na[i], nb[i], int(np.bitwise_count(fold(p, w) ^ fold(q, w)).sum()), t)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])

    return run


def _block_pairs(t: int, x: int):
    """Rows of one (token, block pair) after another: emits the pairs of
    different components that sizes and bitmaps allow."""

    @tidy
    def run(batches):
        done: set[tuple[int, int]] = set()
        found: list[tuple[int, int]] = []

        def emit():
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64())], ["a", "b"])

        for group in grouped(batches, ["token", "lo", "hi"]):
            if group.num_rows < 2:
                continue
            order = np.argsort(group.column("n").to_numpy(), kind="stable")
            n = group.column("n").to_numpy()[order].astype(np.int64)
            ids, comp, own = (group.column(c).to_numpy()[order] for c in ("id", "comp", "own"))
            maps = group.column("bitmap").to_pylist()
            maps = [np.frombuffer(maps[i], np.uint64) for i in order]
            words = np.array([len(m) for m in maps])
            crossed = group.column("lo")[0].as_py() != group.column("hi")[0].as_py()
            folded: tuple[int, int, np.ndarray] | None = None
            for i in range(len(n) - 1):
                top = int(np.searchsorted(n, 100 * n[i] // t, side="right"))
                if top <= i + 1:
                    continue
                ok = (comp[i + 1:top] != comp[i])
                if crossed:
                    ok &= own[i + 1:top] != own[i]
                if n[i] < x:
                    ok &= n[i + 1:top] >= x  # pairs of light sets are found by their subsets
                if not ok.any():
                    continue
                if folded is None or folded[0] != words[i]:
                    folded = (words[i], i, np.stack([fold(m, words[i]) for m in maps[i:]]))
                rest = folded[2][i + 1 - folded[1]:top - folded[1]]
                at = np.flatnonzero(ok)
                differ = np.bitwise_count(rest[at] ^ folded[2][i - folded[1]]).sum(axis=1, dtype=np.int64)
                for j in at[may_link(n[i], n[i + 1 + at], differ, t)]:
                    pair = (int(min(ids[i], ids[i + 1 + j])), int(max(ids[i], ids[i + 1 + j])))
                    if pair not in done:
                        done.add(pair)
                        found.append(pair)
            if len(done) > 200_000:
                done = set()  # emitted again at worst
            if len(found) >= 10_000:
                yield emit()
                found = []
        if found:
            yield emit()

    return run


def lists_to_compare(members: DataFrame) -> DataFrame:
    """Tokens of the lists (token, id, n, comp) that are not one component yet:
    one of all lists with the same members (id, n), as told by their number
    and 128 bits of sums, which are of long type up to 2**31 members."""
    hashes = F.xxhash64("id", "n"), F.xxhash64(F.lit(1), "id", "n")
    parts = [F.sum(F.shiftrightunsigned(h, at).bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"h{i}{at}") for i, h in enumerate(hashes) for at in (0, 32)]
    lists = members.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("rows"), *parts)
    same = ["rows", "h00", "h032", "h10", "h132"]
    return lists.where("x != y").groupBy(*same).agg(F.min("token").alias("token")).select("token")


def _token_sets(id_col: str, text_col: str, k: int):
    @tidy
    def run(batches):
        ids, values = [], []
        for i, words in _words(batches, id_col, text_col):
            ids.append(i)
            values.append(shingles(words, k).view(np.int64))
            if len(ids) >= 500:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.list_(pa.int64()))], ["id", "tokens"])
                ids, values = [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.list_(pa.int64()))], ["id", "tokens"])

    return run


def count_links(sets: list[np.ndarray], copies: np.ndarray, split: int, t: int) -> np.ndarray:
    """Per set the copies of the sets that it links with: of sets on the other
    side of ``split``, of any other set if all are on one side.  Both sides
    are in order of size."""
    m = len(sets)
    n = np.array([len(x) for x in sets], dtype=np.int64)
    _, flat, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # shingles of one set alone are in no overlap
    owner, held = np.repeat(np.arange(m), n), seen[flat] > 1
    flat, owner = (np.cumsum(seen > 1) - 1)[flat[held]], owner[held]
    width = int((seen > 1).sum())
    words = -(-width // 64)
    ends = np.searchsorted(owner, np.arange(m + 1))
    bits = mark = None
    if m * words * 8 <= COUNT_BYTES and words <= 2 * n.mean() + 1:
        bits = np.zeros((m, words * 8), dtype=np.uint8)
        np.bitwise_or.at(bits, (owner, flat >> 3), np.left_shift(1, flat & 7).astype(np.uint8))
        bits = bits.view(np.uint64)
    else:
        mark = np.zeros(width, dtype=bool)
    out = np.zeros(m, dtype=np.int64)
    base = split if split < m else 0
    for i in range(split):
        low = base + int(np.searchsorted(n[base:], least_overlap(int(n[i]), t))) if base else i + 1
        top = base + int(np.searchsorted(n[base:], 100 * n[i] // t, side="right"))
        if low >= top:
            continue
        if bits is not None:
            shared = np.bitwise_count(bits[low:top] & bits[i]).sum(axis=1, dtype=np.int64)
        else:
            own = flat[ends[i]:ends[i + 1]]
            mark[own] = True
            sums = np.concatenate(([0], np.cumsum(mark[flat[ends[low]:ends[top]]])))
            shared = np.diff(sums[ends[low:top + 1] - ends[low]])
            mark[own] = False
        links = low + np.flatnonzero(shared * (100 + t) >= t * (n[i] + n[low:top]))
        out[i] += copies[links].sum()
        out[links] += copies[i]
    return out


def _block_links(t: int):
    """Rows of one (component, block pair) after another: emits the part of
    every set's links that this block pair holds."""

    @tidy
    def run(batches):
        for group in grouped(batches, ["comp", "lo", "hi"]):
            ids, own, copies = (group.column(c).to_numpy() for c in ("id", "own", "copies"))
            _, once = np.unique(ids, return_index=True)  # repeated rows
            tokens = group.column("tokens").combine_chunks()
            flat, at = tokens.values.to_numpy(zero_copy_only=False), tokens.offsets.to_numpy()
            n = np.diff(at)
            once = once[np.lexsort((n[once], own[once]))]
            crossed = group.column("lo")[0].as_py() != group.column("hi")[0].as_py()
            split = int((own[once] == own[once[0]]).sum())
            if len(once) < 2 or crossed and split == len(once):
                continue
            links = count_links([flat[at[i]:at[i + 1]] for i in once], copies[once], split, t)
            yield pa.RecordBatch.from_arrays([pa.array(ids[once], pa.int64()), pa.array(links, pa.int64())], ["rep", "links"])

    return run


def ngram_components(docs: DataFrame, k: int = 5, t: int = 80, id_col: str = "doc_id", text_col: str = "text", links: bool = True) -> DataFrame:
    """Returns (id_col, n_shingles, component_id, n_links) per row of ``docs``; n_links
    counts the other rows that the row links with, exact copies included;
    without ``links`` they are not counted, and the column is left out."""
    spark = docs.sparkSession
    ws = Workspace(spark, "ngram")
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text_col)

    profile = ws.put(rows.mapInArrow(_profile(id_col, text_col, k), PROFILE))
    sets = profile.where("block is null").select("id", "n", "f1", "f2")
    cells = ws.put(profile.where("block is not null").select("block", "cells")
                   .repartition("block").mapInArrow(_add_cells, "block int, cells binary"))
    sketch = _new_sketch(np.uint8)
    for row in cells.toLocalIterator():  # one byte per cell, whatever the input
        sketch[row["block"] * CELLS_PER_BLOCK:(row["block"] + 1) * CELLS_PER_BLOCK] = np.frombuffer(row["cells"], np.uint8)
    steps, log_total, mean_list = frequency_classes(sketch)
    classes = spark.sparkContext.broadcast((steps, log_total))

    reps = ws.put(sets.where("n > 0 and id is not null").groupBy("n", "f1", "f2")
                  .agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    sizes = {r["n"]: r["c"] for r in reps.where(F.col("n") < MAX_LIGHT * 2).groupBy("n").agg(F.count("*").alias("c")).collect()}
    x = boundary(sizes, t, mean_list)

    copies = ws.put(sets.where("n > 0 and id is not null").join(reps.where("copies > 1"), ["n", "f1", "f2"])
                    .where("id != rep").select("id", "n", "f1", "f2"))
    index = rows.mapInArrow(_index(id_col, text_col, k, t, x, classes), INDEX)
    index = ws.put(keep_ids(index, copies, ["id", "n", "f1", "f2"], "left_anti"))
    bitmaps = index.select("id", "n", "bitmap")

    # inverted lists with two members or more; in lists of ordinary length a
    # member whose size is too far from that of every other is left out
    posts = index.select(F.explode("prefix").alias("token"), "id", "n")
    lists = posts.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")
    posts = ws.put(posts.join(lists, "token"))
    by_size = Window.partitionBy("token").orderBy("n", "id")
    before, after = F.lag("n").over(by_size), F.lead("n").over(by_size)
    near_size = (100 * F.col("before") >= t * F.col("n")) | (100 * F.col("n") >= t * F.col("after"))
    usual = posts.where(F.col("members") <= WINDOWED).select("*", before.alias("before"), after.alias("after")).where(near_size)
    posts = ws.put(usual.drop("before", "after").unionByName(posts.where(F.col("members") > WINDOWED)))
    one = F.struct("id", "n")
    centres = posts.groupBy("token").agg(
        F.array(F.min(one), F.max(one), F.min_by(one, F.xxhash64("id", "token"))).alias("centres"))

    light = index.where("size(keys) > 0").select(F.explode("keys").alias("key"), "id", "n").select("key.*", "id", "n")
    smallest = light.groupBy("k1", "k2", "s").agg(F.min(F.struct("n", "id")).alias("c"), F.count("*").alias("members")).where("members > 1")
    light = light.join(smallest, ["k1", "k2", "s"]).where(
        F.col("s") * (100 + t) >= F.lit(t) * (F.col("n") + F.col("c.n"))).select(F.col("id").alias("a"), F.col("c.id").alias("b"))

    def pair(a, b):
        return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")

    def sizes_fit(a, b):
        return F.lit(100) * F.least(a, b) >= F.lit(t) * F.greatest(a, b)

    stars = posts.join(centres, "token").select("id", "n", F.explode("centres").alias("c")).where(
        sizes_fit("n", "c.n")).select(*pair(F.col("id"), F.col("c.id")))
    stars = stars.union(light.select(*pair(F.col("a"), F.col("b")))).where("a != b").distinct()

    def with_maps(pairs: DataFrame) -> DataFrame:
        one = bitmaps.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("ma"))
        two = bitmaps.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("mb"))
        both = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ma", "mb")
        return both.mapInArrow(_bitmap_filter(t), "a long, b long")

    def verified(pairs: DataFrame) -> DataFrame:
        """The staged pairs that link, by the exact overlap of their sets."""
        need = ws.put(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        own = keep_ids(rows.withColumnRenamed(id_col, "id"), need, ["id"]).mapInArrow(
            _token_sets("id", text_col, k), "id long, tokens array<long>")
        own = ws.put(own)
        one = own.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
        two = own.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
        shared = F.size(F.array_intersect("ta", "tb"))
        out = pairs.join(one, "a").join(two, "b").where(
            shared * (100 + t) >= F.lit(t) * (F.size("ta") + F.size("tb"))).select("a", "b")
        out = ws.put(out.distinct())
        ws.drop(own, need)
        return out

    def link_counts(every: DataFrame, final: DataFrame) -> DataFrame:
        """(rep, links): the copies of all sets that a set links with."""
        weight = reps.select(F.col("rep").alias("id"), "n", "copies")
        inside = ws.put(final.join(weight, "id"))
        size = inside.groupBy("comp").agg(F.count("*").alias("m"), F.sum(F.col("n").cast("long")).alias("shingles"))
        known = every.join(inside.select(F.col("id").alias("a"), "comp"), "a").groupBy("comp").agg(F.count("*").alias("pairs"))
        left = size.join(known, "comp").where(2 * F.col("pairs") < F.col("m") * (F.col("m") - 1)).select(
            "comp", F.greatest(F.ceil(F.col("m") / COUNT_SETS), F.ceil(F.col("shingles") / COUNT_SHINGLES)).alias("blocks"))
        open_sets = ws.put(inside.join(left, "comp").select("id", "comp", "copies", "blocks"))
        both = every.unionByName(every.select(F.col("a").alias("b"), F.col("b").alias("a")))
        settled = keep_ids(both.select(F.col("a").alias("rep"), F.col("b").alias("id")),
                           open_sets.select("id").withColumnRenamed("id", "rep"), ["rep"], "left_anti")
        settled = settled.join(weight, "id").groupBy("rep").agg(F.sum("copies").alias("links"))
        own = keep_ids(rows.withColumnRenamed(id_col, "id"), open_sets.select("id"), ["id"]).mapInArrow(
            _token_sets("id", text_col, k), "id long, tokens array<long>")
        own = own.join(open_sets, "id").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
        own = own.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        own = own.select("comp", F.least("own", "o").alias("lo"), F.greatest("own", "o").alias("hi"), "id", "own", "copies", "tokens")
        own = own.repartition("comp", "lo", "hi").sortWithinPartitions("comp", "lo", "hi")
        counted = own.mapInArrow(_block_links(t), "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))
        return settled.unionByName(counted)

    first = ws.put(with_maps(stars))
    sure = verified(first)
    comps = ws.put(components(ws, sure))

    # lists that are not one component yet, in blocks
    label = F.coalesce("comp", "id").alias("comp")
    open_ = posts.select("token", "id", "n", "members").join(comps, "id", "left").select("token", "id", "n", "members", label)
    mixed = ws.put(lists_to_compare(open_))
    blocks = F.ceil(F.col("members") / BLOCK)
    member = open_.join(maybe_small(mixed), "token").join(bitmaps.select("id", "bitmap"), "id").withColumn(
        "own", F.pmod(F.xxhash64("id"), blocks))
    member = member.select("token", "id", "n", "comp", "bitmap", "own", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("o"))
    member = member.select("token", F.least("own", "o").alias("lo"), F.greatest("own", "o").alias("hi"), "id", "n", "comp", "own", "bitmap")
    member = member.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi")
    second = ws.put(member.mapInArrow(_block_pairs(t, x), "a long, b long").distinct(), text_batch=4096)
    more = verified(second)
    ws.drop(first, second, posts, index, mixed)
    every = ws.put(sure.union(more))
    if more.isEmpty():
        final = comps
    else:
        ws.drop(comps)
        final = ws.put(components(ws, every))
    counts = ws.put(link_counts(every, final)) if links else None
    of_rep = reps.join(final, reps["rep"] == final["id"], "left").select("n", "f1", "f2", "rep", F.coalesce("comp", "rep").alias("comp"), "copies")
    if links:
        of_rep = of_rep.join(counts, "rep", "left").select(
            "n", "f1", "f2", "comp", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    named = F.col("id").isNotNull()
    result = [F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.when(named, F.coalesce("comp", "id")).alias("component_id")]
    if links:
        result.append(F.when(named, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"))
    out = ws.put(sets.join(of_rep, ["n", "f1", "f2"], "left").select(*result))
    classes.unpersist()
    ws.drop(profile, cells, reps, copies, sure, more, every, *([counts] if links else []))
    return out
