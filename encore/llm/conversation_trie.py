"""Prefix trie of conversations: shared beginnings, leaves and savings.

Turns are dictionary-encoded (one number per distinct role and text), every
conversation becomes a sequence of numbers, and the sequences are dealt out in
sorted order, so that conversations with a common beginning lie in one range
shard.  A shard is worked through in blocks of at most ``block`` turns:

1. a block's sequences go into a ternary search tree, the median first, then
   the medians of the two halves, so that the siblings of a node are balanced;
2. a pass over the nodes in reverse order of their creation (a node is made
   after its parent) accumulates members, children, leaves and savings; no
   recursion, whatever the depth;
3. nodes on the path of a block's first or last sequence may occur in other
   blocks.  A block knows the sequence before and the one after it, so it can
   tell whether it is the first (last) one to hold such a node and counts
   what must be counted once only there.  All figures are then sums, and the
   boundary nodes merge by one aggregation over their keys.

Conversations of more than ``segment`` turns are cut into segments; the
segments of one layer hang below the nodes in which the layer above ends.
Layers are worked off from the deepest one; conversations of up to ``segment``
turns need one.  So no task holds more than a block, however long one
conversation is or however many are alike.

A node's key is a chain of 128-bit digests over its turn numbers.

Defined cases: turns are ordered by number, null first, then by role and by
digest of role and text; repeated rows are turns of their own; null role or
text is empty; rows without a conversation id belong to none and are left out;
an empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import Workspace, maybe_small

#: Turns of a conversation that one layer takes.
SEGMENT = 2048
#: Turns held by one ternary search tree.
BLOCK = 100_000
ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Rows of an Arrow batch; a row holds up to SEGMENT turns.
BATCH = 256


def ordered_turns(ws: Workspace, conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, tid, words) of every turn.  Positions come from
    one range sort and the sizes of a conversation's parts, so a conversation
    with any number of turns is spread over tasks."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("turn_key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("turn_key")]
    placed = ws.put(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "turn_key", "words", F.monotonically_increasing_id().alias("ord")))
    placed = placed.withColumn("part", F.shiftright("ord", 33))
    spans = placed.groupBy("conv_id", "part").agg(F.min("ord").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select("conv_id", "part", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("shift"))
    words = placed.select("turn_key", "words").distinct()
    ids = ws.put(words.select("turn_key", F.monotonically_increasing_id().alias("tid")))
    numbered = placed.join(spans, ["conv_id", "part"]).select("conv_id", (F.col("ord") + F.col("shift")).alias("pos"), "turn_key", "words")
    return ws.put(numbered.join(ids, "turn_key").select("conv_id", "pos", "tid", "words"))


def own_sequences(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: (conv_id, depth, tid, words, length), (conv_id)."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("length"))
    return turns.withColumnRenamed("pos", "depth").join(sizes, "conv_id"), sizes.select("conv_id")


def shared_heads(ws: Workspace, turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h turns are those of the first conversation
    of their group, h = crc32(id) mod ``most``, followed by their own after h.
    Returns the sequences and all ids, also those left without a turn."""
    sizes = ws.put(turns.groupBy("conv_id").agg(F.count("*").alias("n")))
    heads = sizes.select("conv_id", "n", F.expr(f"conv_id - conv_id % {group}").alias("base"),
                         (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    bases = sizes.where(f"conv_id % {group} = 0").select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    heads = heads.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    heads = ws.put(heads.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    lent = turns.where((F.col("conv_id") % group == 0) & (F.col("pos") < most)).select(F.col("conv_id").alias("base"), "pos", "tid", "words")
    lent = heads.where("taken > 0").join(lent, "base").where("pos <= taken").select(
        "conv_id", F.col("pos").alias("depth"), "tid", "words", "length")
    own = turns.join(heads, "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "tid", "words", "length")
    return ws.put(lent.unionByName(own)), sizes.select("conv_id")


def _digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=16).digest()


def _number(tid: int) -> bytes:
    return tid.to_bytes(8, "little", signed=True)


def _segment_digests(batches):
    for batch in batches:
        digests = [_digest(np.array(t, np.int64).tobytes()) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary())], ["conv_id", "layer", "digest"])


def _chain(batches):
    """Keys before and after each full segment of a conversation."""
    last, key = None, ROOT
    for batch in batches:
        before, after = [], []
        for conv, digest in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if conv != last:
                last, key = conv, ROOT
            before.append(key)
            key = _digest(key, digest)
            after.append(key)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
            ["conv_id", "layer", "root_key", "next_key"])


def _shared(a, b) -> int:
    """Length of the common beginning of two (root, sequence) pairs; -1 if
    their roots differ."""
    if a is None or b is None or a[0] != b[0]:
        return -1
    n = 0
    for x, y in zip(a[1], b[1], strict=False):
        if x != y:
            break
        n += 1
    return n


class Tree:
    """A ternary search tree over sequences that start with their root's key;
    node 0 stands above all of them."""

    def __init__(self):
        self.sym, self.lo, self.hi, self.eq, self.up, self.n, self.least = [None], [-1], [-1], [-1], [-1], [0], [None]

    def _new(self, symbol, up: int) -> int:
        for column, value in ((self.sym, symbol), (self.lo, -1), (self.hi, -1), (self.eq, -1), (self.up, up), (self.n, 0), (self.least, None)):
            column.append(value)
        return len(self.sym) - 1

    def insert(self, symbols, members: int, least: int) -> int:
        """Adds ``members`` conversations with this sequence; the last node."""
        sym, lo, hi = self.sym, self.lo, self.hi
        at = 0
        for s in symbols:
            x = self.eq[at]
            if x < 0:
                x = self.eq[at] = self._new(s, at)
            else:
                while sym[x] != s:
                    side = lo if s < sym[x] else hi
                    if side[x] < 0:
                        side[x] = self._new(s, at)
                    x = side[x]
            self.n[x] += members
            if self.least[x] is None or least < self.least[x]:
                self.least[x] = least
            at = x
        return at

    def path(self, symbols) -> list[int]:
        """Nodes of a sequence that is in the tree."""
        out, at = [], 0
        for s in symbols:
            x = self.eq[at]
            while self.sym[x] != s:
                x = self.lo[x] if s < self.sym[x] else self.hi[x]
            out.append(x)
            at = x
        return out


def _balanced(n: int):
    """0 .. n-1, medians first."""
    stack = [(0, n)]
    while stack:
        a, b = stack.pop()
        if a < b:
            mid = (a + b) // 2
            yield mid
            stack += [(mid + 1, b), (a, mid)]


NODES = ("key binary, parent_key binary, depth long, top boolean, conv_id long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, edge boolean, ends_sha256 string, piece_first long, piece string")


def block_nodes(rows: list[tuple], before, after, depth0: int, segment: int) -> pa.RecordBatch:
    """The nodes of one block.  ``rows``: sorted (root, tids, more, conv_id,
    words, children, leaves and saved of the layer below); ``before`` and
    ``after``: the neighbouring (root, tids)."""
    runs: list[list] = []  # first row, members, smallest member, ids of those that end, last row that goes on
    for row in rows:
        if not runs or runs[-1][0][1] != row[1] or runs[-1][0][0] != row[0]:
            runs.append([row, 0, row[3], [], None])
        run = runs[-1]
        run[1] += 1
        run[2] = min(run[2], row[3])
        if row[2]:
            run[4] = row
        else:
            run[3].append(row[3])
    tree = Tree()
    stop: dict[int, list] = {}
    for i in _balanced(len(runs)):
        row, members, least, _, _ = runs[i]
        stop[tree.insert([row[0], *row[1]], members, least)] = runs[i]
    first, last = runs[0][0], runs[-1][0]
    first_path, last_path = (tree.path([r[0], *r[1]]) for r in (first, last))
    seen = set(first_path[:_shared(before, first) + 1])  # held by the block before, too
    goes_on = set(last_path[:_shared(after, last) + 1])  # held by the block after, too
    size = len(tree.sym)
    word = [0] * size
    for row, *_ in runs:  # a turn's words, along the path of any sequence that has it
        at = 0
        for s, w in zip([row[0], *row[1]], [0, *row[4]], strict=True):
            x = tree.eq[at]
            while tree.sym[x] != s:
                x = tree.lo[x] if s < tree.sym[x] else tree.hi[x]
            word[x] = w
            at = x
    kids, leaves, saved = [0] * size, [0] * size, [0] * size
    level, key = [0] * size, [b""] * size
    deep = {x: run for x, run in stop.items() if len(run[0][1]) == segment}
    for x in range(1, size):
        up = tree.up[x]
        if up == 0:
            level[x], key[x] = 0, tree.sym[x]
        else:
            level[x] = level[up] + 1
            key[x] = _digest(key[up], _number(tree.sym[x]))
    for x, run in deep.items():
        key[x] = _digest(run[0][0], _digest(np.array(run[0][1], np.int64).tobytes()))
    for x in range(size - 1, 0, -1):
        if not level[x]:
            continue
        new = x not in seen
        saved[x] += tree.n[x] * word[x] - (word[x] if new else 0)
        if x not in goes_on:
            below = stop[x][4] if x in stop else None
            if below is not None:
                kids[x] += below[5]
                leaves[x] += below[6]
                saved[x] += below[7]
            elif tree.eq[x] < 0:
                leaves[x] += 1
        up = tree.up[x]
        kids[up] += new
        leaves[up] += leaves[x]
        saved[up] += saved[x]
    edges = {*first_path, *last_path, *(x for x, run in deep.items() if run[4] is not None)}
    out: list[tuple] = []
    for x in range(1, size):
        if not level[x]:
            continue
        up, ends = tree.up[x], stop[x][3] if x in stop else []
        piece = ",".join(map(str, ends))
        known = level[x] > 1 and up not in edges
        out.append((key[x], key[up], depth0 + level[x], level[x] == 1, tree.least[x], tree.least[up] if known else None, tree.n[x], kids[x], leaves[x],
                    saved[x], x in edges, None if x in edges else hashlib.sha256(piece.encode()).hexdigest(),
                    ends[0] if ends and x in edges else None, piece if ends and x in edges else None))
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.bool_(), pa.string(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in NODES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _shards(depth0: int, segment: int, block: int):
    def run(batches):
        part, before, rows, size = None, None, [], 0
        for batch in batches:
            for p, kind, root, tids, *rest in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                if p != part:
                    if rows:
                        yield block_nodes(rows, before, None, depth0, segment)
                    part, before, rows, size = p, None, [], 0
                if kind < 0:
                    before = (root, tids)
                elif kind > 0:
                    yield block_nodes(rows, before, (root, tids), depth0, segment)
                    rows = []
                else:
                    if size >= block:
                        yield block_nodes(rows, before, (root, tids), depth0, segment)
                        before, rows, size = rows[-1][:2], [], 0
                    rows.append((root, tids, *rest))
                    size += len(tids)
        if rows:
            yield block_nodes(rows, before, None, depth0, segment)

    return run


def _hashes(batches):
    """SHA-256 of the pieces of each key, comma-joined, as they stream by."""
    key, state = None, None
    for batch in batches:
        done: list[tuple] = []
        for k, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())], ["key", "sha"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "sha"])


_FIGURES = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def _layer(ws: Workspace, rows: DataFrame, depth0: int, segment: int, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(inner nodes, merged boundary nodes, pieces of the boundary nodes' ids)."""
    order = ["root_key", "tids", "more", "conv_id"]
    fields = ["root_key", "tids", "more", "conv_id", "words", "kids", "leaves", "saved"]
    placed = ws.put(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*fields, F.monotonically_increasing_id().alias("ord")))
    placed = placed.withColumn("part", F.shiftright("ord", 33))
    # the last row before and the first row after each part
    spans = placed.groupBy("part").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"))
    along = Window.orderBy("part")  # one row per part
    spans = spans.select("part", F.lag("hi").over(along).alias("before"), F.lead("lo").over(along).alias("after"))
    spans = ws.put(spans.select("part", F.explode(F.array(
        F.struct(F.lit(-1).alias("kind"), F.col("before").alias("ord")),
        F.struct(F.lit(1).alias("kind"), F.col("after").alias("ord")))).alias("n")).select("part", "n.kind", "n.ord").where("ord is not null"))
    beside = placed.drop("part").join(maybe_small(spans), "ord")
    stream = placed.withColumn("kind", F.lit(0)).unionByName(beside).repartition("part").sortWithinPartitions("part", "kind", "ord")
    made = ws.put(stream.select("part", "kind", *fields).mapInArrow(_shards(depth0, segment, block), NODES), text_batch=BATCH)
    edge = made.where("edge")
    merged = edge.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.first("top").alias("top"), F.min("conv_id").alias("conv_id"),
        F.max("parent_conv_id").alias("parent_conv_id"), *[F.sum(c).alias(c) for c in _FIGURES])
    return made.where("not edge"), ws.put(merged), edge.where("piece is not null").select("key", "piece_first", "piece")


def prefix_trie(sequences: DataFrame, convs: DataFrame, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """``sequences``: (conv_id, depth from 1, tid, words, length); ``convs``:
    all conversation ids.  One row per node: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ws = Workspace(sequences.sparkSession, "trie")
    layer = F.expr(f"cast((depth - 1) div {segment} as int)")
    cut = sequences.groupBy("conv_id", layer.alias("layer")).agg(
        F.array_sort(F.collect_list(F.struct("depth", "tid", "words"))).alias("t"), F.first("length").alias("length"))  # at most `segment` turns
    cut = ws.put(cut.select("conv_id", "layer", F.col("t.tid").alias("tids"), F.col("t.words").alias("words"),
                            (F.col("length") > (F.col("layer") + 1) * segment).alias("more")))
    deepest = cut.agg(F.max("layer")).first()[0]
    if deepest:
        full = cut.where(F.size("tids") == segment).select("conv_id", "layer", "tids")
        digests = ws.put(full.mapInArrow(_segment_digests, "conv_id long, layer int, digest binary"), text_batch=BATCH)
        keys = ws.put(digests.repartition("conv_id").sortWithinPartitions("conv_id", "layer").mapInArrow(
            _chain, "conv_id long, layer int, root_key binary, next_key binary"))
        roots = keys.select("conv_id", (F.col("layer") + 1).alias("layer"), F.col("next_key").alias("root_key")).unionByName(
            keys.where("layer = 0").select("conv_id", "layer", "root_key"))
        cut = cut.join(roots, ["conv_id", "layer"], "left").join(keys.select("conv_id", "layer", "next_key"), ["conv_id", "layer"], "left")
        cut = ws.put(cut.withColumn("root_key", F.coalesce("root_key", F.lit(ROOT))))
    else:
        cut = cut.withColumns({"root_key": F.lit(ROOT), "next_key": F.lit(None).cast("binary")})
    below = None
    parts: list[tuple[DataFrame, DataFrame, DataFrame]] = []
    for at in range(deepest if deepest is not None else -1, -1, -1):
        rows = cut.where(F.col("layer") == at)
        if below is None:
            rows = rows.withColumns({c: F.lit(0).cast("long") for c in ("kids", "leaves", "saved")})
        else:
            rows = rows.join(maybe_small(below), "next_key", "left")
        parts.append(_layer(ws, rows, at * segment, segment, block))
        nodes = parts[-1][0].select(*parts[-1][1].columns).unionByName(parts[-1][1])
        below = ws.put(nodes.where("top").groupBy(F.col("parent_key").alias("next_key")).agg(
            F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")))
    # the root: all conversations; those without a turn end in it
    total = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    sums = (0, 0, 0) if below is None else tuple(below.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("kids", "leaves", "saved")]).first())
    root = ws.put(total.select(
        F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent_key"), F.lit(0).cast("long").alias("depth"), F.lit(False).alias("top"), "conv_id",
        F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.lit(sums[0]).cast("long").alias("n_children"),
        F.lit(max(1, sums[1])).cast("long").alias("n_leaves"), F.lit(sums[2]).cast("long").alias("saved_tokens")))
    turnless = convs.join(sequences.where("depth = 1").select("conv_id"), "conv_id", "left_anti").select(
        F.lit(ROOT).alias("key"), F.col("conv_id").alias("piece_first"), F.col("conv_id").cast("string").alias("piece"))
    pieces = reduce(DataFrame.unionByName, [p[2] for p in parts], turnless)
    merged = reduce(DataFrame.unionByName, [p[1] for p in parts], root)
    hashes = ws.put(pieces.repartition("key").sortWithinPartitions("key", "piece_first").mapInArrow(_hashes, "key binary, sha string"), text_batch=BATCH)
    merged = ws.put(merged.join(hashes, "key", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(NO_ENDS))).drop("sha"))
    inner = [p[0].select(*merged.columns) for p in parts]
    nodes = reduce(DataFrame.unionByName, inner, merged)
    result = ["conv_id", "depth", "parent_conv_id", *_FIGURES, "ends_sha256"]
    names = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("of"))
    waiting = nodes.where("parent_conv_id is null and depth > 0").join(maybe_small(names), "parent_key").withColumn("parent_conv_id", F.col("of"))
    done = nodes.where("parent_conv_id is not null or depth = 0")
    return done.select(*result).unionByName(waiting.select(*result))


def conversation_trie(conversations: DataFrame, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """The trie of the conversations as they are."""
    ws = Workspace(conversations.sparkSession, "turns")
    sequences, convs = own_sequences(ordered_turns(ws, conversations))
    return prefix_trie(ws.put(sequences), convs, segment, block)


def rebuilt_trie(conversations: DataFrame, group: int = 20, most: int = 4, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """The trie of the conversations after their heads were exchanged."""
    ws = Workspace(conversations.sparkSession, "turns")
    return prefix_trie(*shared_heads(ws, ordered_turns(ws, conversations), group, most), segment, block)
