"""Repeated passages by a logarithmic family of sparse suffix arrays.

A byte is repeated when a string of ``length`` bytes that covers it also
starts anywhere else in the corpus, in the same document or another.

*Sparse suffixes.*  Of every window of ``length`` bytes the suffix is kept that
starts with the least hashed gram of ``length // 4`` bytes (the leftmost of
equals).  The choice depends on the window's bytes alone, so two equal windows
keep suffixes at the same offset: nothing is missed, and about one position in
a hundred and fifty is kept.

*Levels.*  The documents come in batches.  A batch gets a suffix array: the
first gram of its sparse suffixes in byte order, one row per distinct gram (so
one that a third of all texts have is one row), in buckets by the gram that are
sorted within.  It is merge-scanned against every existing level: both are read
in their stored buckets and order, nothing is shuffled.  Grams met in two texts,
or twice in one, are hits.  Then the batch enters the family: two levels of
equal size merge into one of twice the size, bucket by bucket, so after n
batches at most log2(n) + 1 levels exist and a suffix is rewritten at most
log2(n) times.  The levels are tables at a path and can be opened again for a
later batch (``SuffixFamily.open``).

*Long matches.*  For suffixes at hits the bytes around (up to ``length`` less
the gram on each side) are taken from the text.  A window is named by the
offset d of its suffix; two are equal when their left d and right
``length - d`` bytes are.  Equal surroundings are merged first (in the task,
then per key), so a passage in a million copies is one row.  The distinct
surroundings of a key are put in order of their bytes, to the right and to the
left, with the common lengths of neighbours; windows are equal when they lie in
the same interval of both orders.  Bytes decide, not hashes, in linear work per
offset, never by pairs.  A key with more than ``GROUP`` distinct surroundings is
split by salt; windows that stand alone in their part meet again by their
128-bit digest.

*Exact copies* of a whole text are found first by SHA-256: a copied text of
``length`` bytes or more is repeated whole, and one of its rows takes part.

Defined cases: null counts as empty; texts shorter than ``length`` lose
nothing; repeated rows are copies of each other; null ids are rows like
others.  Only id and text are read.
"""

from __future__ import annotations

import hashlib
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import Workspace, delete, grouped, keep_ids, maybe_small, texts_of
from encore.llm.text import mix, powers

LENGTH = 400
BATCHES = 4
#: Distinct surroundings of one key that a task compares at once.
GROUP = 50_000
#: Windows hashed at once.
PIECE = 1 << 20
#: Low bits of a packed hash that hold the position in a piece.
_AT = np.uint64((1 << 24) - 1)
_BASE = 0x5851F42D4C957F2D


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the gram that starts at each position."""
    n = len(data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.multiply(data, powers(_BASE, n), out=total[1:])
    np.cumsum(total, out=total)
    return mix((total[gram:] - total[:-gram]) * powers(pow(_BASE, -1, 1 << 64), n)[:n - gram + 1])


def sparse_suffixes(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) of the suffixes kept for the windows of a text."""
    gram = length // 4
    width = length - gram + 1
    places, keys = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for at in range(0, len(text) - length + 1, PIECE):
        data = np.frombuffer(text, np.uint8, min(PIECE + length - 1, len(text) - at), at)
        value = gram_hashes(data, gram)
        packed = (value & ~_AT) | np.arange(len(value), dtype=np.uint64)
        # least value of every run of ``width`` positions, by blocks of that width
        blocks = np.full(-(-len(packed) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
        blocks[:len(packed)] = packed
        blocks = blocks.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(packed) - width + 1
        least = np.minimum(behind[:n], ahead[width - 1:width - 1 + n])
        least = least[np.concatenate(([True], least[1:] != least[:-1]))]
        where = (least & _AT).astype(np.int64)
        places.append(where + at)
        keys.append(value[where])
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(keys)[first]


def _scan(length: int):
    """Per text: size, digest, distinct keys of its sparse suffixes with their
    first grams, and which of them it has twice (a text that repeats itself has
    few distinct ones)."""
    gram = length // 4

    def run(batches):
        for batch in batches:
            size, sha, key, twice, grams = [], [], [], [], []
            for text in texts_of(batch):
                places, keys = sparse_suffixes(text, length)
                distinct, first, count = np.unique(keys, return_index=True, return_counts=True)
                size.append(len(text))
                sha.append(hashlib.sha256(text).digest())
                key.append(distinct.view(np.int64))
                twice.append(count > 1)
                grams.append([text[at:at + gram] for at in places[first].tolist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(sha, pa.binary()), pa.array(key, pa.list_(pa.int64())),
                 pa.array(twice, pa.list_(pa.bool_())), pa.array(grams, pa.list_(pa.binary()))],
                ["doc_id", "n_bytes", "sha", "keys", "twice", "grams"])

    return run


def suffix_rows(scan: DataFrame) -> DataFrame:
    """(gram, key, twice, a, b) of every sparse suffix; a and b are 128 bits of
    the digest of its text, so copies of a text count as one."""
    half = lambda at: F.conv(F.substring(F.hex("sha"), at, 15), 16, 10).cast("long")
    return scan.where(F.size("keys") > 0).select(
        F.explode(F.arrays_zip("grams", "keys", "twice")).alias("s"), half(1).alias("a"), half(16).alias("b")).select(
        F.col("s.grams").alias("gram"), F.col("s.keys").alias("key"), F.col("s.twice").alias("twice"), "a", "b")


_MET = "twice or a_low != a_high or b_low != b_high"
_LEVEL = "gram binary, key long, twice boolean, a_low long, a_high long, b_low long, b_high long"


class SuffixFamily:
    """Levels of suffix arrays under a shared folder: one row per distinct gram
    (first bytes of a sparse suffix), in buckets by it, sorted within.  The
    texts that have it are told by the least and greatest digest: two differ
    where more than one text has it."""

    def __init__(self, ws: Workspace, buckets: int | None = None):
        self.ws, self.spark = ws, ws.spark
        #: Like the shuffles, so that a bucket is written by one task.
        self.buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[tuple[int, str, str]] = []  # (batches held, table, path), largest first
        self.hits: list[DataFrame] = []

    @classmethod
    def open(cls, ws: Workspace, buckets: int, levels: list[tuple[int, str]]) -> SuffixFamily:
        """The family whose levels (batches held, path) an earlier run left."""
        family = cls(ws, buckets)
        for size, path in levels:
            name = f"suffix_{uuid.uuid4().hex}"
            ws.spark.sql(f"CREATE TABLE {name} ({_LEVEL}) USING parquet CLUSTERED BY (gram) SORTED BY (gram) INTO {buckets} BUCKETS "
                         f"LOCATION '{path}'")
            family.levels.append((size, name, path))
        return family

    @contextmanager
    def _in_order(self):
        """Buckets of one file are read in the order in which they were written."""
        key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "true")
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def _store(self, rows: DataFrame) -> tuple[str, str]:
        name = f"suffix_{uuid.uuid4().hex}"
        path = f"{self.ws.base}/{name}"
        rows.write.format("parquet").bucketBy(self.buckets, "gram").sortBy("gram").option("path", path).option(
            "compression", "zstd").saveAsTable(name)
        return name, path

    def _forget(self, name: str, path: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(self.spark, path)

    def merged(self, one: str, two: str, how: str) -> DataFrame:
        """Two levels side by side in one pass over their sorted buckets."""
        a, b = self.spark.table(one).alias("x"), self.spark.table(two).alias("y")
        pair = a.hint("merge").join(b, "gram", how)
        least = lambda c: F.least(f"x.{c}", f"y.{c}").alias(c)  # noqa: E731  (both skip nulls)
        most = lambda c: F.greatest(f"x.{c}", f"y.{c}").alias(c)
        return pair.select("gram", least("key"), most("twice"), least("a_low"), most("a_high"), least("b_low"), most("b_high"))

    def add(self, suffixes: DataFrame) -> None:
        """Merge-scan a batch (gram, key, twice, a, b) against the family, then
        let it enter."""
        array = self._store(suffixes.groupBy("gram").agg(
            F.min("key").alias("key"), F.max("twice").alias("twice"), F.min("a").alias("a_low"), F.max("a").alias("a_high"),
            F.min("b").alias("b_low"), F.max("b").alias("b_high")))
        with self._in_order():
            found = self.spark.table(array[0]).where(_MET).select("key")
            for _, level, _ in self.levels:
                found = found.unionByName(self.merged(array[0], level, "inner").where(_MET).select("key"))
            self.hits.append(self.ws.put(found.distinct()))
            size = 1
            while self.levels and self.levels[-1][0] == size:
                other = self.levels.pop()[1:]
                both = self._store(self.merged(other[0], array[0], "full"))
                self._forget(*other)
                self._forget(*array)
                array, size = both, 2 * size
        self.levels.append((size, *array))

    def hit_keys(self) -> DataFrame:
        hits = self.hits[0]
        for more in self.hits[1:]:
            hits = hits.unionByName(more)
        return self.ws.put(hits.distinct())

    def close(self) -> None:
        """Deletes the levels."""
        self.ws.drop(*self.hits)
        for _, *level in self.levels:
            self._forget(*level)
        self.hits, self.levels = [], []


def _surroundings(length: int):
    """kind 0: where a hit is; kind 1: its surroundings, once per task."""
    gram = length // 4
    side = length - gram
    names = ["kind", "rid", "place", "key", "c1", "c2", "l", "body", "n"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64()]

    def run(batches):
        seen: dict[tuple, list] = {}

        def contexts():
            rows = list(seen.items())
            for i in range(0, len(rows), 2000):
                some = rows[i:i + 2000]
                none = [None] * len(some)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    [[1] * len(some), none, none, [k[0] for k, _ in some], [k[1] for k, _ in some], [k[2] for k, _ in some],
                     [v[0] for _, v in some], [v[1] for _, v in some], [v[2] for _, v in some]], types, strict=True)], names)

        held = 0
        for batch in batches:
            out: list[tuple] = []
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("rid", "keys")]
            for rid, hits, text in zip(*cols, texts_of(batch), strict=True):
                places, keys = sparse_suffixes(text, length)
                hit = np.isin(keys.view(np.int64), np.array(hits, dtype=np.int64))
                for key, place in zip(keys.view(np.int64)[hit].tolist(), places[hit].tolist(), strict=True):
                    begin = max(0, place - side)
                    body = text[begin:place + length]
                    digest = hashlib.blake2b(body + (place - begin).to_bytes(4, "little"), digest_size=16).digest()
                    c1, c2 = (int.from_bytes(digest[i:i + 8], "little", signed=True) for i in (0, 8))
                    out.append((0, rid, place, key, c1, c2))
                    got = seen.get((key, c1, c2))
                    if got is None:
                        seen[key, c1, c2] = [place - begin, body, 1]
                        held += len(body)
                    else:
                        got[2] += 1
                if held > 32 << 20:
                    yield from contexts()
                    seen, held = {}, 0
            if out:
                none = [None] * len(out)
                cols = [[r[i] for r in out] for i in range(6)] + [none, none, none]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)
        yield from contexts()

    return run


def ordered(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of some strings of at most ``width`` bytes, and the length that
    each has in common with the one before it (the first: 0)."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    sizes = np.array([len(parts[i]) for i in order], dtype=np.int64)
    grid = np.frombuffer(b"".join([parts[i].ljust(width, b"\0") for i in order]), np.uint8).reshape(len(parts), width)
    differ = grid[1:] != grid[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return np.array(order), np.concatenate(([0], np.minimum(common, np.minimum(sizes[1:], sizes[:-1]))))


def _both_orders(bodies: list[bytes], lefts: np.ndarray, length: int):
    """Orders of the bytes before the suffixes (nearest first) and of the
    suffixes themselves, to ``length``."""
    side = length - length // 4
    at = lefts.tolist()
    before = ordered([body[:i][::-1] for body, i in zip(bodies, at, strict=True)], side)
    return before, ordered([body[i:] for body, i in zip(bodies, at, strict=True)], length)


def window_classes(bodies: list[bytes], lefts: np.ndarray, length: int):
    """For every offset in turn: (offset, bodies that have the window that
    starts so many bytes before the suffix, its class for each of them).
    Windows of one offset are equal when their classes are."""
    (left, left_common), (right, right_common) = _both_orders(bodies, lefts, length)
    n_right = np.array([len(b) for b in bodies], dtype=np.int64) - lefts
    before, after = np.empty(len(bodies), np.int64), np.empty(len(bodies), np.int64)
    for offset in range(length - length // 4 + 1):
        before[left] = np.cumsum(left_common < offset)
        after[right] = np.cumsum(right_common < length - offset)
        have = np.flatnonzero((lefts >= offset) & (n_right >= length - offset))
        yield offset, have, (before * (len(bodies) + 1) + after)[have]


def repeated_offsets(bodies: list[bytes], lefts: np.ndarray, length: int) -> np.ndarray:
    """Which windows of a few bodies occur in two of them: the classes of
    ``window_classes``, all offsets in one matrix."""
    (left, left_common), (right, right_common) = _both_orders(bodies, lefts, length)
    n_right = np.array([len(b) for b in bodies], dtype=np.int64) - lefts
    offsets = np.arange(length - length // 4 + 1)
    value = np.empty((len(bodies), len(offsets)), dtype=np.int64)
    after = np.empty(value.shape, dtype=np.int64)
    value[left] = np.cumsum(left_common[:, None] < offsets, axis=0)
    after[right] = np.cumsum(right_common[:, None] < length - offsets, axis=0)
    value = value * (len(bodies) + 1) + after
    invalid = (offsets > lefts[:, None]) | (length - offsets > n_right[:, None])
    value[invalid] = -1 - np.nonzero(invalid)[0]  # like no other row
    order = np.argsort(value, axis=0, kind="stable")
    ranked = np.take_along_axis(value, order, axis=0)
    same = np.zeros((len(bodies) + 1, len(offsets)), dtype=bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    out = np.zeros(value.shape, dtype=bool)
    np.put_along_axis(out, order, same[1:] | same[:-1], axis=0)
    return out


def _compare(length: int):
    """Rows of one (key, salt) after another: which windows of each distinct
    surrounding are repeated, as runs of offsets (kind 0); for a key in
    several parts, also every window that has to meet those of the other
    parts (kind 1)."""
    gram = length // 4
    side = length - gram
    names = ["kind", "key", "c1", "c2", "low", "high", "window", "alone"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]

    def run(batches):
        out: list[tuple] = []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

        for group in grouped(batches, ["key", "salt"]):
            key, parts = group.column("key")[0].as_py(), group.column("parts")[0].as_py()
            merged: dict[tuple, list] = {}
            for c1, c2, at, body, n in zip(*(group.column(c).to_pylist() for c in ("c1", "c2", "l", "body", "n")), strict=True):
                got = merged.setdefault((c1, c2), [at, body, 0])
                got[2] += n
            if parts == 1 and len(merged) == 1 and next(iter(merged.values()))[2] < 2:
                continue
            names_ = list(merged)
            lefts = np.array([v[0] for v in merged.values()], dtype=np.int64)
            bodies = [v[1] for v in merged.values()]
            many = np.array([v[2] > 1 for v in merged.values()])
            sizes = np.array([len(b) for b in bodies])
            offsets = np.arange(side + 1)
            exists = (offsets <= lefts[:, None]) & (side - offsets <= (sizes - lefts - gram)[:, None])
            again = exists & many[:, None]
            if parts == 1 and len(bodies) <= 256:
                if len(bodies) > 1:
                    again |= repeated_offsets(bodies, lefts, length)
                walk = iter(())
            else:
                walk = window_classes(bodies, lefts, length)
            for offset, have, value in walk:
                order = np.argsort(value, kind="stable")
                ranked = value[order]
                same = np.zeros(len(ranked) + 1, dtype=bool)
                same[1:-1] = ranked[1:] == ranked[:-1]
                twice = np.zeros(len(have), dtype=bool)
                twice[order] = same[1:] | same[:-1]
                again[have, offset] = twice | many[have]
                if parts > 1:
                    for i in order[~same[:-1]]:  # one of each class
                        r = have[i]
                        begin = int(lefts[r]) - offset
                        window = hashlib.blake2b(bodies[r][begin:begin + length], digest_size=16).digest()
                        out.append((1, key, *names_[r], offset, None, window, not bool(again[r, offset])))
                        if len(out) >= 5000:
                            yield flush()
                            out = []
            edge = np.diff(np.pad(again.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            for r, low in zip(*np.nonzero(edge == 1), strict=True):
                high = int(low) + int(np.argmax(edge[r, low + 1:] == -1))
                out.append((0, key, *names_[r], int(low), high, None, None))
            if len(out) >= 5000:
                yield flush()
                out = []
        if out:
            yield flush()

    return run


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of a set of [start, end) spans."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _remove(batches):
    """Texts and spans to what is left."""
    for batch in batches:
        rid = batch.column(batch.schema.get_field_index("rid"))
        spans = batch.column(batch.schema.get_field_index("spans")).to_pylist()
        rows = []
        for text, some in zip(texts_of(batch), spans, strict=True):
            runs = merge_spans([(s["start"], s["end"]) for s in some])
            at, left = 0, hashlib.sha256()
            for start, end in runs:
                left.update(text[at:start])
                at = end
            left.update(text[at:])
            rows.append((sum(b - a for a, b in runs), [dict(start=a, end=b) for a, b in runs], left.hexdigest()))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [rid, pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.string())],
            ["rid", "n_removed", "removed", "kept_sha256"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text",
                   group: int = GROUP) -> DataFrame:
    """Returns (id_col, n_bytes, n_removed, n_spans, kept_sha256, removed) per
    row; ``removed`` lists the maximal removed runs [start, end) in bytes."""
    ws = Workspace(docs.sparkSession, "suffix")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scan = ws.put(rows.mapInArrow(_scan(length), "doc_id long, n_bytes long, sha binary, keys array<long>, twice array<boolean>, grams array<binary>"),
                  compression="zstd")
    family = SuffixFamily(ws)
    for batch in range(batches):
        family.add(suffix_rows(scan.where(F.pmod(F.xxhash64("sha"), F.lit(batches)) == batch)))
    out = hit_spans(ws, rows, scan, family.hit_keys(), length, group)
    family.close()
    return out.withColumnRenamed("doc_id", id_col)


def hit_spans(ws: Workspace, rows: DataFrame, scan: DataFrame, keys: DataFrame, length: int, group: int) -> DataFrame:
    """What the matches at these keys remove from the scanned rows."""
    # one row of each text takes part; it is named by a number
    distinct = scan.groupBy("sha").agg(F.count("*").alias("rows"))
    distinct = ws.put(distinct.withColumn("rid", F.monotonically_increasing_id()))
    hits = scan.where(F.size("keys") > 0).select("sha", F.explode("keys").alias("key")).join(maybe_small(keys), "key", "left_semi")
    hits = hits.groupBy("sha").agg(F.collect_set("key").alias("keys"))  # of one text
    hits = ws.put(hits.join(distinct, "sha").select("rid", "sha", "keys"))

    # texts with hits, and what surrounds the hits
    need = ws.put(hits.select("sha"))
    texts = keep_ids(rows.select(F.unhex(F.sha2("text", 256)).alias("sha"), "text"), need, ["sha"])
    texts = ws.put(texts.join(hits, "sha").select("rid", "text", "keys").dropDuplicates(["rid"]), compression="zstd")
    found = ws.put(texts.mapInArrow(_surroundings(length), "kind int, rid long, place long, key long, c1 long, c2 long, l int, body binary, n long"),
                   text_batch=64, compression="zstd")
    around = found.where("kind = 1").select("key", "c1", "c2", "l", "body", "n")
    parts = around.groupBy("key").agg(F.ceil(F.count("*") / group).cast("int").alias("parts"))
    split = ws.put(parts.where("parts > 1"))
    around = around.join(F.broadcast(split) if split.limit(100_001).count() <= 100_000 else split, "key", "left").withColumn(
        "parts", F.coalesce("parts", F.lit(1))).withColumn("salt", F.pmod(F.col("c1"), F.col("parts")).cast("int"))
    around = around.repartition("key", "salt").sortWithinPartitions("key", "salt", "c1", "c2")
    runs = ws.put(around.mapInArrow(_compare(length), "kind int, key long, c1 long, c2 long, low int, high int, window binary, alone boolean"),
                  text_batch=2000)
    windows = runs.where("kind = 1")
    meet = windows.groupBy("key", "low", "window").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    late = windows.where("alone").join(meet, ["key", "low", "window"]).select("key", "c1", "c2", "low", F.col("low").alias("high"))
    runs = runs.where("kind = 0").select("key", "c1", "c2", "low", "high").unionByName(late)
    spans = found.where("kind = 0").select("rid", "place", "key", "c1", "c2").join(runs, ["key", "c1", "c2"]).select(
        "rid", F.struct((F.col("place") - F.col("high")).alias("start"), (F.col("place") - F.col("low") + length).alias("end")).alias("span"))
    spans = spans.groupBy("rid").agg(F.collect_set("span").alias("spans"))  # of one text
    left = ws.put(texts.join(spans, "rid").select("rid", "text", "spans").mapInArrow(
        _remove, "rid long, n_removed long, removed array<struct<start:long,end:long>>, kept_sha256 string"))
    ws.drop(texts, found, need, hits)

    out = scan.select("doc_id", "n_bytes", "sha").join(distinct, "sha").join(left, "rid", "left")
    whole = (F.col("rows") > 1) & (F.col("n_bytes") >= length)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    every = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    runs_of = F.when(whole, every).otherwise(F.coalesce("removed", F.array().cast("array<struct<start:long,end:long>>")))
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.size(runs_of).cast("long").alias("n_spans"),
        F.when(whole, empty).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
        runs_of.alias("removed"))
