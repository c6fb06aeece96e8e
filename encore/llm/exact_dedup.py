"""Exact duplicates by composable polynomial fingerprints.

Texts are equal when identical after every run of white space is replaced by
one space.  The fingerprint of a byte string b of length n is
``sum(b[i] * B**(n-1-i)) mod p`` for two primes; the fingerprint of a
concatenation is ``H(x) * B**len(y) + H(y)``, so the pieces of a huge text are
hashed on their own, in any task, and combined by length-shifted arithmetic.

1. Texts of more than ``piece_chars`` characters are dealt out as pieces; all
   others are one piece.  A piece starts with the last character of the one
   before, so a run of white space that spans the cut yields one space.
2. Pieces combine per row; (fingerprints, length) groups the rows.
3. Rows that share a fingerprint are compared with the group's smallest id,
   chunk by chunk: chunk k of the member against chunk k of that document.
   A large group's members are dealt over salts, SALTED of them a salt, and
   that document's chunks are there once per salt.
   Members that differ anywhere (a collision) form a new round among
   themselves, until no group is left.

Defined cases: null counts as empty; empty texts are equal to each other;
rows with equal ids and equal texts: one of them stays.  Rows with a null id
are grouped like others; the null sorts last, so it is kept only where no row
with an id is equal.  Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import WS, Workspace, keep_ids, texts_of, tidy

PRIMES = (2147483629, 2147483587)
BASES = (1103515245, 1812433253)
#: Bytes hashed at once: 255 * 2**31 * BLOCK stays below 2**63.
BLOCK = 1 << 16
#: Characters above which a text is dealt out in pieces.
PIECE_CHARS = 1 << 20
#: Members of a group that meet the kept document's chunks in one place.
SALTED = 1000
#: Bytes of a chunk that two equal-looking texts are compared by.
CHUNK = 1 << 16

_TO_SPACE = bytes.maketrans(bytes(range(0x09, 0x0E)), b" " * 5)
_RUN = re.compile(rb"  +")


def normalise(text: bytes) -> bytes:
    """Every run of white space as one space."""
    return _RUN.sub(b" ", text.translate(_TO_SPACE))


def _weights(prime: int, base: int) -> np.ndarray:
    out = [1]
    for _ in range(BLOCK - 1):
        out.append(out[-1] * base % prime)
    return np.array(out[::-1], dtype=np.uint64)


_W: dict[tuple[int, int], np.ndarray] = {}


def combine(left: tuple[int, int], right: tuple[int, int], right_len: int, primes=PRIMES) -> tuple[int, ...]:
    """Fingerprint of a concatenation from those of its parts."""
    return tuple((h * pow(b, right_len, p) + g) % p for h, g, b, p in zip(left, right, BASES, primes, strict=True))


def fingerprint(data: bytes, primes=PRIMES) -> tuple[int, ...]:
    got: tuple[int, ...] = (0,) * len(primes)
    for at in range(0, len(data), BLOCK):
        part = np.frombuffer(data, np.uint8, min(BLOCK, len(data) - at), at).astype(np.uint64)
        own = []
        for p, b in zip(primes, BASES, strict=True):
            if (p, b) not in _W:
                _W[p, b] = _weights(p, b)
            own.append(int(np.dot(part, _W[p, b][BLOCK - len(part):])) % p)
        got = combine(got, tuple(own), len(part), primes)
    return got


def _pieces(primes, piece_chars: int):
    names = ["rid", "doc_id", "piece", "pieces", "h1", "h2", "bytes", "sha"]

    @tidy
    def run(batches):
        for batch in batches:
            col = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names) if n != "text"}
            h1, h2, size, sha = [], [], [], []
            for text, piece, pieces in zip(texts_of(batch), col["piece"], col["pieces"], strict=True):
                data = normalise(text)
                if piece:  # drop the character of the piece before, and a space that belongs to it
                    lead = next(i for i in range(1, 5) if i == len(text) or text[i] & 0xC0 != 0x80)
                    data = normalise(text[lead:])
                    if text[0] in b"\t\n\v\f\r " and data[:1] == b" ":
                        data = data[1:]
                a, b = fingerprint(data, primes)
                h1.append(a)
                h2.append(b)
                size.append(len(data))
                sha.append(hashlib.sha256(data).hexdigest() if pieces == 1 else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(col["rid"], pa.string()), pa.array(col["doc_id"], pa.int64()), pa.array(col["piece"], pa.int32()), pa.array(col["pieces"], pa.int32()),
                 pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(size, pa.int64()), pa.array(sha, pa.string())], names)

    return run


def _join_pieces(primes):
    def run(frame):
        import pandas as pd

        frame = frame.sort_values("piece")
        got, size = (0, 0), 0
        for h1, h2, n in zip(frame["h1"], frame["h2"], frame["bytes"], strict=True):
            got, size = combine(got, (int(h1), int(h2)), int(n), primes), size + int(n)
        return pd.DataFrame({"rid": [frame["rid"].iloc[0]], "h1": [got[0]], "h2": [got[1]], "bytes": [size]})

    return run


def _chunks(batches):
    """Normalised texts cut into chunks of CHUNK bytes."""
    for batch in batches:
        rid = batch.column(batch.schema.get_field_index("rid")).to_pylist()
        for r, text in zip(rid, texts_of(batch), strict=True):
            data = normalise(text)
            parts = [data[i:i + CHUNK] for i in range(0, len(data), CHUNK)] or [b""]
            for begin in range(0, len(parts), 64):
                some = parts[begin:begin + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r] * len(some), pa.string()), pa.array(range(begin, begin + len(some)), pa.int32()), pa.array(some, pa.binary())],
                    ["rid", "no", "chunk"])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 primes: tuple[int, int] = PRIMES, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Returns (id_col, keep_id, group_size, kept, text_sha256) per row."""
    spark = docs.sparkSession
    ws = Workspace(spark, "exact")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # a row's name: its id, its text's digest and, for repeated rows, nothing more
    named = rows.select(
        F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.sha2(text, 256)).alias("rid"),
        "doc_id", text.alias("text"))
    size = F.length("text")
    cut = named.select("rid", "doc_id", F.when(size > piece_chars, F.ceil(size / piece_chars)).otherwise(1).cast("int").alias("pieces"), "text")
    one = cut.where("pieces = 1").select("rid", "doc_id", F.lit(0).alias("piece"), "pieces", "text")
    many = cut.where("pieces > 1").select("rid", "doc_id", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.col("pieces") - 1),
        lambda i: F.when(i == 0, F.substring("text", F.lit(1), F.lit(piece_chars))).otherwise(
            F.substring(F.col("text"), i * piece_chars, F.lit(piece_chars + 1))))).alias("piece", "text"), "pieces")
    schema = "rid string, doc_id long, piece int, pieces int, h1 long, h2 long, bytes long, sha string"
    hashed = ws.put(one.unionByName(many.repartition("rid", "piece")).mapInArrow(_pieces(primes, piece_chars), schema))
    whole = hashed.where("pieces = 1").select("rid", "doc_id", "h1", "h2", "bytes", "sha")
    huge = hashed.where("pieces > 1").dropDuplicates(["rid", "piece"]).groupBy("rid").applyInPandas(
        _join_pieces(primes), "rid string, h1 long, h2 long, bytes long")
    # a digest over a whole text is sequential: in the row, in the JVM
    big = named.where(F.length("text") > piece_chars).select("rid", "doc_id", F.sha2(F.regexp_replace("text", f"[{WS}]+", " "), 256).alias("sha"))
    whole = ws.put(whole.unionByName(big.join(huge, "rid").select(*whole.columns)))

    # groups of equal fingerprints, compared chunk by chunk with the smallest id
    key = ["h1", "h2", "bytes"]
    names = whole.groupBy("rid", "doc_id", *key).agg(F.count("*").alias("rows"))
    left = ws.put(names)
    settled = []
    while True:
        first = left.groupBy(*key).agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid")).alias("k"), F.count("*").alias("texts"), F.sum("rows").alias("all_rows"))
        first = ws.put(first)
        members = ws.put(left.join(first.where("texts > 1"), key).select(
            "rid", F.col("k.rid").alias("keep_rid"), F.ceil(F.col("texts") / SALTED).cast("long").alias("salts")))
        texts = keep_ids(named.select("rid", "text"), ws.put(members.select("rid").distinct()), ["rid"]).dropDuplicates(["rid"])
        chunks = ws.put(texts.mapInArrow(_chunks, "rid string, no int, chunk binary"))
        mine = chunks.join(members.where("rid != keep_rid"), "rid").withColumn("salt", F.pmod(F.xxhash64("rid"), F.col("salts")))
        theirs = chunks.join(members.where("rid = keep_rid"), "rid").select(
            "keep_rid", "no", F.col("chunk").alias("other"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
        unlike = ws.put(mine.join(theirs, ["keep_rid", "no", "salt"], "left").where(
            ~F.col("chunk").eqNullSafe(F.col("other"))).select("rid").distinct())
        ws.drop(chunks)
        equal = left.join(unlike, "rid", "left_anti").join(first, key).select(
            "rid", F.col("k.doc_id").alias("keep_id"), F.col("k.rid").alias("keep_rid"), "rows")
        settled.append(ws.put(equal))
        left = ws.put(left.join(unlike, "rid", "left_semi"))
        if left.isEmpty():
            break
    equal = settled[0]
    for more in settled[1:]:
        equal = equal.unionByName(more)
    # staged, so that a large group is only joined, which splits it
    groups = ws.put(equal.groupBy("keep_rid").agg(F.sum("rows").alias("group_size")))
    found = equal.join(groups, "keep_rid").select("rid", "keep_id", "keep_rid", "group_size")
    out = whole.select("rid", "doc_id", "sha").join(found, "rid")
    # of repeated rows (same id, same text) one stays
    twin = out.where("rid = keep_rid").groupBy("rid").agg(F.count("*").alias("twins")).where("twins > 1")
    out = ws.put(out)
    if twin.isEmpty():
        kept = out.withColumn("kept", F.col("rid") == F.col("keep_rid"))
    else:
        order = Window.partitionBy("rid").orderBy("sha")
        one = out.where("rid = keep_rid").withColumn("kept", F.row_number().over(order) == 1)
        kept = one.unionByName(out.where("rid != keep_rid").withColumn("kept", F.lit(False)))
    return kept.select(F.col("doc_id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept",
                       F.col("sha").alias("text_sha256"))
