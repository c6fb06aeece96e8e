"""SentencePiece encoding by the model's own method.

Models of BPE type are encoded by merging, as the library does it: a text in
one call, a text of ``chunk`` characters or more in chunks, in parallel.  No
piece of such a model holds a space after another character, so no merge
crosses the start of a word (a run of spaces and what follows up to the next),
and every word can be merged on its own.  A chunk merges the words that lie
inside it; a word that crosses a cut is put together from its parts, by the
chunk that it starts in, and merged whole, whatever its length.  A model with
such pieces is encoded text by text, uncut.

Models of unigram type take the max-plus scan (``sentencepiece_scan``); others
are refused.  Normalisation and defined cases are those of the scan.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm import sentencepiece_scan as scan
from encore.llm.common import Workspace, texts_of

#: Characters that one call of the library takes, over all its texts.
CALL = 1 << 20
_UNIGRAM, _BPE = 1, 2
_loaded: dict[str, object] = {}


def _proto(path: str):
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    model = model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return model


def _merger(path: str):
    """The library's encoder for texts that are normalised already."""
    if path not in _loaded:
        from sentencepiece import SentencePieceProcessor

        model = _proto(path)
        model.normalizer_spec.add_dummy_prefix = False
        _loaded[path] = SentencePieceProcessor(model_proto=model.SerializeToString())
    return _loaded[path]


def merged(path: str, full: list[str]) -> list[np.ndarray]:
    """Ids of normalised texts."""
    out: list[np.ndarray] = []
    held: list[str] = []
    size = 0
    for at, text in enumerate(full):
        held.append(text)
        size += len(text)
        if size >= CALL or at == len(full) - 1:
            out += [np.array(x, dtype=np.int32) for x in _merger(path).encode(held, out_type=int, num_threads=1)]
            held, size = [], 0
    return out


def _ids(values: list[np.ndarray]) -> pa.Array:
    return pa.array(values, pa.list_(pa.int32()))


def _whole(path: str, fields: list[str], out_names: list[str]):
    def run(batches):
        for batch in batches:
            ids = merged(path, [scan.normalised(t.decode("utf-8", "surrogatepass")) for t in texts_of(batch)])
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(f)) for f in fields), _ids(ids)], out_names)

    return run


def word_parts(part: str, first: bool) -> tuple[str, str, str]:
    """(end of a word that starts before, whole words, start of the last word)
    of a chunk; ``part`` has the character before the chunk in front, if it is
    not the first."""
    codes = scan.code_points(part)
    space = codes == ord(scan.SPACE)
    starts = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    begin = 0 if first else 1
    if first:
        starts = np.concatenate(([0], starts))
    if not len(starts):
        return part[begin:], "", ""
    return part[begin:starts[0]], part[starts[0]:starts[-1]], part[starts[-1]:]


PARTS = "rid long, no int, head string, ids array<int>, tail string"


def _cut(path: str, chunk: int):
    def run(batches):
        for batch in batches:
            for rid, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                full = scan.normalised(text.decode("utf-8", "surrogatepass"))
                for no, at in enumerate(range(0, len(full), chunk)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rid], pa.int64()), pa.array([no], pa.int32()), pa.array([full[max(0, at - 1):at + chunk]], pa.string())],
                        ["rid", "no", "part"])

    return run


def _chunks(path: str):
    def run(batches):
        for batch in batches:
            numbers = batch.column(1).to_pylist()
            parts = [word_parts(p, no == 0) for p, no in zip(batch.column(2).to_pylist(), numbers, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([p[0] for p in parts], pa.string()), _ids(merged(path, [p[1] for p in parts])),
                 pa.array([p[2] for p in parts], pa.string())], ["rid", "no", "head", "ids", "tail"])

    return run


def _crossing(path: str):
    def run(batches):
        for batch in batches:
            words = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _ids(merged(path, words))], ["rid", "no", "ids"])

    return run


def _long_ids(ws: Workspace, rows: DataFrame, path: str, chunk: int) -> DataFrame:
    """(rid, ids) of texts that are cut into chunks."""
    parts = ws.put(rows.mapInArrow(_cut(path, chunk), "rid long, no int, part string"), text_batch=1, compression="zstd")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = ws.put(parts.repartition(tasks, "rid", "no").mapInArrow(_chunks(path), PARTS), text_batch=64, compression="zstd")
    # a head belongs to the last chunk before that has the start of a word
    before = Window.partitionBy("rid").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    owners = chunks.select("rid", "no", F.when(F.col("tail") != "", F.col("no")).alias("own")).select(
        "rid", "no", F.last("own", ignorenulls=True).over(before).alias("owner"))
    heads = chunks.where("head != ''").select("rid", "no", "head").join(owners, ["rid", "no"]).select(
        "rid", F.col("owner").alias("own"), "no", F.col("head").alias("part"))
    tails = chunks.where("tail != ''").select("rid", F.col("no").alias("own"), "no", F.col("tail").alias("part"))
    # a chunk's own tail comes before the heads that go on with it
    words = tails.unionByName(heads).groupBy("rid", "own").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "part"))), lambda x: x["part"]), "").alias("word"))
    words = words.select("rid", F.col("own").alias("no"), "word").repartition(tasks, "rid", "no")
    words = ws.put(words.mapInArrow(_crossing(path), "rid long, no int, ids array<int>"), text_batch=64)
    pieces = chunks.select("rid", "no", F.lit(0).alias("after"), "ids").unionByName(words.select("rid", "no", F.lit(1).alias("after"), "ids"))
    out = ws.put(pieces.groupBy("rid").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("no", "after", "ids"))), lambda x: x["ids"])).alias("ids")))
    ws.drop(parts, chunks, words)
    return out


def encode(docs: DataFrame, model_path: str, text_col: str = "text", chunk: int = scan.CHUNK, ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``ids_col``, the piece ids of the whole text as the model
    itself gives them."""
    kind = _proto(model_path).trainer_spec.model_type
    if kind == _UNIGRAM:
        return scan.encode(docs, model_path, text_col, chunk, ids_col)
    if kind != _BPE:
        raise ValueError("this model is neither of BPE nor of unigram type")
    if not scan._load(model_path).words:
        chunk = (1 << 31) - 1
    spark = docs.sparkSession
    ws = Workspace(spark, "sentencepiece")
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = docs.columns
    short = docs.where(F.length(text) < chunk)
    renamed = short.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], text.alias("text"))
    fields = [f"c{i}" for i in range(len(names))]
    ids_of = T.StructType([*[T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)],
                           T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    whole = renamed.mapInArrow(_whole(model_path, fields, [*fields, ids_col]), ids_of).toDF(*names, ids_col)
    named = docs.where(F.length(text) >= chunk).withColumn("_rid", F.monotonically_increasing_id())
    named = ws.put(named, compression="zstd", text_batch=16)
    ids = _long_ids(ws, named.select(F.col("_rid").alias("rid"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), model_path, chunk)
    cut = named.join(ids.withColumnsRenamed({"rid": "_rid", "ids": ids_col}), "_rid").select(*names, ids_col)
    return whole.unionByName(cut)
