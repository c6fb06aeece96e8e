"""Token counts with a digest cache.

A count is stored under two digests: of the content (SHA-256 of the text's
UTF-8 bytes; null is empty, nothing else is changed, as any other
normalisation could change the count) and of the tokenizer (SHA-256 over the
model file, the library and its version, and the options).  A run joins the
documents' digests to the stored counts, encodes each distinct digest that is
missing once, appends the new counts to the cache and returns all counts.

The cache is a Parquet table partitioned by the tokenizer's digest.  Every
run appends files of its own; a run that died leaves either whole files or
none, and a digest that two runs appended at once is read once.

Costs: digests of all documents are shuffled (about 50 bytes a row); texts
are not, while the rows that need no encoding (copies and hits) fit a
broadcast (``keep_ids``), and once beyond that.

Defined cases: rows with a null id are counted like others; repeated rows
come back as often as they came; an empty text has no token.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from encore.llm.common import Workspace, keep_ids, texts_of

CACHE = "digest binary, n_tokens long, tokenizer string"


def load_tokenizer(path: str):
    """A function list[str] -> list[int] for .model (sentencepiece) and .json
    (tokenizers) files, with the library's defaults, nothing added."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [len(x.ids) for x in tok.encode_batch(texts, add_special_tokens=False)]


def tokenizer_digest(path: str) -> str:
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        data = f.read()
    options = f"{library.__name__} {library.__version__} no added tokens, no truncation"
    return hashlib.sha256(data + options.encode()).hexdigest()


def _count(path: str):
    def run(batches):
        count = load_tokenizer(path)
        for batch in batches:
            digests = batch.column(0)
            counts: list[int] = []
            some: list[str] = []
            size = 0
            for text in texts_of(batch):
                some.append(text.decode("utf-8", "surrogatepass"))
                size += len(text)
                if size > 1 << 20:
                    counts += count(some)
                    some, size = [], 0
            if some:
                counts += count(some)
            yield pa.RecordBatch.from_arrays([digests, pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return run


def read_cache(spark, path: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer; empty where there is no cache."""
    try:
        stored = spark.read.schema(CACHE).parquet(path)
    except AnalysisException:
        stored = spark.createDataFrame([], CACHE)
    return stored.where(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, model_path: str, cache_path: str, limit: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (id_col, n_bytes, n_tokens, over_limit) per row of ``docs``."""
    spark = docs.sparkSession
    ws = Workspace(spark, "tokens")
    tokenizer = tokenizer_digest(model_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    digests = ws.put(rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest))

    # one row speaks for each digest that is not stored; repeated rows of the
    # same id and text are told apart by nothing, so they are merged below
    speaker = digests.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first"), F.count("*").alias("rows"))
    speaker = ws.put(speaker.join(read_cache(spark, cache_path, tokenizer).withColumn("hit", F.lit(True)), "digest", "left").select(
        "digest", F.col("first.doc_id").alias("speaker"), "rows", F.coalesce("hit", F.lit(False)).alias("hit")))
    silent = speaker.where("hit or rows > 1").join(digests.select("doc_id", "digest"), "digest").where(
        F.col("hit") | ~F.col("doc_id").eqNullSafe(F.col("speaker")))
    silent = ws.put(silent.select(F.xxhash64("doc_id", "digest").alias("row"), "digest").distinct())
    named = rows.select(F.xxhash64("doc_id", F.unhex(F.sha2("text", 256))).alias("row"), digest, "text")
    todo = keep_ids(named, silent, ["row", "digest"], "left_anti").select("digest", "text")
    if not digests.groupBy("doc_id", "digest").count().where("count > 1").isEmpty():
        todo = todo.dropDuplicates(["digest"])
    fresh = ws.put(todo.mapInArrow(_count(model_path), "digest binary, n_tokens long"), text_batch=128)
    fresh.withColumn("tokenizer", F.lit(tokenizer)).write.mode("append").partitionBy("tokenizer").parquet(cache_path)
    ws.drop(fresh, speaker, silent)

    # staged, so that a digest of many rows is only joined, which splits it
    counts = ws.put(read_cache(spark, cache_path, tokenizer))
    return digests.join(counts, "digest").select(
        F.col("doc_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
