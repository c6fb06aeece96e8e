"""The corpus pipeline: documents in, encoded training documents out.

Every stage takes (spark, docs, sf_dir) and works on all that the stage
before kept; ``run`` writes each stage's result as Parquet in the shared
folder and reads it again as the next one's documents.  All stages but the
last return the columns of ``documents``, whatever they are, unchanged.

Defined cases: an empty table stays empty; rows with a null id cannot be
named by a decision and stay (copies of each other are merged); a null text
counts as empty; repeated rows become one in the second stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.common import WS, Workspace, keep_ids
from encore.llm.compression_quality import quality_scores
from encore.llm.exact_dedup import exact_groups
from encore.llm.mixing import mix
from encore.llm.ngram_jaccard import ngram_components
from encore.llm.queries import CUT, MIX_TARGETS, table, tokenizer_path
from encore.llm.sentencepiece_scan import ROWS, SPACE, decode
from encore.llm.sentencepiece_scan import encode_only as encode

#: Share of the tokens that reach the mixing stage and stay.
MIX_BUDGET = 0.9


def _leave(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows of these ids; the ids are written first, so
    that their number is known before the join."""
    dropped = Workspace(docs.sparkSession, "dropped").put(ids.distinct())
    return keep_ids(docs, dropped, ["doc_id"], "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Compression classifier; documents it rejects go."""
    scores = quality_scores(docs, table(spark, sf_dir, "labels"))
    return _leave(docs, scores.where(F.col("score") < CUT).select("doc_id"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact copies: the row with the smallest id stays; of repeated rows of
    one id, one."""
    groups = Workspace(spark, "groups").put(exact_groups(docs))
    stay = groups.where("kept").select("doc_id")
    left = _leave(docs, groups.where("not kept").select("doc_id").join(stay, "doc_id", "left_anti"))
    if groups.groupBy("doc_id").count().where("count > 1").isEmpty():
        return left
    body = F.regexp_replace(F.coalesce("text", F.lit("")), f"[{WS}]+", " ")
    return left.withColumn("_body", body).dropDuplicates(["doc_id", "_body"]).drop("_body")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies (five-word shingles, similarity 0.8): one document of each
    group stays, the one with the smallest id."""
    groups = ngram_components(docs, k=5, t=80, links=False)
    return _leave(docs, groups.where("component_id < doc_id").select("doc_id"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights."""
    chosen = mix(docs, MIX_TARGETS, budget=MIX_BUDGET)
    return _leave(docs, chosen.where("not sampled").select("doc_id"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the piece ids of their whole texts in place of the
    texts, and whether the ids, read again, decode to the text (a U+2581 reads
    back as a space); the text goes along as its digest."""
    path = tokenizer_path()
    want = F.sha2(F.translate(F.coalesce("text", F.lit("")), SPACE, " "), 256)
    out = decode(encode(docs.withColumn("_want", want), path), path, out_col="_decoded")
    told = {"n_tokens": F.size("token_ids").cast("long"), "round_trip": F.sha2("_decoded", 256) == F.col("_want")}
    return Workspace(spark, "tokens").put(out.withColumns(told).drop("_want", "_decoded"), text_batch=ROWS)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        after = ws.put(stage(spark, docs, sf_dir))
        if before is not None:
            ws.drop(before)
        before = docs = after
    return docs


#: The classifier cannot be written in SQL; the stages are tested one by one.
ORACLE_SQL = None
