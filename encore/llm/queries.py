"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.common import shared_dir
from encore.llm.compression_quality import quality_scores
from encore.llm.conversation_trie import rebuilt_trie
from encore.llm.exact_dedup import exact_groups
from encore.llm.labelled import bucket_of
from encore.llm.mixing import mix
from encore.llm.ngram_jaccard import ngram_components
from encore.llm.oracle_sql import ORACLES  # noqa: F401 (read by the entry module)
from encore.llm.quality_rules import quality_rules
from encore.llm.sentencepiece_scan import token_digests
from encore.llm.simhash import simhash_components
from encore.llm.suffix_dedup import remove_repeats
from encore.llm.token_counts import token_counts
from encore.llm.toxicity import toxicity_scores
from encore.llm.warc import warc_round_trip
from encore.llm.whitening import whiten

#: Target token shares: every source alike, languages and topics as listed.
MIX_TARGETS = {
    "source": {f"src{i}": 1.0 for i in range(20)},
    "lang": {"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.15},
    "topic": {"article": 0.45, "long": 0.3, "short": 0.2, "figures": 0.03, "markup": 0.01, "capitals": 0.01},
}
#: From this score on a document counts as label 1.
CUT = 0.7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), k=3, t=90)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("char_distance", "word_distance")})


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=400).drop("removed")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: n_pieces, pieces_sha256 (of the ids as 32-bit numbers)
    and whether the ids decode to the text again.  Every text of a chunk's
    length or more goes through the transfer matrices."""
    return token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"), min_revisit=1000)


def _predictions(scores: DataFrame, buckets: int, held: int) -> DataFrame:
    return scores.select("doc_id", (bucket_of("doc_id", buckets) == held).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=bucket_of("doc_id", 3) != 1)
    return _predictions(scores, 3, 1)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), MIX_TARGETS, budget=0.5)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=bucket_of("doc_id", 4) != 2)
    return _predictions(scores, 4, 2)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own that starts empty, so every distinct text is
    encoded; runs that share a cache folder encode only what is new."""
    cache = f"{shared_dir(spark).rstrip('/')}/encore-llm/token-cache-{uuid.uuid4().hex}"
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), cache)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_trie(table(spark, sf_dir, "conversations"), group=20, most=4)


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), k=3, distance=2)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=8)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_quality_rules": op2_quality_rules,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_warc": op5_warc,
    "op6_toxicity": op6_toxicity,
    "op7_mixing": op7_mixing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_compression_quality": op9_compression_quality,
    "op10_token_counts": op10_token_counts,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_simhash": op12_simhash,
    "op13_whitening": op13_whitening,
}
