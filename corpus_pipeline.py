"""The corpus pipeline: from raw documents to token ids, in five stages.

Every stage works on all documents that its predecessor kept, and all but the last return the columns
of ``documents``. The intermediate tables of a stage are deleted when the next one starts.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import decontaminate, fuzzy_lines, ngram_join, piece_ids, quality
from cartwise.llm.arrow import bounded
from cartwise.llm.bounded import small
from cartwise.llm.queries import QUALITY_LIMIT, fold
from cartwise.session import clear_scratch, materialise, ready, use_part

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from labelled documents outside fold 0 of 5."""
    labelled = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold("doc_id", 5) != 0)
    scored = quality.score(docs, quality.train(docs, labelled), into="quality_score")
    return scored.filter(F.col("quality_score") >= QUALITY_LIMIT).drop("quality_score")


def keep_first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier line, exactly or nearly; a document may become empty."""
    left = fuzzy_lines.dedup_lines(docs, settings=fuzzy_lines.CORPUS).drop("lines", "lines_removed")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id."""
    found = ngram_join.similar_documents(docs)
    gone = materialise(found.filter("component_id < doc_id").select("doc_id").distinct(), "similar")
    return docs.join(small(gone), "doc_id", "left_anti").select(docs.columns)


def keep_clear_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(docs, benchmark).filter("contaminated")
    gone = materialise(found.select(F.col("doc_id").alias("k"), F.col("text_hash").alias("t")), "contaminated")
    own = docs.withColumn("text hash", F.xxhash64("text"))
    return own.join(small(gone), own.doc_id.eqNullSafe(F.col("k")) & (own["text hash"] == F.col("t")), "left_anti").select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids``: token ids with begin and end, little-endian 32-bit."""
    texts = docs.select("doc_id", "lang", "source", "text")
    counts = materialise(piece_ids.word_counts(texts), "words")
    encoded = piece_ids.encode(texts, piece_ids.segment_table(counts, MODEL), MODEL)
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def _stage(number: int, function: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """The function with a place for its intermediate tables, where those of its predecessor are deleted."""

    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for other in {(number - 1) % 5, number}:
            use_part(bounded(ready(spark)), f"stage-{other}")
            clear_scratch(spark)
        return function(spark, docs, sf_dir)

    stage.__doc__ = function.__doc__
    return stage


STAGES = [
    (function.__name__, _stage(number, function))
    for number, function in enumerate((keep_quality, keep_first_lines, keep_one_of_similar, keep_clear_of_benchmark, encode_pieces))
]

#: The classifier has no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        use_part(spark, "")
        docs = materialise(result, "documents")
    return docs
