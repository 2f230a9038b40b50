"""A training corpus in five stages, each a Spark job over all that the one before kept.

``run(spark, sf_dir)`` applies them to ``documents``; every stage's result is written as
Parquet in the shared folder and read again, so a lost executor costs tasks, not stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samesense.llm import decontaminate, lines, pieces, quality, simhash
from samesense.llm.queries import tokenizer_model
from samesense.storage import store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the others go."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines deleted where they come later; no document goes.

    ``n_chars`` follows the text.
    """
    shortened, count = lines.dedup_lines(docs)
    length = F.when(F.col(count) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return shortened.withColumn("n_chars", length).drop(count)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id.

    Near copies by SimHash over four-word shingles, at most four differing bits.
    """
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    encoded, name = pieces.encode(docs, tokenizer_model())
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        F.size(f"{name}.ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(f"{name}.ids", ","), 256).alias("ids_sha256"),
        F.col(f"{name}.decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

# SimHash, spaced seeds and the tokenizer have no SQL; tests/llm/test_pipeline.py holds
# every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
