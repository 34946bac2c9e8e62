"""The corpus pipeline: quality, near duplicates, repeated passages,
benchmark leaks, source mix.

Each stage takes ``(spark, docs, sf_dir)``; ``docs`` are the documents that
the stage before left, written and read again. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlake.llm import decontaminate, jaccard, mixing, quality, suffixes
from ballotlake.llm.shared import written


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside their language's perplexity limits (operator 8)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.classify(docs, quality.trusted_documents(docs, labels))
    return scored.where(F.col("keep")).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles,
    similarity 0.8 or more (operator 1)."""
    return jaccard.keep_one(docs, k=5, threshold=(4, 5))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without 400-byte strings that occur elsewhere (operator 5)."""
    return suffixes.without_repeats(docs, n=400)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items (operator 9)."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix and how many times each is taken
    (operator 10)."""
    return mixing.mixed_documents(docs)


STAGES = [("quality", good_text), ("near_duplicates", one_of_each), ("repeated_passages", without_repeats),
          ("benchmark_leaks", without_leaks), ("source_mix", source_mix)]

#: SQL cannot express the language model of the first stage nor the search
#: of the second; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
