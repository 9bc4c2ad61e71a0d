"""From raw documents to a training mixture: five stages, each a job of its own over what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from visitlake.llm import decontaminate, language, mixing, secret_scan, simhash
from visitlake.sources.files import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told."""
    return language.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every SimHash group."""
    return simhash.keep_one_per_group(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, verbatim or edited."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets inside texts; every document stays."""
    return secret_scan.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: which document stands where, and how often (block, position, doc_id, source, copy, n_tokens)."""
    return mixing.mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("secret_scan", redact_secrets),
    ("mix", mix),
]

# The language model has no SQL form; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs the stages over the documents; what each returns is stored in the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
