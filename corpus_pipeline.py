"""The corpus pipeline: quality, near duplicates, benchmark passages, source mix and token files.

Every stage takes the documents that the one before it returned, as Parquet, and returns
documents (the last one: the token files' index). A stage works on all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm import decontaminate, jaccard_join, mixing, quality, token_files
from scriptorium.llm.queries import tokenizer_path
from scriptorium.tables import keep


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the suffix-array limits reject go."""
    return quality.measure(docs).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that links connect one stays: the one with the smallest doc_id (null last),
    then the smallest text hash. Each row is judged by its own text, whatever rows share its
    doc_id; of rows equal in both one stays, and rows without words all stay."""
    return jaccard_join.representatives(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tiles cover a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: one row for each pass that takes some of its words."""
    return mixing.documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token files, read back from them. Python workers serve all stages, so this
    one keeps little between tasks."""
    return token_files.round_trip(docs, tokenizer_path(), group_chars=2_000_000, cache=50_000, kept=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: Suffix arrays, tilings, permuted blocks and byte-level tokens are beyond SQL; the tests compare
#: the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another; each one's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
