"""From raw documents to a training mix: each stage takes the documents that the one before it kept.

All stages but the last return the columns of documents; the last adds each document's place in training.
Every stage is written as Parquet to the shared folder and read again, so a lost executor costs one stage; tables that it wrote on its
way are deleted then, and its own once the next one is written. Null, empty and very long texts, null ids, repeated rows, empty tables and further columns are
handled as the operators' docstrings say: texts without a letter go in the first stage, and of equal rows one stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import decontaminate, jaccard_join, language_id, mixing, pii
from tidegrid.llm._frames import alone, discard


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letters or are like no language that the corpus labels."""
    return language_id.keep_known_languages(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-copy group, by five-word shingles and a similarity of 0.8."""
    return jaccard_join.keep_one_of_each_group(docs, n=5, threshold=80)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of benchmark items, and without documents that are mostly such."""
    return decontaminate.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.mask_spans(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With the words taken of each document and its position in training, in the order of position."""
    return mixing.mix_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_languages),
    ("jaccard_join", without_near_copies),
    ("decontamination", without_benchmarks),
    ("pii", without_personal_data),
    ("mixing", mixed),
]

#: Language profiles, similarity components and the span classifier are no SQL; tests/llm holds a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = alone(spark, name, lambda: stage(spark, docs, sf_dir))  # noqa: B023  called before the loop goes on
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
