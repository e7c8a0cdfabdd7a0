"""The corpus pipeline: five of the corpus operators in a row, over the whole documents table.

Each stage takes the documents its predecessor kept, written as Parquet and read again,
and returns documents (all columns), but for the last, which returns packed pieces.
Rejected documents go, boilerplate lines go from the texts of the others, one document
of each near-duplicate group stays, and documents that hold a benchmark item go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendlake.llm import decontaminate, quality, queries, simhash, toxicity
from trendlake.llm.text import stored
from trendlake.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: A trained classifier, fingerprints and a tokenizer are beyond SQL; tests/llm check the rows by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences (see ``trendlake.llm.packing``)."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
