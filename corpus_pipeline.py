"""Corpus pipeline: quality, line dedup, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
it kept; its result is written below ``spark.checkpoint.dir`` and read again as
the next one's docs. All but the last return the columns of ``documents``; rows
with null or empty texts pass the filters and are packed as one id 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flickmill.llm import decontaminate, jaccard, lines, packing, quality
from flickmill.llm.scratch import written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier (learned from these documents and ``labels``) does not reject."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats, exactly or within one word; emptied ones go."""
    return lines.cleaned(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group linked by 5-word shingles at a similarity of 0.8."""
    return jaccard.first_of_each(docs, n=5, threshold=0.8)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of the benchmark."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return packing.packed(docs, capacity=1024, with_ids=False, special=True)


STAGES = [("quality", keep_quality), ("line_dedup", dedup_lines), ("near_duplicates", dedup_documents),
          ("decontamination", decontaminate_benchmark), ("packing", pack)]

#: SQL cannot express the classifier or the tokenizer; tests/llm/test_pipeline.py compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
