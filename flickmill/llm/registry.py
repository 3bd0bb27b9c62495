"""Registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flickmill.llm import chat, decontaminate, jaccard, lines, manifest, neighbours, packing, pii, prefixes, quality, secrets, substrings, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {"op8_line_dedup": lines.SQL, "op11_merkle_manifest": manifest.SQL, "op13_prefix_trie": prefixes.SQL}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen-path join of all documents' 5-word shingle sets at a similarity of 0.8: classes and numbers of links."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), n=5, threshold=0.8)


@query
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental rendering of all conversations and of conversation -7, whose texts hold control strings."""
    text = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digest(chat.formatted(rows))


@query
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of each vector whose id is divisible by 50, among all others, by a forest of projection trees."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 50 = 0"), k=5)


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level-wise doubling over all documents: words in 50-word windows that an earlier document has go."""
    return substrings.deduplicated(table(spark, sf_dir, "documents"), window=50, with_text=False)


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Karmarkar-Karp packing of all documents into sequences of at most 1024 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), capacity=1024, with_ids=False, special=True)


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compression scores of all documents, learned from labels outside the held-out fold."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


@query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wu-Manber search of all documents for 10-word windows of the benchmark."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletion-neighbourhood join of all documents' lines within one word: later lines go, the earliest stays."""
    return lines.deduplicated(table(spark, sf_dir, "documents"))


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns and the randomness battery over all documents."""
    return secrets.secrets(table(spark, sf_dir, "documents"))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns and the semi-Markov field over all documents."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents by source, and every row's proof, with every second text tampered with."""
    return manifest.digests(table(spark, sf_dir, "documents"))


@query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Convolutional scores of all documents, learned from labels outside the held-out fold."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), cut=0.5)


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, their beginnings exchanged within each five ids."""
    return prefixes.spliced_trie(table(spark, sf_dir, "conversations"))
