"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Spread a skinny scan over the cluster.

    A table stored as one unsplittable file (one parquet row group) is read by
    a single task, and every row-local step before the first shuffle runs on
    one core. When the scan has fewer splits than the default parallelism it is
    redistributed (round-robin, or hashed on ``key`` so that later groupings by
    that key need no further shuffle); a table with enough splits (the normal
    case for large data) is returned unchanged. Column pruning and filters
    still reach the scan below the exchange."""
    sc = df.sparkSession.sparkContext
    want = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key) if key else df.repartition(want)
