"""Intermediate tables below the shared folder that the cluster names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from flickmill.session import scratch_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written as Parquet below ``spark.checkpoint.dir`` and read again: its lineage is cut."""
    path = scratch_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
