"""Sinks: whole-table replace, load of the three base tables, per-key upsert.

Replacing a table that the same job reads is done by writing a new version
folder and then appending the version number to a small manifest table;
readers take the newest version listed in the manifest, so a crash while
writing never exposes a half-written table.
"""

from __future__ import annotations

import os
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, **options) -> str:
    """K1: replace a whole result table."""
    w = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def read_back(df: DataFrame, path: str) -> DataFrame:
    """The frame, written as Parquet and read again: later uses scan the table and do not replay its plan."""
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_all(movies: DataFrame, ratings: DataFrame, tags: DataFrame, out: str,
             fmt: str = "parquet") -> dict[str, str]:
    """K2: drop and load the three base tables (overwrite is the drop)."""
    paths = {}
    for name, df in (("Movie", movies), ("Rating", ratings), ("Tag", tags)):
        paths[name] = write_table(df, os.path.join(out, name), fmt=fmt)
    return paths


def write_version(df: DataFrame, root: str, version: int | None = None) -> int:
    """Write ``df`` as a new immutable version of the table at ``root``."""
    v = int(version if version is not None else time.time_ns() // 1000)
    df.write.mode("overwrite").parquet(os.path.join(root, f"v={v}"))
    commit_version(df.sparkSession, root, v)
    return v


def commit_version(spark: SparkSession, root: str, version: int) -> None:
    """Make a version, written in full before, the one that readers of ``root`` take."""
    spark.range(1, numPartitions=1).select(F.lit(version).cast("long").alias("version")).write.mode("append").parquet(os.path.join(root, "_manifest"))


def current_version(spark: SparkSession, root: str) -> int | None:
    """Number of the newest committed version below ``root``, or None when there is none."""
    try:
        man = spark.read.schema("version long").parquet(os.path.join(root, "_manifest"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    row = man.agg(F.max("version").alias("v")).first()
    return None if row is None else row["v"]


def read_current(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    """Newest committed version of a versioned table, or None when there is none."""
    version = current_version(spark, root)
    if version is None:
        return None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(os.path.join(root, f"v={version}"))


def upsert_user_recs(stored: DataFrame, new: DataFrame, key: str = "uid") -> DataFrame:
    """K3: replace the rows of every key present in ``new`` (also by an empty list)."""
    cols = stored.columns
    keys = new.select(key).distinct()
    return stored.join(keys, key, "left_anti").select(*cols).unionByName(new.select(*cols))


def search_docs(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """K4: one search document per movie: movie fields + its distinct tags
    joined by a bar (null when the movie has no tag)."""
    from flickmill.operators.stats import tags_per_movie
    return movies.join(tags_per_movie(tags), "mid", "left")
