"""The stream store folds batches without sorting or ranking what they do not change, and commits without Python."""

from __future__ import annotations

import re

import pytest

from flickmill.sources import sinks
from flickmill.streaming import stream as st


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"(?s)\n\n.*", "", text)


def test_fold_hashes_new_pairs_and_keeps_users_without_events(spark, tmp_path):
    """all stored pairs were sorted, and all users ranked anew, to fold the events of a few."""
    pairs = spark.createDataFrame([(1, 1, 4.0, 10), (1, 1, 3.0, 11), (2, 1, 2.0, 5), (None, 1, 1.0, 1)], "uid int, mid int, score double, timestamp int")
    log = spark.createDataFrame([(2, 1, 5.0, 9, 1, 0), (3, 2, 1.0, 9, 2, 0), (None, 1, 2.0, 9, 3, 0)], "uid int, mid int, score double, timestamp int, seq long, epoch long")
    both = st._merged(pairs, log)
    assert re.search(r"ShuffledHashJoin.*FullOuter", plan(both))
    assert sorted(map(tuple, both.collect()), key=str) == sorted(
        [(1, 1, 4.0, 10), (1, 1, 3.0, 11), (2, 1, 5.0, 5), (3, 2, 1.0, 9), (None, 1, 1.0, 1), (None, 1, 2.0, 9)], key=str)

    store = st.StreamStore(str(tmp_path / "store"), buckets=2, keep=2)
    st.init_store(store, spark.createDataFrame([(1, m, 4.0, m) for m in range(4)] + [(2, 7, 1.0, 5), (None, 4, 2.0, 6)], "uid int, mid int, score double, timestamp int"))
    st._write_partition(log.where("uid = 2").select("uid", "mid", "score", "timestamp", "seq", st._bucket(store).alias("bucket")), store.path("events"), 0, "bucket")
    st._write_partition(spark.sql("SELECT 2 AS uid, 7 AS mid, 1D AS score"), store.path("stream_recs"), 0)
    st.compact(spark, store, 0)
    recent = st.read_base(spark, store).recent
    assert sorted(map(tuple, recent.select("uid", "mid", "score", "timestamp", "epoch").collect()), key=str) == sorted(
        [(1, 3, 4.0, 3, -1), (1, 2, 4.0, 2, -1), (2, 1, 5.0, 9, 0), (2, 7, 1.0, 5, -1), (None, 4, 2.0, 6, -1)], key=str)


def test_versions_are_committed_without_python(spark, tmp_path, monkeypatch):
    """each written version unpickled a one-row list in as many tasks as there are cores."""
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: pytest.fail("a local list is unpickled"))
    sinks.commit_version(spark, str(tmp_path), 3)
    assert sinks.current_version(spark, str(tmp_path)) == 3
    assert st._no_rows(spark, st.EVENT_SCHEMA).count() == 0
    assert [f.name for f in st._no_rows(spark, st.RECS_SCHEMA).schema] == ["uid", "mid", "score"]
