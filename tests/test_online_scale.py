"""The re-ranking job does each costly step once: plans of its steps, and results on rows with nulls and copies."""

from __future__ import annotations

import math
import re

import pytest

from flickmill.operators import online
from flickmill.operators.similarity import FactoredSims
from flickmill.sources import adapters as ad


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"(?s)\n\n.*", "", text)


def sims_of(spark, members, pairs) -> FactoredSims:
    return FactoredSims(spark.createDataFrame(members, "mid int, sig int"), spark.createDataFrame(pairs, "s1 int, s2 int, sim double"))


def test_ratings_sort_purchase_lines_by_pair_once(spark, tmp_path):
    """lines were sorted by (uid, mid) before the shuffle and again after it."""
    spark.sql("""SELECT * FROM VALUES (1L, 7L, 1, 10.0D), (1L, 7L, 2, 4.0D), (2L, 7L, 1, 31.0D), (2L, 8L, 1, 12.0D), (3L, NULL, 1, 50.0D), (4L, 7L, 1, NULL)
                 AS t(l_orderkey, l_partkey, l_linenumber, l_quantity)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("""SELECT o_orderkey, o_custkey, CAST(d AS TIMESTAMP_NTZ) AS o_orderdate FROM VALUES (1L, 5L, '1996-01-02'), (2L, 5L, '1996-01-02'), (3L, 6L, NULL), (4L, 9L, '1997-01-01')
                 AS t(o_orderkey, o_custkey, d)""").write.parquet(f"{tmp_path}/orders.parquet")
    got = ad.ratings(spark, str(tmp_path))
    keys = lambda line: re.search(r"Aggregate\(key=\[uid#\d+, mid#\d+\]", line)
    lines = plan(got).splitlines()
    last = max(i for i, line in enumerate(lines) if keys(line))
    assert not any("Exchange" in line for line in lines[min(i for i, line in enumerate(lines) if keys(line)):last])
    day = 820540800
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(5, 7, 3.5, day), (5, 8, 1.5, day), (6, None, 5.0, None), (9, 7, None, 852076800)], key=str)


def test_candidates_meet_recent_ratings_by_signature(spark):
    """every candidate met every recent rating; copies and pairs of one movie count as before."""
    sims = sims_of(spark, [(1, 1), (2, 1), (2, 1), (3, 3), (4, 3), (5, 5)], [(1, 1, 1.0), (3, 3, 1.0), (1, 3, 0.8), (3, 1, 0.8), (1, 5, 0.7), (5, 1, 0.7)])
    cands = spark.createDataFrame([(9, 1), (9, 2), (9, 2), (9, 4), (9, 5), (None, 1)], "uid int, mid int")
    recent = spark.createDataFrame([(9, 1, 5.0), (9, 3, 2.0), (9, 3, 4.0), (9, 2, None), (None, 1, 5.0)], "uid int, mid int, score double")
    got = online.stream_priority(cands, recent, sims)
    sig = {1: [1], 2: [1, 1], 3: [3], 4: [3], 5: [5]}
    sim = {(1, 1): 1.0, (3, 3): 1.0, (1, 3): 0.8, (3, 1): 0.8}
    want = {}
    for c in (1, 2, 2, 4, 5):
        for m, s in ((1, 5.0), (3, 2.0), (3, 4.0), (2, None)):
            want.setdefault(c, []).extend((sim[a, b], s) for a in sig[c] for b in sig[m] if c != m and (a, b) in sim)
    score = lambda hits: (sum(a * s for a, s in hits if s is not None) / sum(s is not None for _, s in hits)
                          + math.log10(max(1, sum(s is not None and s > 3 for _, s in hits))) - math.log10(max(1, sum(s is not None and s <= 3 for _, s in hits))))
    assert {(r.uid, r.mid): r.score for r in got.collect()} == {(9, c): pytest.approx(score(h), abs=2e-6) for c, h in want.items() if h}
    assert "collect_list" in plan(got)


def test_rated_pairs_are_not_sorted_to_be_left_out(spark):
    """rated pairs and similar movies were both sorted for the anti join."""
    sims = sims_of(spark, [(i, 1) for i in range(6)], [(1, 1, 1.0)])
    anchors = spark.createDataFrame([(9, 0), (8, 1)], "uid int, anchor int")
    seen = spark.createDataFrame([(9, 0), (9, 1), (9, 1), (8, None), (None, 2)], "uid int, mid int")
    got = online.unseen_similar(anchors, sims, seen, 3)
    assert re.search(r"ShuffledHashJoin.*LeftAnti", plan(got))
    assert sorted((r.uid, r.rank, r.mid) for r in got.collect()) == [(8, 1, 0), (8, 2, 2), (8, 3, 3), (9, 1, 2), (9, 2, 3), (9, 3, 4)]


def test_recent_ratings_are_ranked_once(spark):
    """they were ranked for the anchors and again for the scores."""
    ratings = spark.createDataFrame([(1, m, 4.0, m) for m in range(5)] + [(2, 3, 1.0, None)], "uid int, mid int, score double, timestamp int")
    recent, anchors = online.recent_and_anchors(ratings, 2)
    assert sorted((r.uid, r.anchor) for r in anchors.collect()) == [(1, 4), (2, 3)]
    assert sorted((r.uid, r.rank, r.mid) for r in recent.collect()) == [(1, 1, 4), (1, 2, 3), (2, 1, 3)]
    assert "Window" not in plan(recent) and "Window" not in plan(anchors)
