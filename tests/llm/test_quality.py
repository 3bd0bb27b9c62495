import zlib

import numpy as np
from pyspark.sql import functions as F

from flickmill.llm import quality, registry


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_query_on_the_held_out_fold(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = registry.QUERIES["op6_quality_classifier"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    some = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    s, y, p = (np.array(c) for c in zip(*some))
    print("held out", len(s), "auc", auc(s, y), "accuracy", (p == y).mean(), "bad caught", (p[y == 0] == 0).mean(), "good kept", (p[y == 1] == 1).mean())
    assert auc(s, y) > 0.95
    assert (p == y).mean() > 0.9


def test_edge_cases(spark):
    good, bad = "the words of a text are here in an order that repeats ", "$$$ &&& ### %%% *** "
    docs = [(i, (good if i % 2 else bad) * (1 + i % 5) + str(i), i, i) for i in range(60)] + [(100, None, 1, 1), (101, "", 1, 1), (None, good, 1, 1), (102, good * 20_000, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score long, q long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (7, None)], "doc_id long, quality int")
    rows = {r.doc_id: r for r in quality.quality_scores(df, labels).collect()}
    assert all(rows[i].predicted == i % 2 for i in range(60)) and rows[102].predicted == 1 and rows[None].held_out
    assert rows[100].score == rows[101].score and 0 <= rows[100].score <= 1
    kept = quality.accepted(df, labels)
    assert kept.schema == df.schema
    assert {r.doc_id for r in kept.collect()} == {i for i in range(60) if i % 2} | {100, 101, 102, None}
    assert {r.score for r in quality.quality_scores(df, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(df.limit(0), labels).count() == 0
    assert quality.quality_scores(df, labels.withColumn("quality", F.lit(1))).where("predicted = 0").count() == 0
