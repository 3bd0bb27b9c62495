import pytest
from pyspark.sql import functions as F

from flickmill.llm import jaccard, toxicity
from flickmill.llm.sieve import sieved


@pytest.mark.parametrize("most", [4_096, 1])
def test_all_partners_stay_and_few_others(spark, monkeypatch, most):
    from flickmill.llm import sieve
    monkeypatch.setattr(sieve, "MOST", most)
    df = spark.range(-20_000, 20_000).select("id", F.col("id").cast("string").alias("text"))
    keys = spark.range(-20_000, 20_000, 9).select(F.col("id").alias("k"))
    both = keys.unionByName(keys).unionByName(spark.createDataFrame([(None,), (90_000,)], "k long"))
    got = sieved(df, "id", both)
    assert got.columns == ["id", "text"]
    assert keys.join(got, F.col("k") == F.col("id"), "left_anti").isEmpty()
    assert got.count() == got.distinct().count() < (8_000 if most > 1 else 20_000)
    assert sieved(df, "id", both.limit(0)).isEmpty()


def test_only_texts_of_classes_inside_a_large_node_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "written", lambda df, name: df)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    seen = []
    try:
        docs = spark.range(2_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c d e f "), F.col("id").cast("string")).alias("text"))
        inside = spark.range(0, 2_000, 100).select(F.col("id").alias("rep"), F.lit(5).alias("node"))
        real = jaccard.sieved
        monkeypatch.setattr(jaccard, "sieved", lambda *a: seen.append(real(*a)) or seen[-1])
        jaccard.next_level(docs, inside, 5, 0.8).collect()
        assert len(seen) == 1 and 20 <= seen[0].count() < 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_classes_far_from_all_others_in_size_are_not_sent_to_a_node(spark):
    at = spark.createDataFrame([(1, 100, 7), (2, 80, 7), (3, 79, 7), (4, 200, 7), (5, 50, 7), (1, 100, 8), (6, 79, 8)], "rep long, size int, node long")
    sizes = spark.createDataFrame([(7, 5, 1, 1), (8, 2, 2, 2)], "node long, n long, who long, who_else long")
    got = {tuple(r) for r in jaccard.members(at, sizes, 0.8).collect()}
    assert got == {(7, 1, 1), (7, 2, 1), (7, 3, 1)}  # 80 of 100 is near enough, 79 of 80 too

def test_only_labelled_texts_are_joined(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "written", lambda df, name: df)
    seen = []
    real = toxicity.sieved
    monkeypatch.setattr(toxicity, "sieved", lambda *a: seen.append(real(*a)) or seen[-1])
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"))
    labels = spark.range(0, 3_000, 50).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    assert toxicity.labelled(docs, labels).count() == labels.where(~toxicity.held_out(F.col("doc_id"))).count()
    assert seen[0].count() < 600
