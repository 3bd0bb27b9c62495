"""Options of operators that no registered query sets."""

import time

from pyspark.sql import functions as F

from flickmill.functions import scalar as fx
from flickmill.operators import blend, lookup, model, rank, similarity


def test_a_pair_rated_again_has_its_last_score_and_a_missing_one_the_average(spark):
    ratings = spark.createDataFrame([(1, 7, 2.0, 10), (1, 7, 4.0, 20), (1, 7, 3.0, 15), (1, 8, None, 1), (2, 9, None, 1)], "uid int, mid int, score double, timestamp int")
    movies = spark.createDataFrame([(7, "a"), (8, "b"), (9, "c")], "mid int, name string")
    averages = spark.createDataFrame([(7, 1.0), (8, 3.5)], "mid int, avg double")
    got = {(r.uid, r.mid): r.score for r in lookup.my_rated_movies(ratings, movies, averages, ["timestamp"]).collect()}
    assert got == {(1, 7): 4.0, (1, 8): 3.5, (2, 9): 0.0}
    assert lookup.my_rated_movies(ratings.limit(0), movies, averages, ["timestamp"]).count() == 0


def test_hash_split_is_the_same_in_any_layout(spark):
    ratings = spark.range(5_000).select((F.col("id") % 97).cast("int").alias("uid"), (F.col("id") % 89).cast("int").alias("mid"), F.lit(1.0).alias("score")).distinct()
    a, b = model.split_ratings(ratings.repartition(3), 0.8, by="hash")
    c, d = model.split_ratings(ratings.repartition(11, "mid"), 0.8, by="hash")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(a) == rows(c) and rows(b) == rows(d) and not set(rows(a)) & set(rows(b))
    assert abs(len(rows(a)) / ratings.count() - 0.8) < 0.03


def test_blend_sums_and_movies_without_rank(spark):
    one = spark.createDataFrame([(1, 5, 1.0), (1, 6, 0.5)], "uid int, mid int, score double")
    two = spark.createDataFrame([(1, 5, 1.0)], "uid int, mid int, score double")
    got = [(r.mid, r.score) for r in blend.hybrid_recs([one, two], 5, (0.3, 0.3), merge="sum").orderBy("rank").collect()]
    assert got == [(5, 0.6), (6, 0.15)]
    movies = spark.createDataFrame([(5, "a"), (6, "b"), (7, "c")], "mid int, name string")
    both = one.unionByName(two).withColumn("rank", F.lit(1))
    assert sorted(r.mid for r in lookup.movies_for_recs(movies, both, keep_rank=False).collect()) == [5, 6]


def test_random_genre_is_one_of_the_users_and_repeats(spark):
    users = spark.createDataFrame([(u, ["Drama film", "Comedy", "War"]) for u in range(60)], "uid int, prefGenres array<string>")
    top = spark.createDataFrame([("Drama", 1, 1.0), ("Comedy", 2, 1.0), ("War", 3, 1.0)], "genres string, mid int, score double")
    run = lambda seed: {r.uid: r.mid for r in blend.cold_start_recs(users, top, 5, pick="random", seed=seed).collect()}
    assert set(run(0).values()) == {1, 2, 3} and run(0) == run(0) and run(0) != run(1)


def test_newest_by_date_and_the_clock(spark):
    movies = spark.createDataFrame([(1, "2020-02-03"), (2, "2020-10-01"), (3, "2019-12-31")], "mid int, issue string")
    assert [r.mid for r in rank.newest_movies(movies, 2, by_date=True).collect()] == [2, 1]
    assert abs(spark.range(1).select(fx.now_epoch_seconds().alias("t")).first().t - time.time()) < 120


def test_similarity_of_a_hot_term_in_any_number_of_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"m{i}", "|".join(["hot", f"a{i % 40}", f"b{i % 7}", "rare" if i % 50 == 0 else f"c{i}"])) for i in range(400)], "mid int, name string, genres string")
    rows = lambda: sorted((r.m1, r.m2, r.sim) for r in similarity.item_similarity_content(items, 0.2).collect())
    whole = rows()
    monkeypatch.setattr(similarity, "PREFIX_BLOCK", 3)
    assert rows() == whole and len(whole) > 1_000 and len({r[:2] for r in whole}) == len(whole)


def test_grid_of_blocks_equals_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(37, 5)), rng.normal(size=(23, 5))
    users = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], "uid int, features array<double>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(b)], "mid int, features array<double>")
    for size in (4, 1_000):
        got = {(r.uid, r.mid): r.pred for r in model.user_item_grid(users, items, size).collect()}
        assert len(got) == 37 * 23 and np.allclose([[got[i, j] for j in range(23)] for i in range(37)], a @ b.T)
    assert model.user_item_grid(users.limit(0), items).count() == 0
    pairs = spark.createDataFrame([(1, 2), (36, 22), (99, 1)], "uid int, mid int")
    assert {(r.uid, r.mid): round(r.pred, 9) for r in model.predict_given(pairs, users, items).collect()} == {(1, 2): round(float(a[1] @ b[2]), 9), (36, 22): round(float(a[36] @ b[22]), 9)}


def test_blocks_are_bounded_in_number_and_lists_in_length(spark):
    import numpy as np
    from pyspark.sql import functions as F
    assert [similarity.block_count(n, 256) for n in (0, 1, 257, 2_000, 500_000)] == [1, 1, 2, 8, similarity.MOST_BLOCKS]
    assert similarity.block_count(100 * similarity.LARGEST_BLOCK, 256) == 100
    x = np.random.default_rng(4).integers(-2, 3, (60, 3)).astype(float)
    vec = spark.createDataFrame([(i % 55, v.tolist()) for i, v in enumerate(x)], "mid int, features array<double>")
    whole = similarity.item_similarity_latent(vec, 0.1, block_size=4)
    few = similarity.item_similarity_latent(vec, 0.1, block_size=4, n=3)
    lists = [rank.recs_top_n(e.select(F.col("m1").alias("key"), F.col("m2").alias("mid"), F.col("sim").alias("score")), "key", 3) for e in (whole, few)]
    assert few.count() < whole.count()
    assert sorted(map(tuple, lists[0].collect())) == sorted(map(tuple, lists[1].collect()))


def test_pairs_without_vectors_never_meet_one(spark):
    users = spark.createDataFrame([(1, [1.0])], "uid int, features array<double>")
    items = spark.createDataFrame([(2, [3.0])], "mid int, features array<double>")
    pairs = spark.createDataFrame([(1, 2), (1, 2), (7, 2), (1, 7)], "uid int, mid int")
    got = model.predict_given(pairs, users, items)
    assert [tuple(r) for r in got.collect()] == [(1, 2, 3.0)] * 2
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()


def test_ranked_once_for_each_signature_as_ranked_by_pairs(spark):
    members = spark.createDataFrame([(m, m % 4) for m in range(17)] + [(4, 0), (7, 2), (30, 9)], "mid int, sig int")
    near = {(0, 1): 0.9, (0, 2): 1.0, (1, 3): 0.7}
    pairs = [(s, s, 1.0) for s in range(4)] + [(a, b, v) for (x, y), v in near.items() for a, b in ((x, y), (y, x))]
    sims = similarity.FactoredSims(members.coalesce(1), spark.createDataFrame(pairs, "s1 int, s2 int, sim double").coalesce(1))
    for n in (None, 4):
        got, want = rank.similar_items_all(sims, n), rank.similar_items_all(sims.edges(), n)
        assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # the window is over signatures' lists, not over expanded pairs
    assert any("row_number" in x and "[s1#" in x for x in rank.similar_items_all(sims)._jdf.queryExecution().optimizedPlan().toString().split("\n"))


def test_lists_put_together_are_dealt_anew(spark):
    one = spark.createDataFrame([(u, m, m / 7) for u in range(9) for m in range(6)], "uid int, mid int, score double")
    plan = blend.hybrid_recs([one, one, one], 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RepartitionByExpression") < plan.index("Union")
    top = spark.createDataFrame([("SMALL", 1, 7, 4.0)], "genres string, rank int, mid int, score double")
    users = spark.createDataFrame([(u, ["SMALL"]) for u in range(12)], "uid int, prefGenres array<string>")
    got = blend.guess_recs(users, [one, one, one], top, 4)
    assert len(got.inputFiles()) and got.count() == 9 * 4 + 3


def test_many_queries_are_merged_and_packed_blocks_stand_in_small_files(spark, monkeypatch):
    import os
    from flickmill.operators import search
    monkeypatch.setattr(search, "BLOCK_DOCS", 4)
    docs = spark.createDataFrame([(m, f"n{m % 7}", " ".join(f"w{(m * k) % 11}" for k in range(1, 6))) for m in range(60)], "mid int, name string, descri string")
    index = search.build_index(docs, by_term=False)
    files = [f for f in os.listdir(os.path.join(index.path, "packed")) if f.endswith(".parquet")]
    counts = [spark.read.parquet(os.path.join(index.path, "packed", f)).count() for f in files]
    assert max(counts) <= search.FILE_BLOCKS and sum(counts) > search.FILE_BLOCKS
    seeds = docs.select(F.col("mid").alias("qid"), "mid")
    terms = search.seed_terms(index, seeds, 5)
    few = sorted(map(tuple, search.hits_to_recs(search.top_hits(index, terms, 3, skip=seeds), 3).collect()))
    monkeypatch.setattr(search, "BROADCAST_TERMS", 10)
    hits = search.top_hits(index, terms, 3, skip=seeds)
    assert "strategy=merge" in hits._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, search.hits_to_recs(hits, 3).collect())) == few and len(few) == 180
