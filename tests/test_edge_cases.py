"""Hand-made edge cases (FIXTURES.md section 3) and scalar semantics."""

import re

import pytest
from pyspark.sql import functions as F

from flickmill.functions import scalar as fx
from flickmill.operators import blend, online, rank, similarity, stats
from flickmill.sources import readers


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_movie_trailing_empty_fields_kept(spark):
    df = readers.load_movies(spark, lines(spark, "1^a^^^^^^^^"))
    r = df.collect()[0]
    assert r["mid"] == 1 and r["name"] == "a" and r["directors"] == ""


def test_short_movie_line_fails_or_rejects(spark):
    with pytest.raises(Exception):
        readers.load_movies(spark, lines(spark, "1^a")).collect()
    good, bad = readers.load_movies(spark, lines(spark, "1^a", "2^b^^^^^^^^"), mode="reject")
    assert [r.mid for r in good.collect()] == [2]
    assert [r.value for r in bad.collect()] == ["1^a"]


def test_rating_with_non_numeric_id(spark):
    with pytest.raises(Exception):
        readers.load_ratings(spark, lines(spark, "x,1,3.0,10")).collect()
    good, bad = readers.load_ratings(spark, lines(spark, "x,1,3.0,10", "1,2,4.5,11"), mode="reject")
    assert [tuple(r) for r in good.collect()] == [(1, 2, 4.5, 11)]
    assert bad.count() == 1


def _java_split(s, pat):
    if s == "":
        return [""]
    parts = re.split(pat, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@pytest.mark.parametrize("s", ["a b", "a  b", "", "   ", "a b ", " a", "Drama  Comedy", "x"])
def test_tokenize_is_java_split(spark, s):
    got = spark.createDataFrame([(s,)], "t string").select(fx.tokenize("t").alias("x")).first().x
    assert got == _java_split(s.lower(), r"\s")


def test_empty_genre_token_counts_as_term(spark):
    items = spark.createDataFrame([(1, "n", "Drama||Comedy"), (2, "m", "")], "mid int, name string, genres string")
    tf = {(r.mid, r.term): r.tf for r in similarity.term_frequency(items).collect()}
    assert tf[(1, "")] == 1.0 and tf[(1, "drama")] == 1.0 and tf[(2, "")] == 1.0


def test_zero_vectors_give_no_pairs(spark):
    # one shared term only: idf = ln((N+1)/(N+1)) = 0, so every vector is zero
    items = spark.createDataFrame([(1, "a", "X"), (2, "b", "X")], "mid int, name string, genres string")
    assert similarity.item_similarity_content(items, 0.0).count() == 0


def test_similarity_cut_is_strict(spark):
    edges = spark.createDataFrame([(1, 2, 0.6), (2, 1, 0.6), (1, 3, 0.7000001)], "m1 int, m2 int, sim double")
    ranked = rank.similar_items_all(edges.where(F.col("sim") > 0.6))
    assert [(r.m1, r.m2) for r in ranked.collect()] == [(1, 3)]


def test_score_three_counts_as_low_and_cut_07_strict(spark):
    sims = spark.createDataFrame([(10, 1, 0.8), (1, 10, 0.8), (10, 2, 0.7), (2, 10, 0.7)],
                                 "m1 int, m2 int, sim double")
    cands = spark.createDataFrame([(7, 10)], "uid int, mid int")
    recent = spark.createDataFrame([(7, 1, 3.0), (7, 2, 5.0)], "uid int, mid int, score double")
    r = online.stream_priority(cands, recent, sims).collect()
    # only (10, 1) passes > 0.7; score 3 is low: 0.8 * 3 + log10(1) - log10(1)
    assert len(r) == 1 and r[0].score == pytest.approx(2.4)


def test_rated_movie_without_similarity_row_gives_empty_list(spark):
    ratings = spark.createDataFrame([(1, 99, 4.0, 5)], "uid int, mid int, score double, timestamp int")
    sims = spark.createDataFrame([(1, 2, 0.9), (2, 1, 0.9)], "m1 int, m2 int, sim double")
    assert online.stream_recs_batch(ratings, sims).count() == 0


def test_recent_k_bound_and_repeats(spark):
    rows = [(1, i, 1.0, i) for i in range(21)] + [(2, i, 1.0, i) for i in range(20)]
    r = spark.createDataFrame(rows, "uid int, mid int, score double, timestamp int")
    got = {u: n for u, n in online.recent_k_ratings(r, 20).groupBy("uid").count().collect()}
    assert got == {1: 20, 2: 20}
    newest = online.recent_k_ratings(r, 20).where("uid = 1 and rank = 1").first()
    assert newest.mid == 20


def test_histogram_score_five_is_slot_ten(spark):
    r = spark.createDataFrame([(1, 1, 5.0, 0), (1, 2, 0.5, 0), (1, 3, 2.25, 0)],
                              "uid int, mid int, score double, timestamp int")
    got = {b: n for _, b, n in stats.rating_histogram(r).collect()}
    assert got == {10: 1, 1: 1, 5: 1}


def test_ties_at_top_k_cut_break_by_id(spark):
    s = spark.createDataFrame([(1, m, 1.0) for m in (5, 3, 9, 1)], "uid int, mid int, score double")
    got = [r.mid for r in rank.user_top_n(s, 2).orderBy("rank").collect()]
    assert got == [1, 3]


def test_username_hash_collision(spark):
    df = spark.createDataFrame([("Aa",), ("BB",), ("hello",), ("",)], "n string")
    got = [r.h for r in df.select(fx.name_to_uid("n").alias("h")).collect()]
    assert got == [2112, 2112, 99162322, 0]


def test_halve_score_rounds_half_up(spark):
    df = spark.createDataFrame([(7.25,), (9305.97,)], "s double")
    assert [r.h for r in df.select(fx.halve_score("s").alias("h")).collect()] == [3.63, 4652.99]


def test_user_without_recommendations_gets_cold_start(spark):
    users = spark.createDataFrame([(1, "a", False, 0, ["PROMO BRUSHED"]), (2, "b", False, 0, ["SMALL"])],
                                  "uid int, username string, first boolean, timestamp long, prefGenres array<string>")
    primary = spark.createDataFrame([(1, 1, 50, 0.9)], "uid int, rank int, mid int, score double")
    top = spark.createDataFrame([("SMALL", 1, 7, 4.0), ("PROMO", 1, 8, 3.0)],
                                "genres string, rank int, mid int, score double")
    got = sorted(tuple(r) for r in blend.with_fallback(primary, users, top, 10).collect())
    assert got == [(1, 1, 50, 0.9), (2, 1, 7, 4.0)]


def test_java_split_commas(spark):
    df = spark.createDataFrame([("a,b,",), (",",), ("",), (",a",)], "s string")
    got = [r.x for r in df.select(fx.comma_list("s").alias("x")).collect()]
    assert got == [["a", "b"], [], [""], ["", "a"]]


def test_hashed_terms_match_hashingtf(spark):
    from pyspark.ml.feature import HashingTF
    items = spark.createDataFrame([(1, "n", "Drama|Comedy|drama"), (2, "m", "Sci-Fi|War")],
                                  "mid int, name string, genres string")
    got = {(r.mid, int(r.term)): r.tf for r in similarity.term_frequency(items, hashed=50).collect()}
    toks = similarity.content_tokens(items)
    vecs = HashingTF(inputCol="tokens", outputCol="v", numFeatures=50).transform(toks).collect()
    want = {(r.mid, int(i)): float(v) for r in vecs for i, v in zip(r.v.indices, r.v.values)}
    assert got == want
