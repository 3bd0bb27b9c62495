"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each reads the driver tables through the adapters and runs the library's own
operator on them, whole tables, no sampling. Column names equal those of the
DuckDB twins in ``flickmill.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flickmill.functions import scalar as fx
from flickmill.operators import lookup, rank, stats
from flickmill.operators import online
from flickmill.sources import adapters as ad
from flickmill.session import scratch_dir
from flickmill.sources import readers, sinks
from flickmill.streaming import stream as st

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- 2.1 sources ----------------------------------------------------------
@query
def load_movies(spark, d):
    return readers.load_movies(spark, readers.movie_lines(ad.movies(spark, d)))


@query
def load_tags(spark, d):
    lines = readers.csv_lines(ad.tags(spark, d), ["uid", "mid", "tag", "timestamp"])
    return readers.load_tags(spark, lines)


@query
def load_ratings(spark, d):
    lines = readers.csv_lines(ad.ratings(spark, d), ["uid", "mid", "score", "timestamp"])
    return readers.load_ratings(spark, lines)


@query
def read_table(spark, d):
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()),
                           T.StructField("l_partkey", T.LongType()),
                           T.StructField("l_quantity", T.DoubleType())])
    return readers.read_table(spark, f"{d}/lineitem.parquet", schema)


@query
def parse_rating_events(spark, d):
    return readers.parse_rating_events(ad.rating_event_lines(spark, d).select("value", "event_id"))


@query
def extract_rating_log(spark, d):
    return readers.extract_rating_log(ad.rating_log_lines(spark, d))


@query
def parse_recent_list(spark, d):
    recent = online.recent_k_ratings(ad.ratings(spark, d), 20)
    return readers.parse_recent_list(readers.format_recent_list(recent), 20)


# ---- 2.3 projections / predicates ----------------------------------------
@query
def ratings_triplets(spark, d):
    return ad.ratings(spark, d).select("uid", "mid", "score")


@query
def content_input(spark, d):
    return ad.content_items(spark, d).select("mid", "name", fx.bars_to_blanks("genres").alias("genres"))


def _customers(spark, d, cond):
    return (ad.table(spark, d, "customer").where(cond)
            .select(F.col("c_custkey").cast("int").alias("uid")))


@query
def lookup_by_key(spark, d):
    return lookup.lookup_by_key(ad.ratings(spark, d),
                                _customers(spark, d, F.col("c_mktsegment") == "BUILDING"), "uid")


@query
def tags_of_movie(spark, d):
    keys = (ad.table(spark, d, "part").where(F.col("p_size") > 40)
            .select(F.col("p_partkey").cast("int").alias("mid")))
    return lookup.tags_of_movie(ad.tags(spark, d), keys)


@query
def tags_of_user_movie(spark, d):
    return lookup.tags_of_user_movie(ad.tags(spark, d), ad.ratings(spark, d).select("uid", "mid"))


@query
def key_exists(spark, d):
    keys = ad.table(spark, d, "part").select(F.col("p_partkey").cast("int").alias("mid"))
    return lookup.key_exists(ad.ratings(spark, d), keys, "mid")


@query
def ratings_of_user(spark, d):
    return lookup.ratings_of_user(ad.ratings(spark, d),
                                  _customers(spark, d, F.col("c_nationkey") == 7))


# ---- 2.4 joins ------------------------------------------------------------
@query
def movies_with_tags(spark, d):
    return ad.movies(spark, d).join(stats.tags_per_movie(ad.tags(spark, d)), "mid", "left")


@query
def movies_with_avg(spark, d):
    return lookup.movies_with_avg(ad.movies(spark, d), stats.average_movies(ad.ratings(spark, d)))


@query
def my_rated_movies(spark, d):
    raw = ad.raw_ratings(spark, d)
    order = ["o_orderdate", "l_orderkey", "l_linenumber", "l_quantity"]
    averages = stats.average_movies(ad.ratings(spark, d))
    return (lookup.my_rated_movies(raw, ad.movies(spark, d, with_issue=False), averages, order)
            .select("uid", "mid", "score", "name", "genres"))


@query
def movies_for_recs(spark, d):
    top = rank.most_rated_movies(stats.rate_more_movies(ad.ratings(spark, d)), 10)
    # the ten rows of the report as one ranked list
    recs = rank.top_n_per_group(top.withColumn("uid", F.lit(0)), ["uid"],
                                [F.col("count").desc(), F.col("mid").asc()], None)
    return (lookup.movies_for_recs(ad.movies(spark, d), recs)
            .select(F.col("rank").cast("int").alias("rank"), "mid", "name", "issue"))


# ---- 2.5 aggregations -----------------------------------------------------
@query
def tags_per_movie(spark, d):
    return stats.tags_per_movie(ad.tags(spark, d))


@query
def distinct_users(spark, d):
    return stats.distinct_users(ad.ratings(spark, d))


@query
def distinct_movies(spark, d):
    return stats.distinct_movies(ad.ratings(spark, d))


@query
def rating_histogram(spark, d):
    return stats.rating_histogram(ad.ratings(spark, d))


@query
def rate_more_movies(spark, d):
    return stats.rate_more_movies(ad.ratings(spark, d))


@query
def rate_more_recently(spark, d):
    return stats.rate_more_recently(ad.ratings(spark, d))


@query
def average_movies(spark, d):
    return stats.average_movies(ad.ratings(spark, d))


@query
def genres_top_movies(spark, d):
    return stats.genres_top_movies(ad.movies(spark, d, with_issue=False),
                                   stats.average_movies(ad.ratings(spark, d)), 10)


# ---- 2.6 ranking ----------------------------------------------------------
@query
def recent_k_ratings(spark, d):
    return online.recent_k_ratings(ad.ratings(spark, d), 20).select("uid", "rank", "mid", "score", "timestamp")


@query
def hot_movies(spark, d):
    return rank.hot_movies(stats.rate_more_recently(ad.ratings(spark, d)), 10)


@query
def most_rated_movies(spark, d):
    return rank.most_rated_movies(stats.rate_more_movies(ad.ratings(spark, d)), 10)


@query
def newest_movies(spark, d):
    return rank.newest_movies(ad.movies(spark, d), 10).select("mid", "name", "issue")


@query
def top_in_genre(spark, d):
    lists = stats.genres_top_movies(ad.movies(spark, d, with_issue=False),
                                    stats.average_movies(ad.ratings(spark, d)), 10)
    wanted = spark.createDataFrame([("ECONOMY",), ("PROMO",)], "genres string")
    return rank.top_in_genre(lists, wanted, 5).select("genres", "mid", "score", "rank")


# ---- 2.8 scalar functions -------------------------------------------------
@query
def scalar_functions(spark, d):
    c = ad.table(spark, d, "customer")
    return c.select(F.col("c_custkey").cast("int").alias("uid"), F.col("c_name").alias("username"),
                    fx.name_to_uid("c_name").alias("name_uid"),
                    fx.halve_score("c_acctbal").alias("half"),
                    fx.half_star_bucket(F.abs("c_acctbal") % F.lit(5.0)).alias("bucket"),
                    fx.log10_count("c_nationkey").alias("lg"))


@query
def text_functions(spark, d):
    m = ad.content_items(spark, d)
    p = ad.table(spark, d, "part").select(F.col("p_partkey").cast("int").alias("mid"),
                                          "p_type", "p_brand")
    return m.join(p, "mid").select(
        "mid", fx.first_word("name").alias("first_word"),
        fx.bars_to_blanks("genres").alias("blanks"),
        F.size(fx.tokenize(fx.bars_to_blanks("genres"))).alias("n_tokens"),
        fx.append_separated("p_brand", "p_type").alias("appended"),
        F.size(fx.comma_list(F.concat_ws(",", "p_type", "p_brand"))).alias("n_prefs"))


# ---- 2.9 content model (exact terms) ---------------------------------------
from flickmill.operators import similarity as sim  # noqa: E402


@query
def term_frequency(spark, d):
    return sim.term_frequency(ad.content_items(spark, d))


@query
def document_frequency(spark, d):
    items = ad.content_items(spark, d)
    n = items.select(F.count(F.lit(1))).scalar()
    return sim.idf_fit(sim.term_frequency(items), n).select("term", "df", F.round("idf", 6).alias("idf"))


@query
def tfidf(spark, d):
    return sim.tfidf(ad.content_items(spark, d)).select("mid", "term", F.round("w", 6).alias("w"))


@query
def vector_norms(spark, d):
    return stats.vector_norms(sim.tfidf(ad.content_items(spark, d)).where(F.col("w") != 0)) \
        .select("mid", F.round("norm", 6).alias("norm"))


def _content_sims(spark, d, theta=0.6):
    return sim.content_similarity(ad.content_items(spark, d), theta)


def _stored_sims(spark, d):
    """The similarity table, written once and read by every use, as the recommender stores it."""
    path = scratch_dir(spark, f"sims-{uuid.uuid4().hex}")
    st.save_sims(_content_sims(spark, d), path)
    return st.sims_reader(path)(spark)


def _stored_ratings(spark, d):
    """The rating table, written once and read by every use."""
    return sinks.read_back(ad.ratings(spark, d), scratch_dir(spark, f"ratings-{uuid.uuid4().hex}"))


@query
def item_similarity_content(spark, d):
    return _content_sims(spark, d).edges()


@query
def similar_items_all(spark, d):
    return rank.similar_items_all(_content_sims(spark, d))


# ---- online scoring (batch twin of the streaming job) ---------------------
def _anchors_and_recent(spark, d):
    ratings = _stored_ratings(spark, d)
    recent, anchors = online.recent_and_anchors(ratings, 20)
    return ratings, recent, anchors


@query
def unseen_similar(spark, d):
    ratings, _, anchors = _anchors_and_recent(spark, d)
    return online.unseen_similar(anchors, _stored_sims(spark, d), ratings, 20) \
        .select("uid", "anchor", "rank", "mid", "sim")


@query
def stream_priority(spark, d):
    ratings, recent, anchors = _anchors_and_recent(spark, d)
    sims = _stored_sims(spark, d)
    cands = online.unseen_similar(anchors, sims, ratings, 20)
    return online.stream_priority(cands, recent, sims, 0.7, 3.0)


@query
def stream_recs_batch(spark, d):
    """Flagship: the streaming job's re-rank for every user at once."""
    return online.stream_recs_batch(_stored_ratings(spark, d), _stored_sims(spark, d))


# ---- 2.9 latent similarity (dense) ----------------------------------------
@query
def item_similarity_latent(spark, d):
    """M9 on the given latent vectors; cut 0.2 (the 0.6 cut is empty on this data)."""
    return sim.item_similarity_latent(ad.latent_vectors(spark, d), 0.2, block_size=256)


# ---- 2.7 blending and cold start ------------------------------------------
from flickmill.operators import blend, maintain, search  # noqa: E402


def _genre_top(spark, d):
    return stats.genres_top_movies(ad.movies(spark, d, with_issue=False),
                                   stats.average_movies(ad.ratings(spark, d)), 10)


def _hybrid_lists(spark, d):
    ratings, _, anchors = _anchors_and_recent(spark, d)
    sims = _stored_sims(spark, d)
    a = online.most_similar(anchors, sims, 10)
    # documents like the anchor, from the stored search index; each anchor is searched once, however many users have it
    index = search.build_index(ad.content_items(spark, d), ("name", "genres"), by_term=False)
    seeds = anchors.select(F.col("anchor").alias("qid"), F.col("anchor").alias("mid")).distinct()
    hits = search.top_hits(index, search.seed_terms(index, seeds, 25), 10, skip=seeds)
    like = rank.top_n_per_group(hits, ["qid"], rank.by_score(), 10)
    b = anchors.join(like.select(F.col("qid").alias("anchor"), "mid", "score"), "anchor").select("uid", "mid", "score")
    c = online.stream_recs_batch(ratings, sims).select("uid", "mid", "score")
    return [a, b, c]


@query
def hybrid_recs(spark, d):
    return blend.hybrid_recs(_hybrid_lists(spark, d), 10)


@query
def cold_start_recs(spark, d):
    return blend.cold_start_recs(ad.users(spark, d), _genre_top(spark, d), 10, pick="first")


@query
def guess_recs(spark, d):
    return blend.guess_recs(ad.users(spark, d), _hybrid_lists(spark, d), _genre_top(spark, d), 10)


@query
def wish_recs(spark, d):
    """U3 with the streaming lists as the users' own lists."""
    stream = online.stream_recs_batch(_stored_ratings(spark, d), _stored_sims(spark, d))
    return blend.wish_recs(ad.users(spark, d), stream, _genre_top(spark, d), 10)


# ---- 2.12 maintenance -----------------------------------------------------
def _rating_changes(spark, d):
    e = ad.table(spark, d, "events")
    return e.select(F.col("user_id").cast("int").alias("uid"),
                    F.get_json_object("props", "$.k").cast("int").alias("mid"),
                    F.ceil(F.least("value", F.lit(50.0)) / F.lit(5.0)).cast("double").alias("score"),
                    fx.epoch_seconds(F.col("ts")).alias("timestamp"), "event_id")


@query
def merge_ratings(spark, d):
    return maintain.merge_ratings(ad.ratings(spark, d), _rating_changes(spark, d), "event_id")


@query
def delete_by_key(spark, d):
    return maintain.delete_by_key(ad.ratings(spark, d),
                                  _customers(spark, d, F.col("c_nationkey") == 3), "uid")


@query
def append_tags(spark, d):
    tags = ad.tag_events(spark, d)
    cut = fx.epoch_of("2024-01-15 00:00:00")
    docs = ad.content_items(spark, d).select("mid").join(
        stats.tags_per_movie(tags.where(F.col("timestamp") < cut)), "mid", "left")
    return maintain.append_tags(docs, tags.where(F.col("timestamp") >= cut), "event_id").select("mid", "tags")


def _user_rows(users):
    return users.select("uid", "username", "first", "timestamp",
                        F.array_join("prefGenres", "|").alias("prefs"))


@query
def insert_users_if_absent(spark, d):
    e = ad.table(spark, d, "events")
    ts = fx.epoch_seconds("ts")
    known = e.select(F.format_string("Customer#%09d", F.col("user_id")).alias("username"),
                     ts.alias("timestamp"))
    guests = e.select(F.concat(F.lit("guest"), F.col("user_id").cast("string")).alias("username"),
                      ts.alias("timestamp"))
    return _user_rows(maintain.insert_users_if_absent(ad.users(spark, d), known.unionByName(guests)))


@query
def merge_preferences(spark, d):
    e = ad.table(spark, d, "events").where(F.col("event_type") == "signup")
    p = ad.table(spark, d, "part").select(F.col("p_partkey").cast("int").alias("k"), "p_type", "p_brand")
    prefs = (e.select(F.format_string("Customer#%09d", F.col("user_id")).alias("username"),
                      F.get_json_object("props", "$.k").cast("int").alias("k"),
                      fx.epoch_seconds("ts").alias("timestamp"), "event_id")
             .join(p, "k")
             .select("username", F.concat_ws(",", "p_type", "p_brand").alias("genres"),
                     "timestamp", "event_id"))
    return _user_rows(maintain.merge_preferences(ad.users(spark, d), prefs, "event_id"))


# ---- 2.11 search -----------------------------------------------------------
def _bench_queries(spark, d):
    b = ad.table(spark, d, "benchmark")
    return b.select(F.col("item_id").cast("int").alias("qid"),
                    "text")


@query
def text_search(spark, d):
    return search.text_search(ad.search_documents(spark, d), _bench_queries(spark, d), n=100)


@query
def fuzzy_genre_search(spark, d):
    terms = (ad.table(spark, d, "part").select(F.col("p_type").alias("qid")).distinct()
             .select("qid", F.expr("substring(qid, 1, length(qid) - 1)").alias("term")))
    return search.fuzzy_genre_search(ad.content_items(spark, d), terms, n=100)


@query
def more_like_this(spark, d):
    docs = ad.search_documents(spark, d)
    seeds = docs.select(F.col("mid").alias("qid"), "mid")
    return search.more_like_this(docs, seeds, n=10, max_terms=25)


# ---- 2.9 model ------------------------------------------------------------
from flickmill.operators import model as mdl  # noqa: E402


def _fit(spark, d):
    return mdl.als_fit(ad.ratings(spark, d), **mdl.LIVE, seed=7)


@query
def als_user_recs(spark, d):
    return mdl.als_user_recs(_fit(spark, d), 20)


@query
def item_factors(spark, d):
    return mdl.item_factors(_fit(spark, d))


@query
def item_similarity_als(spark, d):
    """M9 on ALS item factors (cut 0.6)."""
    return sim.item_similarity_latent(mdl.item_factors(_fit(spark, d)), 0.6)


@query
def predict_pairs(spark, d):
    ratings = ad.ratings(spark, d)
    train, test = mdl.split_ratings(ratings, 0.8, seed=7, by="hash")
    m = mdl.als_fit(train, **mdl.LIVE, seed=7)
    return mdl.predict_pairs(m, test.select("uid", "mid", "score"))


@query
def positive_predictions(spark, d):
    return mdl.positive_predictions(predict_pairs(spark, d))


@query
def user_item_grid(spark, d):
    """J2 on given factors: the latent vectors as users and as items."""
    v = ad.latent_vectors(spark, d)
    return mdl.user_item_grid(v.withColumnRenamed("mid", "uid"), v, block_size=256).select("uid", "mid", F.round("pred", 6).alias("pred"))


@query
def predict_given(spark, d):
    """J4 on given factors: the rated pairs that both have a latent vector."""
    v = ad.latent_vectors(spark, d)
    return mdl.predict_given(ad.ratings(spark, d).select("uid", "mid"), v.withColumnRenamed("mid", "uid"), v) \
        .select("uid", "mid", F.round("pred", 6).alias("pred"))


@query
def predict_all(spark, d):
    return mdl.predict_all(_fit(spark, d))


@query
def split_ratings(spark, d):
    train, test = mdl.split_ratings(ad.ratings(spark, d), 0.8, seed=7, by="hash")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query
def rmse(spark, d):
    """A4/J5 on a given prediction table: each rating predicted by its movie's mean."""
    ratings = ad.ratings(spark, d)
    return mdl.rmse(mdl.mean_predictor(ratings, stats.average_movies(ratings))) \
        .select(F.round("rmse", 6).alias("rmse"))


@query
def als_tune(spark, d):
    """M5 + K5: the 4 x 3 grid of the recommender."""
    return mdl.als_tune(ad.ratings(spark, d), ranks=mdl.TUNE_RANKS, regs=mdl.TUNE_REGS, seed=7)


@query
def best_params(spark, d):
    return mdl.best_params(als_tune(spark, d))


@query
def user_top_n(spark, d):
    """W1 on given scores: the user's rated movies by score (ties: mid)."""
    return rank.user_top_n(ad.ratings(spark, d).select("uid", "mid", "score"), 20)


def _user_lists(spark, d):
    """A3 on the users' 20 best, the length that the user lists have."""
    return rank.recs_to_lists(rank.user_top_n(ad.ratings(spark, d).select("uid", "mid", "score"), 20), "uid")


@query
def recs_to_lists(spark, d):
    """A3 on the user lists; the list is shown as text for comparison."""
    return _user_lists(spark, d).select("uid", F.size("recs").alias("n"),
                                        F.array_join(F.transform("recs", lambda r: F.concat_ws(
                                            ":", r["mid"].cast("string"),
                                            F.round(r["score"] * 1000).cast("long").cast("string"))), ",")
                                        .alias("recs"))


@query
def recs_top_n(spark, d):
    """W8 on the stored user lists: explode each list, first 5."""
    return rank.recs_top_n(rank.lists_to_long(_user_lists(spark, d), "uid"), "uid", 5) \
        .select("uid", "rank", "mid", "score")


@query
def movie_cf_recs(spark, d):
    """W10 by mid on the latent similarity lists."""
    latent = sim.item_similarity_latent(ad.latent_vectors(spark, d), 0.2, block_size=256, n=5)
    return rank.recs_top_n(latent.select(F.col("m1").alias("key"), F.col("m2").alias("mid"),
                                         F.col("sim").alias("score")), "key", 5)


@query
def user_cf_recs(spark, d):
    """W10 by uid on the streaming lists."""
    stream = online.stream_recs_batch(_stored_ratings(spark, d), _stored_sims(spark, d))
    return rank.recs_top_n(stream.select("uid", "mid", "score"), "uid", 5)


@query
def hits_to_recs(spark, d):
    """Q4: raw BM25 hits of the benchmark queries -> ranked (qid, rank, mid, score), first 20."""
    idx = search.build_index(ad.search_documents(spark, d), by_block=False)
    hits = search.bm25(idx, search.query_terms(_bench_queries(spark, d)))
    return search.hits_to_recs(hits, 20)


# ---- 2.10 streaming (rows-only checks; the batch twin has SQL) --------------


def _stage_messages(spark, d, files: int = 4) -> str:
    """Rating messages (value, seq) as parquet files, one write per slice of
    event time, so the file source (which orders by modification time)
    replays them in event order."""
    path = scratch_dir(spark, f"stage-{uuid.uuid4().hex}")
    msgs = ad.rating_event_lines(spark, d).select("value", F.col("event_id").alias("seq"), "ts")
    day = F.dayofmonth("ts")
    bounds = [1 + (31 * i) // files for i in range(files)] + [32]
    for i in range(files):
        (msgs.where((day >= bounds[i]) & (day < bounds[i + 1])).select("value", "seq")
         .coalesce(1).sortWithinPartitions("seq").write.mode("append").parquet(path))
    return path


def _stage_log(spark, d, files: int = 4) -> str:
    path = scratch_dir(spark, f"log-{uuid.uuid4().hex}")
    lines = ad.rating_log_lines(spark, d).join(
        ad.table(spark, d, "events").select("event_id", "ts"), "event_id")
    day = F.dayofmonth("ts")
    bounds = [1 + (31 * i) // files for i in range(files)] + [32]
    for i in range(files):
        (lines.where((day >= bounds[i]) & (day < bounds[i + 1]))  # the bridge takes lines in any order
         .sortWithinPartitions("event_id").select("value").write.mode("append").text(path))
    return path


@query
def rating_stream(spark, d):
    """S5 + S6 as a stream: staged messages -> parsed rows (parquet sink)."""
    src = scratch_dir(spark, f"stage-{uuid.uuid4().hex}")
    for i in range(4):
        _stage_slice(spark, d, src, i)
    out = scratch_dir(spark, f"parsed-{uuid.uuid4().hex}")
    parsed = readers.parse_rating_events(st.rating_stream(spark, "parquet", src))
    q = (parsed.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", out + "-ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select("uid", "mid", "score", "timestamp",
                                          F.col("seq").alias("event_id"))


@query
def bridge_stream(spark, d):
    """Log lines -> rating messages, as a stream."""
    logs = _stage_log(spark, d)
    out = scratch_dir(spark, f"bridge-{uuid.uuid4().hex}")
    q = st.bridge_stream(spark, logs, out, out + "-ckpt", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out).select("value")


@query
def recent_state(spark, d):
    """Keyed list state of the last 20 ratings per user over the event stream."""
    src = scratch_dir(spark, f"stage-{uuid.uuid4().hex}")
    out = scratch_dir(spark, f"recent-{uuid.uuid4().hex}")
    for i in range(4):  # a slice of event time is one batch, of as many files as its scan has splits
        _stage_slice(spark, d, src, i)
        lists = st.recent_state(readers.parse_rating_events(st.rating_stream(spark, "parquet", src)), 20)
        q = (lists.writeStream.outputMode("update")
             .foreachBatch(lambda df, eid: df.withColumn("epoch", F.lit(eid)).write.mode("append").parquet(out))
             .option("checkpointLocation", out + "-ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
    got = spark.read.parquet(out)
    last = got.groupBy("uid").agg(F.max("epoch").alias("epoch"))
    return readers.parse_recent_list(got.join(last, ["uid", "epoch"]), 20)


@query
def stream_recs(spark, d):
    """The streaming job end to end over the event stream."""
    root = scratch_dir(spark, f"store-{uuid.uuid4().hex}")
    store = st.StreamStore(root)
    st.init_store(store, ad.ratings(spark, d))
    st.save_sims(_content_sims(spark, d), store.path("sims"))
    for i in range(4):  # a slice of event time is one batch, of as many files as its scan has splits
        _stage_slice(spark, d, store.path("messages"), i)
        q = st.run_stream(st.rating_stream(spark, "parquet", store.path("messages")), store,
                          st.sims_reader(store.path("sims")), store.path("ckpt"), available_now=True)
        q.awaitTermination()
    return st.current_stream_recs(spark, store)


def _stage_slice(spark, d, path: str, i: int, files: int = 4) -> None:
    """Slice i of ``files`` of the rating messages by day, added to the folder (as many files as its scan has splits)."""
    msgs = ad.rating_event_lines(spark, d).select("value", F.col("event_id").alias("seq"), "ts")
    day = F.dayofmonth("ts")
    msgs.where((day >= 1 + 31 * i // files) & (day < 1 + 31 * (i + 1) // files)).select("value", "seq").write.mode("append").parquet(path)


def _run_in_two(spark, d, between) -> DataFrame:
    """The streaming job over the first half of the messages, ended; then ``between`` (store), the second half, and the job
    started again from its checkpoint."""
    store = st.StreamStore(scratch_dir(spark, f"store-{uuid.uuid4().hex}"))
    st.init_store(store, ad.ratings(spark, d))
    st.save_sims(_content_sims(spark, d), store.path("sims"))
    for half in (0, 1):
        for i in (2 * half, 2 * half + 1):
            _stage_slice(spark, d, store.path("messages"), i)
        q = st.run_stream(st.rating_stream(spark, "parquet", store.path("messages")), store, st.sims_reader(store.path("sims")),
                          store.path("ckpt"), available_now=True, compact_every=1)
        q.awaitTermination()
        if not half:
            between(store)
    return st.current_stream_recs(spark, store)


@query
def stream_offsets(spark, d):
    """T4: a job that ended and starts again goes on behind its last batch; each batch is folded into the base."""
    return _run_in_two(spark, d, lambda store: None)


@query
def similarity_refresh(spark, d):
    """T5: a new similarity table (cut 0.75) is swapped in between two batches; lists made after it follow it."""
    return _run_in_two(spark, d, lambda store: st.save_sims(_content_sims(spark, d, 0.75), store.path("sims")))


# ---- 2.2 sinks --------------------------------------------------------------


@query
def write_table(spark, d):
    """K1: replace a whole result table, read it back (typed)."""
    path = scratch_dir(spark, f"table-{uuid.uuid4().hex}")
    sinks.write_table(stats.rate_more_movies(ad.ratings(spark, d)), path)
    sinks.write_table(stats.rate_more_movies(ad.ratings(spark, d)), path)  # replace, not append
    return readers.read_table(spark, path, T.StructType([T.StructField("mid", T.IntegerType()),
                                                        T.StructField("count", T.LongType())]))


@query
def drop_and_load(spark, d):
    """K2: the three base tables loaded in one go; the movie table read back."""
    out = scratch_dir(spark, f"load-{uuid.uuid4().hex}")
    paths = sinks.load_all(ad.movies(spark, d), ad.ratings(spark, d), ad.tags(spark, d), out)
    from flickmill import schemas
    return readers.read_table(spark, paths["Movie"], schemas.MOVIE)


@query
def upsert_user_recs(spark, d):
    """K3 (batch form): stored cold-start lists replaced by the streaming lists
    of every user that has one; versioned write, current version read back."""
    root = scratch_dir(spark, f"recs-{uuid.uuid4().hex}")
    stored = blend.cold_start_recs(ad.users(spark, d), _genre_top(spark, d), 10)
    sinks.write_version(stored, root, 1)
    new = rank.recs_top_n(online.stream_recs_batch(_stored_ratings(spark, d), _stored_sims(spark, d))
                          .select("uid", "mid", "score"), "uid", 10)
    cur = sinks.read_current(spark, root)
    sinks.write_version(sinks.upsert_user_recs(cur, new.select(*cur.columns)), root, 2)
    return sinks.read_current(spark, root)


@query
def search_docs(spark, d):
    """K4: one search document per movie with its distinct tags."""
    return sinks.search_docs(ad.movies(spark, d), ad.tags(spark, d)).select("mid", "name", "genres", "tags")


@query
def best_params_report(spark, d):
    """K5 on a given predictor (damped movie means): all settings with their error, stored and read back."""
    train, test = mdl.split_ratings(ad.ratings(spark, d), 0.8, seed=7, by="hash")
    return sinks.read_back(mdl.damped_mean_grid(train, test), scratch_dir(spark, f"report-{uuid.uuid4().hex}"))


@query
def best_damping(spark, d):
    """A13 on that table: the setting with the least error."""
    return mdl.best_params(best_params_report(spark, d))


@query
def positive_scores(spark, d):
    """P3 on a given prediction table: a movie's mean above the overall one, positive ones only."""
    ratings = ad.ratings(spark, d)
    overall = ratings.agg(F.round(F.avg("score"), 6).alias("overall"))  # one row
    pred = stats.average_movies(ratings).join(F.broadcast(overall)).select("mid", F.round(F.col("avg") - F.col("overall"), 6).alias("pred"))
    return mdl.positive_predictions(pred)


@query
def als_fit(spark, d):
    """M1: the fitted factor tables (user and item rows with their rank-long vectors)."""
    m = _fit(spark, d)
    return (m.userFactors.select(F.lit("user").alias("side"), "id", F.size("features").alias("rank"))
            .unionByName(m.itemFactors.select(F.lit("item").alias("side"), "id",
                                              F.size("features").alias("rank"))))


@query
def term_frequency_hashed(spark, d):
    """M7 hashed form: 50 Murmur3 buckets like HashingTF."""
    return sim.term_frequency(ad.content_items(spark, d), hashed=50)


@query
def vector_functions(spark, d):
    """dot, norm and cosine of each latent vector with the next one by id."""
    v = ad.latent_vectors(spark, d)
    nxt = v.select((F.col("mid") - 1).alias("mid"), F.col("features").alias("other"))
    return v.join(nxt, "mid").select(
        "mid", F.round(fx.dot("features", "other"), 6).alias("dot"),
        F.round(fx.norm("features"), 6).alias("norm"),
        F.round(fx.cosine("features", "other"), 6).alias("cosine"))
