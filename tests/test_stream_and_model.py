"""Streaming resume and model sanity."""

import os
import uuid

from pyspark.sql import functions as F

from flickmill.operators import model as mdl
from flickmill.operators import stats
from flickmill.plans import registry as R
from flickmill.session import scratch_dir
from flickmill.sources import adapters as ad
from flickmill.streaming import stream as st


def test_stream_resumes_from_checkpoint(spark, sf_dir):
    """T4: a restarted query continues after the last committed batch and ends
    where one uninterrupted run ends."""
    src_all = R._stage_messages(spark, sf_dir, files=4)
    # the file source replays files by modification time (the order written)
    files = sorted((f for f in os.listdir(src_all) if f.endswith(".parquet")),
                   key=lambda f: os.path.getmtime(os.path.join(src_all, f)))
    sims = R._content_sims(spark, sf_dir)

    def fresh_store():
        store = st.StreamStore(scratch_dir(spark, f"t-{uuid.uuid4().hex}"))
        st.init_store(store, ad.ratings(spark, sf_dir))
        st.save_sims(sims, store.path("sims"))
        return store

    one = fresh_store()
    q = st.run_stream(st.rating_stream(spark, "parquet", src_all, maxFilesPerTrigger=1), one,
                      st.sims_reader(one.path("sims")), one.path("ckpt"), available_now=True)
    q.awaitTermination()
    want = sorted(tuple(r) for r in st.current_stream_recs(spark, one).collect())

    two = fresh_store()
    src = scratch_dir(spark, f"src-{uuid.uuid4().hex}")
    os.makedirs(src)
    for f in files[:2]:
        os.link(os.path.join(src_all, f), os.path.join(src, f))
    ck = two.path("ckpt")
    q = st.run_stream(st.rating_stream(spark, "parquet", src, maxFilesPerTrigger=1), two,
                      st.sims_reader(two.path("sims")), ck, available_now=True)
    q.awaitTermination()
    for f in files[2:]:
        os.link(os.path.join(src_all, f), os.path.join(src, f))
    q = st.run_stream(st.rating_stream(spark, "parquet", src, maxFilesPerTrigger=1), two,
                      st.sims_reader(two.path("sims")), ck, available_now=True)
    q.awaitTermination()
    got = sorted(tuple(r) for r in st.current_stream_recs(spark, two).collect())
    assert got == want
    epochs = {r.epoch for r in spark.read.parquet(two.path("events")).select("epoch").distinct().collect()}
    assert epochs == {0, 1, 2, 3}


def test_als_beats_mean_predictor_and_is_seeded(spark, sf_dir):
    ratings = ad.ratings(spark, sf_dir).persist()
    m1 = mdl.als_fit(ratings, rank=10, iters=5, reg=0.1, seed=3)
    m2 = mdl.als_fit(ratings, rank=10, iters=5, reg=0.1, seed=3)
    p1 = mdl.predict_pairs(m1, ratings)
    train_rmse = mdl.rmse(p1).first().rmse
    base = mdl.rmse(mdl.mean_predictor(ratings, stats.average_movies(ratings).select(
        "mid", F.lit(None).cast("double").alias("x"), "avg").drop("x"))).first().rmse
    glob = ratings.select(F.avg("score")).first()[0]
    mean_rmse = ratings.select(F.sqrt(F.avg(F.pow(F.col("score") - F.lit(glob), 2)))).first()[0]
    assert train_rmse < mean_rmse
    assert base > 0
    a = sorted(tuple(r) for r in mdl.als_user_recs(m1, 5).collect())
    b = sorted(tuple(r) for r in mdl.als_user_recs(m2, 5).collect())
    assert a == b
