"""Factor tables: the fit, and what is computed from its vectors without a shuffle of them."""

import os
import random

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from flickmill.operators import factors as fa
from flickmill.operators import model as mdl
from flickmill.operators import similarity
from flickmill.session import scratch_dir

SCHEMA = "uid int, mid int, score double"


def _ratings(spark, users=60, items=40, share=0.2, seed=1):
    r = random.Random(seed)
    rows = [(u - 5, m + 1000, r.randint(1, 10) / 2) for u in range(users) for m in range(items) if r.random() < (0.9 if m == 3 or u == 4 else share)]
    return spark.createDataFrame(rows + rows[:7], SCHEMA)  # some pairs come twice


def _vectors(df):
    return {r.id: r.features for r in df.collect()}


@pytest.mark.parametrize("rank, reg", [(3, 0.1), (24, 0.1), (2, 0.0)])
def test_fit_has_the_vectors_of_spark_als(spark, rank, reg):
    """Rows of fewer and of more ratings than components; a penalty of none."""
    ratings = _ratings(spark, share=0.2 if reg else 0.9)
    want = ALS(userCol="uid", itemCol="mid", ratingCol="score", rank=rank, maxIter=3, regParam=reg, seed=5).fit(ratings)
    got = mdl.als_fit(ratings, rank=rank, iters=3, reg=reg, seed=5)
    assert got.rank == rank
    for a, b in ((want.userFactors, got.userFactors), (want.itemFactors, got.itemFactors)):
        a, b = _vectors(a), _vectors(b)
        assert a.keys() == b.keys() and a
        np.testing.assert_allclose([b[k] for k in a], [a[k] for k in a], rtol=2e-5, atol=2e-6)


def test_half_step_shuffles_no_vector_and_leaves_no_scratch(spark):
    ratings = _ratings(spark)
    dealt = fa.DealtRatings(ratings, scratch_dir(spark, "half-step-test"))
    try:
        users = spark.createDataFrame([(u - 5, [1.0, float(u)]) for u in range(60)], "id int, features array<float>")
        step = fa.half_step(dealt.by("mid"), dealt.blocks, "mid", "uid", fa.packed(users), 2, 0.1)
        assert "Exchange" not in step._jdf.queryExecution().executedPlan().toString()
        assert step.rdd.getNumPartitions() >= dealt.blocks > 1  # not one partition for all blocks
        assert {r.id for r in step.collect()} == {r.mid for r in ratings.select("mid").distinct().collect()}
    finally:
        dealt.drop()
    assert not os.path.exists(dealt.path)


@pytest.mark.parametrize("row", [(1, 2, None), (1, None, 3.0), (None, 2, 3.0), (1, 2, float("nan"))])
def test_fit_refuses_what_spark_als_refuses(spark, row):
    ratings = spark.createDataFrame([(1, 1, 3.0), (2, 2, 4.0), row], SCHEMA)
    for fit in (ALS(userCol="uid", itemCol="mid", ratingCol="score", rank=2, maxIter=1, seed=5).fit, lambda r: mdl.als_fit(r, rank=2, iters=1)):
        with pytest.raises(Exception, match="(?i)null|nan"):
            fit(ratings)


def test_best_items_are_those_of_all_products_and_shuffle_nothing(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(70, 5)).astype("f4"), rng.normal(size=(50, 5)).astype("f4")
    y[30:40] = y[20]  # copies: ties go to the smaller id
    users = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, features array<float>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "id int, features array<float>")
    for n in (4, 50, 60):
        got = fa.best_items(users, items, 5, n)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        s = np.cumsum(x[:, None] * y[None], axis=2)[..., -1]
        want = [(u, k + 1, int(m)) for u in range(70) for k, m in enumerate(np.lexsort((np.arange(50), -s[u]))[:n])]
        assert sorted((r.uid, r.rank, r.mid) for r in got.collect()) == sorted(want)


def test_predicted_pairs_keep_columns_and_drop_unknown_ids(spark):
    model = mdl.als_fit(_ratings(spark), rank=21, iters=1)
    pairs = spark.createDataFrame([(0, 1003, "a", 1.0), (0, 1003, None, 2.0), (0, 7, "b", 1.0), (999, 1003, "c", 1.0), (1, 1004, "d", None)], "uid long, mid int, note string, score double")
    got = mdl.predict_pairs(model, pairs)
    want = model.transform(pairs).withColumnRenamed("prediction", "pred")
    assert got.columns == want.columns and got.dtypes == want.dtypes
    a, b = (sorted(df.collect(), key=str) for df in (want, got))
    assert len(a) == 3 and [r[:-1] for r in a] == [r[:-1] for r in b]
    assert [r.pred for r in b] == [r.pred for r in a]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_grid_has_the_errors_of_the_fits_on_its_split(spark):
    ratings = _ratings(spark).coalesce(1).persist()
    got = {(r.rank, r.reg): r.rmse for r in mdl.als_tune(ratings, ranks=(2, 3), regs=(0.1, 1.0), iters=1, seed=7).collect()}
    drawn = ratings.select("*", F.rand(7).alias("drawn"))
    train, rest = drawn.where("drawn < 0.8"), drawn.where("drawn >= 0.8")
    als = ALS(userCol="uid", itemCol="mid", ratingCol="score", rank=3, maxIter=1, regParam=0.1, seed=7, coldStartStrategy="drop")
    want = mdl.rmse(als.fit(train).transform(rest), predicted="prediction").first().rmse
    assert len(got) == 4 and got[3, 0.1] == pytest.approx(want, rel=1e-5)
    ratings.unpersist()


def test_latent_similarity_shuffles_no_vector_to_its_pairs(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 4))
    x[5], x[40] = 0.0, x[41]
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(900, None)], "mid int, features array<double>")
    for size, blocks in ((1024, 1), (20, 5)):
        got = similarity.item_similarity_latent(v, 0.5, block_size=size)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.rdd.getNumPartitions() >= blocks * (blocks + 1) // 2
        with np.errstate(invalid="ignore"):
            s = np.round(x @ x.T / np.outer(np.sqrt((x * x).sum(1)), np.sqrt((x * x).sum(1))), 6)
        assert {(r.m1, r.m2): r.sim for r in got.collect()} == pytest.approx({(a, b): s[a, b] for a in range(90) for b in range(90) if a != b and s[a, b] > 0.5}, abs=2e-6)
