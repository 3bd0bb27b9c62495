"""Matrix factorisation with ``pyspark.ml`` ALS, its scoring and tuning.

The recommender trains explicit ALS (rank 200, 5 iterations, lambda 0.1)
without a seed; here the seed is a parameter. The half steps are jobs of
``operators.factors``: each writes its vectors below the checkpoint folder of the
session (``spark.checkpoint.dir``), so a lost executor costs at most one of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flickmill.functions.scalar import SCORE_DIGITS, dot
from flickmill.operators.factors import (LARGEST_BLOCK, VECTORS, DealtPairs, DealtRatings, VectorFiles, best_items, held_vectors, packed, paired, restored,
                                         unpacked)
from flickmill.operators.similarity import TILE
from flickmill.session import drop_scratch, scratch_dir

# The tuning grid and the live model setting.
TUNE_RANKS = (50, 100, 200, 300)
TUNE_REGS = (0.01, 0.1, 1.0)
LIVE = dict(rank=200, iters=5, reg=0.1)
#: Blocks of users in a grid at most (each scans all items), unless one then holds more than LARGEST_BLOCK.
MOST_USER_BLOCKS = 32


def _als(rank: int, iters: int, reg: float, seed: int, checkpoint_interval: int,
         blocks: int | None) -> ALS:
    als = ALS(userCol="uid", itemCol="mid", ratingCol="score", rank=rank, maxIter=iters,
              regParam=reg, seed=seed, coldStartStrategy="drop", implicitPrefs=False,
              checkpointInterval=checkpoint_interval)
    if blocks:
        als = als.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    return als


def als_fit(ratings: DataFrame, rank: int = 200, iters: int = 5, reg: float = 0.1, seed: int = 42,
            checkpoint_interval: int = 2, blocks: int | None = None) -> ALSModel:
    """M1: explicit ALS on (uid, mid, score)."""
    dealt = DealtRatings(ratings.select("uid", "mid", "score"), scratch_dir(ratings.sparkSession, f"als-{uuid.uuid4().hex}"), rank)
    try:
        root = scratch_dir(ratings.sparkSession, f"als-model-{uuid.uuid4().hex}")
        return _fit_dealt(dealt, _als(rank, iters, reg, seed, checkpoint_interval, blocks), root)
    finally:
        dealt.drop()


def _fit_dealt(dealt: DealtRatings, als: ALS, root: str) -> ALSModel:
    """The model of ``als``, stored below ``root``. It begins with the vectors that ``als`` draws for the users (a fit of no iterations, on one
    rating of each); the half steps are those of ``factors``, and a stored model is given their tables."""
    spark, rank = dealt.spark, als.getRank()
    model, work = f"{root}/model", f"{root}/work"
    als.copy({als.maxIter: 0}).fit(dealt.begun).write().save(model)
    if als.getMaxIter() > 0:
        packed(spark.read.parquet(f"{model}/userFactors")).write.parquet(f"{work}/begin")
        users, items = dealt.fitted(spark.read.schema(VECTORS).parquet(f"{work}/begin"), rank, als.getMaxIter(), als.getRegParam(), work)
        unpacked(users, rank).write.mode("overwrite").parquet(f"{model}/userFactors")
        unpacked(items, rank).write.mode("overwrite").parquet(f"{model}/itemFactors")
        drop_scratch(spark, work)
    return ALSModel.load(model)


def predict_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predictions for given (uid, mid) pairs; unknown ids are dropped.
    Other columns of ``pairs`` (e.g. the observed score) are kept."""
    dealt = DealtPairs(pairs, scratch_dir(pairs.sparkSession, f"als-pairs-{uuid.uuid4().hex}"))
    return dealt.predicted(model.userFactors, model.itemFactors, model.rank)


def positive_predictions(pred: DataFrame, col: str = "pred") -> DataFrame:
    """Prediction > 0 (NaN is not a positive prediction)."""
    return pred.where((F.col(col) > 0) & ~F.isnan(F.col(col)))


def als_user_recs(model: ALSModel, n: int = 20) -> DataFrame:
    """M3 (M2 + P3 + W1): every user's best n items by predicted score, all
    items considered (rated ones too), positive scores only.
    A block of users meets all items in one task, which keeps the n best of each: no user x item grid is stored, and
    nothing is shuffled. (uid, rank, mid, score)."""
    recs = best_items(model.userFactors, model.itemFactors, model.rank, n)
    return recs.where((F.col("score") > 0) & ~F.isnan("score"))


def user_item_grid(users: DataFrame, items: DataFrame, block_size: int = 1024) -> DataFrame:
    """The product of every user's with every item's factors. ``users`` is (uid, features), ``items`` (mid, features).
    (uid, mid, pred).

    Either side is written once in files of few vectors (``VectorFiles``). A task holds a block of users, scans all items and
    streams the product a few users at a time: no row holds a user's full list, and no vector is shuffled. The
    result itself is users x items rows; with few pairs wanted, use ``predict_given``."""
    spark = users.sparkSession
    path = scratch_dir(spark, f"grid-{uuid.uuid4().hex}")
    most = lambda n: max(spark.sparkContext.defaultParallelism, min(-(-n // block_size), MOST_USER_BLOCKS), -(-n // LARGEST_BLOCK))
    own = VectorFiles(users.select(F.col("uid").alias("id"), "features"), f"{path}/users", most)
    other = VectorFiles(items.select(F.col("mid").alias("id"), "features"), f"{path}/items")

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, a, others = held_vectors(batches)
        for rows in others if uid is not None else ():
            mid, b = rows.column("b"), restored(rows)
            step = max(1, TILE // len(b))
            for i in range(0, len(a), step):
                scores = a[i:i + step] @ b.T
                yield pa.RecordBatch.from_arrays([uid.take(pa.array(np.repeat(np.arange(i, i + len(scores)), len(b)))),
                                                  mid.take(pa.array(np.tile(np.arange(len(b)), len(scores)))), pa.array(scores.ravel())], names=["uid", "mid", "pred"])

    return paired(own, other).mapInArrow(product, f"uid {own.kind}, mid {other.kind}, pred double")


def predict_given(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """J4 on given factors: the product for the given (uid, mid) pairs; unknown ids are dropped. (uid, mid, pred).

    Pairs that lack a vector are dropped by their ids, before any vector is joined with them."""
    known = pairs.join(users.select("uid"), "uid", "left_semi").join(items.select("mid"), "mid", "left_semi")
    both = known.join(users.select("uid", F.col("features").alias("a")), "uid").join(items.select("mid", F.col("features").alias("b")), "mid")
    return both.select("uid", "mid", dot("a", "b").alias("pred"))


def predict_all(model: ALSModel) -> DataFrame:
    """M2: a prediction for every (user, item) pair of the model (u x i rows)."""
    return user_item_grid(model.userFactors.select(F.col("id").alias("uid"), "features"), model.itemFactors.select(F.col("id").alias("mid"), "features"))


def item_factors(model: ALSModel) -> DataFrame:
    """M4: (mid, features array<double>)."""
    return model.itemFactors.select(F.col("id").alias("mid"),
                                    F.transform("features", lambda x: x.cast("double")).alias("features"))


def split_ratings(ratings: DataFrame, train: float = 0.8, seed: int = 42, by: str = "random"):
    """M6: (train, test). ``by='hash'`` is a split on (uid, mid) that is the same however the rows are laid out or
    recomputed (the first 28 bits of an MD5 of the pair and the seed, modulo 100)."""
    if by == "hash":
        key = F.md5(F.concat_ws(":", F.col("uid").cast("string"), F.col("mid").cast("string"), F.lit(str(seed))))
        bucket = F.conv(F.substring(key, 1, 7), 16, 10).cast("long") % 100
        cut = int(round(train * 100))
        return ratings.where(bucket < cut), ratings.where(bucket >= cut)
    tr, te = ratings.randomSplit([train, 1.0 - train], seed)
    return tr, te


def rmse(pred: DataFrame, actual: str = "score", predicted: str = "pred") -> DataFrame:
    """Root mean squared error of the paired columns (one row)."""
    return pred.select(F.sqrt(F.avg(F.pow(F.col(actual) - F.col(predicted), 2))).alias("rmse"))


def als_tune(ratings: DataFrame, ranks=TUNE_RANKS, regs=TUNE_REGS, iters: int = 5, seed: int = 42,
             train_ratio: float = 0.8, parallelism: int = 2) -> DataFrame:
    """M5 + K5: every (rank, lambda) of the grid fitted on one 80 % split and
    scored by RMSE on the rest; (rank, reg, rmse) best first."""
    spark, path = ratings.sparkSession, scratch_dir(ratings.sparkSession, f"als-tune-{uuid.uuid4().hex}")
    als = _als(ranks[0], iters, regs[0], seed, 2, None)
    grid = ParamGridBuilder().addGrid(als.rank, list(ranks)).addGrid(als.regParam, list(regs)).build()
    ev = RegressionEvaluator(metricName="rmse", labelCol="score", predictionCol="pred")
    # the split is drawn once and written; both parts are dealt once, for all settings
    ratings.select("uid", "mid", "score", F.rand(seed).alias("drawn")).write.parquet(f"{path}/drawn")
    drawn = spark.read.parquet(f"{path}/drawn")
    train = DealtRatings(drawn.where(F.col("drawn") < train_ratio).drop("drawn"), f"{path}/train", max(ranks))
    rest = DealtPairs(drawn.where(F.col("drawn") >= train_ratio).drop("drawn"), f"{path}/rest")
    train.deal()

    def error(params: dict) -> float:
        root = f"{path}/{uuid.uuid4().hex}"
        model = _fit_dealt(train, als.copy(params), root)
        got = ev.evaluate(rest.predicted(model.userFactors, model.itemFactors, model.rank))
        drop_scratch(spark, root)
        return got

    pool = ThreadPool(min(parallelism, len(grid)))
    try:
        errors = pool.map(inheritable_thread_target(spark)(error), grid)
    finally:
        pool.terminate()
        drop_scratch(spark, path)
    rows = [(int(pm[als.rank]), float(pm[als.regParam]), float(r))
            for pm, r in zip(grid, errors)]
    return (spark.createDataFrame(rows, "rank int, reg double, rmse double")
            .orderBy("rmse", "rank", "reg"))


def damped_mean_grid(train: DataFrame, test: DataFrame, dampings=TUNE_REGS) -> DataFrame:
    """K5's table for a baseline: RMSE on ``test`` of a movie's mean, pulled to the overall mean by each damping:
    (sum + damping * overall) / (n + damping). All dampings in one pass. (damping, rmse), best first."""
    overall = F.avg("score").alias("overall")
    sums = train.groupBy("mid").agg(F.sum("score").alias("s"), F.count(F.lit(1)).alias("n"))
    rows = (test.select("mid", "score").join(sums, "mid", "left").join(F.broadcast(train.agg(overall)))  # one row
            .withColumn("damping", F.explode(F.array(*[F.lit(float(x)) for x in dampings]))))
    pred = (F.coalesce("s", F.lit(0.0)) + F.col("damping") * F.col("overall")) / (F.coalesce("n", F.lit(0)) + F.col("damping"))
    return (rows.groupBy("damping").agg(F.round(F.sqrt(F.avg(F.pow(F.col("score") - pred, 2))), 6).alias("rmse"))
            .orderBy("rmse", "damping"))


def best_params(report: DataFrame) -> DataFrame:
    """The setting with the least RMSE."""
    rest = [c for c in report.columns if c != "rmse"]
    return report.orderBy("rmse", *rest).limit(1)


def mean_predictor(ratings: DataFrame, averages: DataFrame) -> DataFrame:
    """A baseline prediction table: every rating predicted by its movie's mean."""
    return ratings.join(averages.select("mid", F.col("avg").alias("pred")), "mid")


def round_pred(df: DataFrame, col: str = "pred") -> DataFrame:
    return df.withColumn(col, F.round(col, SCORE_DIGITS))
