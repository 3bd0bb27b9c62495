"""Key lookups, existence checks and movie-detail joins (set-wise: a frame of
keys in, one join; a single key is a pushed-down filter)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_by_key(df: DataFrame, keys: DataFrame, on: list[str] | str) -> DataFrame:
    """Rows whose key is in ``keys``."""
    on = [on] if isinstance(on, str) else on
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def where_key(df: DataFrame, **eq) -> DataFrame:
    """P7 for one key: a filter Parquet can push down."""
    cond = F.lit(True)
    for k, v in eq.items():
        cond = cond & (F.col(k) == F.lit(v))
    return df.where(cond)


def tags_of_movie(tags: DataFrame, keys: DataFrame) -> DataFrame:
    """P8."""
    return lookup_by_key(tags, keys, ["mid"])


def tags_of_user_movie(tags: DataFrame, keys: DataFrame) -> DataFrame:
    """P8."""
    return lookup_by_key(tags, keys, ["uid", "mid"])


def key_exists(df: DataFrame, keys: DataFrame, on: list[str] | str) -> DataFrame:
    """Each key with a boolean ``exists``."""
    on = [on] if isinstance(on, str) else on
    present = df.select(*on).distinct().withColumn("exists", F.lit(True))
    return (keys.select(*on).distinct().join(present, on, "left")
            .withColumn("exists", F.coalesce(F.col("exists"), F.lit(False))))


def ratings_of_user(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """P10: all ratings of the given users (their seen set)."""
    return lookup_by_key(ratings, users, ["uid"])


def movies_for_recs(movies: DataFrame, recs: DataFrame, keep_rank: bool = True,
                    key: str = "uid") -> DataFrame:
    """Movie rows of recommendation lists. ``keep_rank=False`` is the
    IN-list form: a set of movies, duplicates collapsed, order lost."""
    if keep_rank:
        return recs.select(key, "rank", "mid").join(movies, "mid")
    return movies.join(recs.select("mid").distinct(), "mid", "left_semi")


def movies_with_avg(movies: DataFrame, averages: DataFrame) -> DataFrame:
    """Movie + its average score, 0.0 when it has none."""
    return (movies.join(averages.select("mid", F.col("avg").alias("score")), "mid", "left")
            .withColumn("score", F.coalesce(F.col("score"), F.lit(0.0))))


def my_rated_movies(ratings: DataFrame, movies: DataFrame, averages: DataFrame | None = None,
                    order: list[str] | None = None) -> DataFrame:
    """The movies each user rated, one row for each pair, with the user's own score.

    Of a pair that was rated again, the last one in ``order`` counts (without an order the highest score, so that the
    result doesn't depend on how rows are read). A null score is replaced by the movie's average of ``averages``
    (mid, avg), or 0.0 where it has none."""
    last = F.max_by("score", F.struct(*order)) if order else F.max("score")
    own = ratings.groupBy("uid", "mid").agg(last.alias("score"))
    if averages is not None:
        own = (own.join(averages.select("mid", "avg"), "mid", "left")
               .select("uid", "mid", F.coalesce("score", "avg", F.lit(0.0)).alias("score")))
    return own.join(movies, "mid")
