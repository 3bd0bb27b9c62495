"""Aggregations over ratings, tags and item vectors (all with map-side partial
aggregation; no group is ever gathered as a list except bounded tag sets)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flickmill.functions.scalar import SCORE_DIGITS, half_star_bucket


def tags_per_movie(tags: DataFrame, sep: str = "|") -> DataFrame:
    """A1: distinct tags of a movie joined with a bar (sorted, so deterministic).

    ``collect_set`` de-duplicates on the map side, so a movie's group holds at
    most its distinct tags, never its raw tag rows."""
    return (tags.groupBy("mid")
            .agg(F.concat_ws(sep, F.array_sort(F.collect_set("tag"))).alias("tags")))


def distinct_users(ratings: DataFrame) -> DataFrame:
    """A2."""
    return ratings.select("uid").distinct()


def distinct_movies(ratings: DataFrame) -> DataFrame:
    """A2."""
    return ratings.select("mid").distinct()


def rating_histogram(ratings: DataFrame) -> DataFrame:
    """Per user, count of ratings per half-star slot round(score / 0.5), 0..10."""
    return (ratings.groupBy("uid", half_star_bucket(F.col("score")).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def rate_more_movies(ratings: DataFrame) -> DataFrame:
    """Number of ratings per movie."""
    return ratings.groupBy("mid").agg(F.count(F.lit(1)).alias("count"))


def yearmonth(ts_seconds) -> F.Column:
    from flickmill.functions.scalar import yearmonth_of_epoch
    return yearmonth_of_epoch(ts_seconds)


def rate_more_recently(ratings: DataFrame) -> DataFrame:
    """Number of ratings per (calendar month, movie); field name as stored."""
    return (ratings.groupBy(yearmonth(F.col("timestamp")).alias("yeahmonth"), "mid")
            .agg(F.count(F.lit(1)).alias("count")))


def average_movies(ratings: DataFrame) -> DataFrame:
    """A10: mean score per movie."""
    return ratings.groupBy("mid").agg(F.round(F.avg("score"), SCORE_DIGITS).alias("avg"))


def genres_top_movies(movies: DataFrame, averages: DataFrame, n: int = 10) -> DataFrame:
    """Per genre, the n movies with the best average (ties: mid ascending).

    Long rows (genres, rank, mid, score). The row_number filter becomes a
    WindowGroupLimit, so each map task keeps only n rows per genre before the
    shuffle: a genre holding a third of all movies costs n rows per task."""
    from flickmill.operators.rank import top_n_per_group
    g = (movies.select("mid", F.explode(F.split("genres", r"\|")).alias("genres"))
         .where(F.col("genres") != "")
         .distinct()
         .join(averages, "mid")
         .select("genres", "mid", F.col("avg").alias("score")))
    return top_n_per_group(g, ["genres"], [F.col("score").desc(), F.col("mid").asc()], n)


def document_frequency(postings: DataFrame, doc: str = "mid", term: str = "term") -> DataFrame:
    """Number of documents per term (postings are distinct (doc, term))."""
    return postings.groupBy(term).agg(F.count(F.lit(1)).alias("df"))


def vector_norms(weights: DataFrame, key: str = "mid", w: str = "w") -> DataFrame:
    """Euclidean norm per item of a sparse (key, term, w) table."""
    return weights.groupBy(key).agg(F.sqrt(F.sum(F.col(w) * F.col(w))).alias("norm"))


def dense_norms(vectors: DataFrame, key: str = "mid", col: str = "features") -> DataFrame:
    """A14 for dense vectors (row-local, no shuffle)."""
    from flickmill.functions.scalar import norm
    return vectors.select(key, norm(F.col(col)).alias("norm"))
