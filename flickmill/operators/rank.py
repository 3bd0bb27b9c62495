"""Ranking, top-k and list forms.

Top-k per group is ``row_number() <= k`` over a window: Spark plans it as a
WindowGroupLimit, keeping k rows per group in every map task before the
shuffle, so a hot group never reaches one task in full. Ties are always broken
by id ascending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flickmill.operators.similarity import FactoredSims


def top_n_per_group(df: DataFrame, group_cols: list, order_cols: list, n: int | None,
                    rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    if n is not None:
        ranked = ranked.where(F.col(rank_col) <= n)
    return ranked


def by_score(score: str = "score", mid: str = "mid") -> list[Column]:
    return [F.col(score).desc(), F.col(mid).asc()]


def recs_to_lists(long_recs: DataFrame, key: str, mid: str = "mid",
                  score: str = "score") -> DataFrame:
    """A3: long rows -> key + list of (mid, score), best first.

    Meant for capped lists (top-n outputs); the long form is the working form."""
    item = F.struct((-F.col(score)).alias("neg"), F.col(mid).alias("mid"),
                    F.col(score).alias("score"))
    return (long_recs.groupBy(key)
            .agg(F.array_sort(F.collect_list(item)).alias("_l"))
            .select(key, F.transform("_l", lambda x: F.struct(x["mid"].alias("mid"),
                                                              x["score"].alias("score")))
                    .alias("recs")))


def lists_to_long(lists: DataFrame, key: str, recs: str = "recs") -> DataFrame:
    """Stored list form -> long rows (key, mid, score)."""
    return (lists.select(key, F.explode(recs).alias("r"))
            .select(key, F.col("r.mid").alias("mid"), F.col("r.score").alias("score")))


def user_top_n(scores: DataFrame, n: int = 20, key: str = "uid") -> DataFrame:
    """W1 on given (key, mid, score) predictions: best n per key, already rated kept."""
    return top_n_per_group(scores, [key], by_score(), n)


def similar_items_all(sims: DataFrame | FactoredSims, n: int | None = None) -> DataFrame:
    """Per item all similar items over the cut, best first; optional cap.

    Of factored similarities, items are ranked once for each signature; a member's list is its signature's without
    itself, so the expanded pairs are never sorted."""
    order = [F.col("sim").desc(), F.col("m2").asc()]
    if not isinstance(sims, FactoredSims):
        return top_n_per_group(sims.select("m1", "m2", "sim"), ["m1"], order, n).select("m1", "rank", "m2", "sim")
    members = sims.members.where("mid is not null").select("mid", "sig")
    # the list of an id that stands more than once is put together from all of its rows
    often = members.groupBy("mid").count().where("count > 1").select("mid")
    once, more = members.join(often, "mid", "left_anti"), members.join(often, "mid", "left_semi")
    own = F.max(F.when(F.col("s1") == F.col("s2"), F.col("sim"))).over(Window.partitionBy("s1"))
    listed = sims.pairs.select("s1", "s2", "sim").withColumn("own", own).join(members.select(F.col("mid").alias("m2"), F.col("sig").alias("s2")), "s2").drop("s2")
    placed = top_n_per_group(listed, ["s1"], order, None if n is None else n + 1, "place")
    itself_before = (F.col("own") > F.col("sim")) | ((F.col("own") == F.col("sim")) & (F.col("m1") < F.col("m2")))
    out = (placed.join(once.select(F.col("mid").alias("m1"), F.col("sig").alias("s1")), "s1").where(F.col("m1") != F.col("m2"))
           .select("m1", (F.col("place") - F.when(itself_before, 1).otherwise(0)).alias("rank"), "m2", "sim"))
    if n is not None:
        out = out.where(F.col("rank") <= n)
    rest = (listed.join(more.select(F.col("mid").alias("m1"), F.col("sig").alias("s1")), "s1").where(F.col("m1") != F.col("m2"))
            .select("m1", "m2", "sim"))
    return out.unionByName(similar_items_all(rest, n))


def hot_movies(monthly: DataFrame, n: int = 10) -> DataFrame:
    """Most recent months first (then count, then mid), first n."""
    return (monthly.orderBy(F.col("yeahmonth").desc(), F.col("count").desc(), F.col("mid").asc())
            .limit(n))


def most_rated_movies(counts: DataFrame, n: int = 10) -> DataFrame:
    """By rating count descending, first n."""
    return counts.orderBy(F.col("count").desc(), F.col("mid").asc()).limit(n)


def newest_movies(movies: DataFrame, n: int = 10, by_date: bool = False) -> DataFrame:
    """By ``issue`` descending (as text, like the store), first n."""
    k = F.to_date("issue", "yyyy-MM-dd") if by_date else F.col("issue")
    return movies.orderBy(k.desc_nulls_last(), F.col("mid").asc()).limit(n)


def recs_top_n(long_recs: DataFrame, key: str, n: int, keys: DataFrame | None = None) -> DataFrame:
    """First n of each stored list by score; keys absent -> no rows."""
    df = long_recs if keys is None else long_recs.join(keys.select(key).distinct(), key, "left_semi")
    return top_n_per_group(df.select(key, "mid", "score"), [key], by_score(), n)


def top_in_genre(genre_top: DataFrame, genres: DataFrame | None, n: int) -> DataFrame:
    """First n of a genre's list (genre_top is long form of A11)."""
    return recs_top_n(genre_top.select("genres", "mid", "score"), "genres", n, genres)
