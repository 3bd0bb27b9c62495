"""Recommender-shaped inputs derived from the driver's parquet tables.

The recommender reads movies, ratings, tags, users, rating events and search
documents. The test tables are a TPC-H-like star schema plus event, document
and embedding tables; these adapters give rows in the recommender's schema and
do none of the recommender's work. Every adapter is a lazy DataFrame over the
parquet scan, so column pruning and filter pushdown reach the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flickmill.functions.scalar import epoch_seconds
from flickmill.plans.partitioning import spread

# The six part types in sorted order; a customer's preferred
# genre is the type at index (c_custkey mod 6).
PREFERRED_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


# Fact-sized tables whose scans are spread when they come in too few splits.
SPREAD = {"lineitem", "orders", "events", "documents", "pages", "conversations"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in SPREAD else df


def _score_from_quantity(q) -> F.Column:
    # ten even steps 0.5 .. 5.0
    return (F.ceil(q / F.lit(5.0)) / F.lit(2.0)).cast("double")


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (customer, part) purchase line as a rating, with its tie key."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        _score_from_quantity(F.col("l_quantity")).alias("score"),
        epoch_seconds(F.col("o_orderdate")).alias("timestamp"),
        "o_orderdate", "l_orderkey", "l_linenumber", "l_quantity",
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per (uid, mid): the line with the largest
    (o_orderdate, l_orderkey, l_linenumber, l_quantity).

    The maximum of a struct is lexicographic; score and time follow from its
    fields. A struct is aggregated in sorted order, so lines are dealt by pair
    first and sorted once; no (uid, mid) group is ever gathered as a list.
    """
    r = raw_ratings(spark, sf_dir).repartition("uid", "mid")
    best = F.max(F.struct("o_orderdate", "l_orderkey", "l_linenumber", "l_quantity")).alias("b")
    return (r.groupBy("uid", "mid").agg(best)
            .select("uid", "mid", _score_from_quantity(F.col("b.l_quantity")).alias("score"),
                    epoch_seconds(F.col("b.o_orderdate")).alias("timestamp")))


def movies(spark: SparkSession, sf_dir: str, with_issue: bool = True) -> DataFrame:
    """Parts as movies; genres = type | brand | words of the name."""
    p = table(spark, sf_dir, "part")
    base = p.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.col("p_name").alias("descri"),
        F.col("p_size").cast("string").alias("timelong"),
        F.lit("").alias("shoot"),
        F.lit("").alias("language"),
        F.concat_ws("|", F.col("p_type"), F.col("p_brand"),
                    F.split(F.col("p_name"), " ")).alias("genres"),
        F.lit("").alias("actors"),
        F.lit("").alias("directors"),
    )
    if not with_issue:
        return base.withColumn("issue", F.lit(""))
    first_ship = (table(spark, sf_dir, "lineitem")
                  .groupBy(F.col("l_partkey").cast("int").alias("mid"))
                  .agg(F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("issue")))
    return (base.join(first_ship, "mid", "left")
            .withColumn("issue", F.coalesce(F.col("issue"), F.lit("")))
            .select("mid", "name", "descri", "timelong", "issue", "shoot", "language",
                    "genres", "actors", "directors"))


def content_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mid, name, genres): the three movie columns the content job reads."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat_ws("|", F.col("p_type"), F.col("p_brand"),
                    F.split(F.col("p_name"), " ")).alias("genres"))


def tag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags with the id of their event."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        F.col("event_type").alias("tag"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_events(spark, sf_dir).drop("event_id")


def event_score(value) -> F.Column:
    return (F.ceil(F.least(value, F.lit(50.0)) / F.lit(5.0)) / F.lit(2.0)).cast("double")


def rating_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ``UID|MID|SCORE|TIMESTAMP`` message text, with the event time."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat_ws("|", F.col("user_id").cast("string"),
                    F.get_json_object("props", "$.k"),
                    event_score(F.col("value")).cast("string"),
                    epoch_seconds(F.col("ts")).cast("string")).alias("value"),
        F.col("event_id"),
        F.col("ts"),
    )


def rating_log_lines(spark: SparkSession, sf_dir: str,
                     prefix: str = "MOVIE_RATING_PREFIX") -> DataFrame:
    """Application log lines: purchases log a rating message, other events a plain line."""
    e = table(spark, sf_dir, "events")
    msg = F.concat_ws("|", F.col("user_id").cast("string"),
                      F.get_json_object("props", "$.k"),
                      event_score(F.col("value")).cast("string"),
                      epoch_seconds(F.col("ts")).cast("string"))
    stamp = F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss,SSS")
    rating = F.concat(stamp, F.lit("   INFO --- [http-nio] ratings.service   (line:   1)  :  "),
                      F.lit(prefix + ":"), msg)
    other = F.concat(stamp, F.lit("   INFO --- [http-nio] users.service   (line:   1)  :  "),
                     F.col("event_type"), F.lit(" "), F.col("event_id").cast("string"))
    return e.select(F.when(F.col("event_type") == "purchase", rating).otherwise(other).alias("value"),
                    F.col("event_id"))


def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mid, name, descri): name = first five words of the text."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("int").alias("mid"),
        F.regexp_extract("text", r"^\s*(\S+(\s+\S+){0,4})", 1).alias("name"),
        F.col("text").alias("descri"),
    )


def latent_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("int").alias("mid"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("features"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    types = F.array(*[F.lit(t) for t in PREFERRED_TYPES])
    return c.select(
        F.col("c_custkey").cast("int").alias("uid"),
        F.col("c_name").alias("username"),
        F.lit(False).alias("first"),
        F.lit(0).cast("long").alias("timestamp"),
        F.array(F.element_at(types, (F.pmod(F.col("c_custkey"), F.lit(6)) + 1).cast("int")))
        .alias("prefGenres"),
    )
