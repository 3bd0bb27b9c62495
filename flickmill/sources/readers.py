"""Readers and parsers (text files, stored tables, rating messages, log lines).

Every parser works on a DataFrame with a ``value`` string column, so the same
code serves ``spark.read.text`` in batch and ``spark.readStream.text`` in a
stream. ``mode='strict'`` fails the job on a bad line like the recommender
(ANSI casts raise); ``mode='reject'`` returns ``(good, rejects)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flickmill import schemas
from flickmill.functions.scalar import split_fields, to_double, to_int


def _lines(spark: SparkSession, source) -> DataFrame:
    if isinstance(source, DataFrame):
        return source.select("value")
    return spark.read.text(source)


def _finish(parsed: DataFrame, ok: F.Column, cols: list[str], mode: str):
    if mode == "strict":
        return parsed.select(*cols)
    flagged = parsed.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    good = flagged.where("_ok").select(*cols)
    bad = flagged.where(~F.col("_ok")).select("value")
    return good, bad


MOVIE_FIELDS = ["mid", "name", "descri", "timelong", "issue", "shoot", "language",
                "genres", "actors", "directors"]


def load_movies(spark: SparkSession, source, mode: str = "strict"):
    """``^``-separated movie lines; field 0 to int untrimmed, 1-9 trimmed."""
    strict = mode == "strict"
    f = split_fields(F.col("value"), r"\^")
    cols = [(f.getItem(0).cast("int") if strict else f.getItem(0).try_cast("int")).alias("mid")]
    cols += [F.trim(f.getItem(i)).alias(MOVIE_FIELDS[i]) for i in range(1, 10)]
    parsed = _lines(spark, source).select("value", F.size(f).alias("_n"), *cols)
    if strict:
        parsed = parsed.withColumn(
            "mid", F.when(F.col("_n") >= 10, F.col("mid"))
            .otherwise(F.raise_error(F.concat(F.lit("short movie line: "), F.col("value")))))
    ok = (F.col("_n") >= 10) & F.col("mid").isNotNull()
    return _finish(parsed, ok, MOVIE_FIELDS, mode)


def _csv4(spark, source, names, kinds, mode):
    strict = mode == "strict"
    f = split_fields(F.col("value"), ",")
    cols = []
    for i, (n, k) in enumerate(zip(names, kinds)):
        v = f.getItem(i)
        if k == "int":
            cols.append(to_int(v, strict).alias(n))
        elif k == "double":
            cols.append(to_double(v, strict).alias(n))
        else:
            cols.append(F.trim(v).alias(n))
    parsed = _lines(spark, source).select("value", F.size(f).alias("_n"), *cols)
    if strict:
        parsed = parsed.withColumn(
            names[0], F.when(F.col("_n") >= 4, F.col(names[0]))
            .otherwise(F.raise_error(F.concat(F.lit("short line: "), F.col("value")))))
    ok = F.col("_n") >= 4
    for n in names:
        ok = ok & F.col(n).isNotNull()
    return _finish(parsed, ok, names, mode)


def load_tags(spark: SparkSession, source, mode: str = "strict"):
    """``uid,mid,tag,timestamp``; tag trimmed."""
    return _csv4(spark, source, ["uid", "mid", "tag", "timestamp"],
                 ["int", "int", "string", "int"], mode)


def load_ratings(spark: SparkSession, source, mode: str = "strict"):
    """S3: ``uid,mid,score,timestamp``."""
    return _csv4(spark, source, ["uid", "mid", "score", "timestamp"],
                 ["int", "int", "double", "int"], mode)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet", **options) -> DataFrame:
    """Typed read of a stored table; the format is a parameter so another
    connector can be plugged in."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def parse_rating_events(lines: DataFrame, mode: str = "strict"):
    """``UID|MID|SCORE|TIMESTAMP`` messages to typed rating rows.

    Extra input columns are carried along (e.g. an arrival order column)."""
    strict = mode == "strict"
    f = split_fields(F.col("value"), r"\|")
    extra = [c for c in lines.columns if c != "value"]
    parsed = lines.select(
        "value", *extra, F.size(f).alias("_n"),
        to_int(f.getItem(0), strict).alias("uid"),
        to_int(f.getItem(1), strict).alias("mid"),
        to_double(f.getItem(2), strict).alias("score"),
        to_int(f.getItem(3), strict).alias("timestamp"))
    cols = ["uid", "mid", "score", "timestamp"] + extra
    if strict:
        parsed = parsed.withColumn(
            "uid", F.when(F.col("_n") >= 4, F.col("uid"))
            .otherwise(F.raise_error(F.concat(F.lit("bad rating message: "), F.col("value")))))
    ok = (F.col("_n") >= 4) & F.col("uid").isNotNull() & F.col("mid").isNotNull() \
        & F.col("score").isNotNull() & F.col("timestamp").isNotNull()
    return _finish(parsed, ok, cols, mode)


def extract_rating_log(lines: DataFrame, prefix: str = "MOVIE_RATING_PREFIX") -> DataFrame:
    """Keep log lines carrying the rating prefix; the message after ``PREFIX:``."""
    marker = prefix + ":"
    extra = [c for c in lines.columns if c != "value"]
    return (lines.where(F.col("value").contains(marker))
            .select(F.trim(F.substring_index(F.col("value"), marker, -1)).alias("value"), *extra))


def parse_recent_list(df: DataFrame, k: int = 20, key: str = "uid",
                      list_col: str = "recent") -> DataFrame:
    """``MID:SCORE`` strings (newest first) -> long rows (key, rank, mid, score), first k."""
    items = F.slice(F.col(list_col), 1, k)
    return (df.select(key, F.posexplode(items).alias("pos", "item"))
            .select(key, (F.col("pos") + 1).cast("int").alias("rank"),
                    F.trim(F.split(F.col("item"), ":").getItem(0)).cast("int").alias("mid"),
                    F.trim(F.split(F.col("item"), ":").getItem(1)).cast("double").alias("score")))


def format_recent_list(recent_long: DataFrame, key: str = "uid") -> DataFrame:
    """Inverse of S8 for bounded (top-k) long rows: key -> ``MID:SCORE`` list, newest first."""
    item = F.struct(F.col("rank"), F.concat_ws(":", F.col("mid").cast("string"),
                                                F.col("score").cast("string")).alias("s"))
    return (recent_long.groupBy(key)
            .agg(F.array_sort(F.collect_list(item)).alias("_l"))
            .select(key, F.transform("_l", lambda x: x["s"]).alias("recent")))


def movie_lines(movies: DataFrame) -> DataFrame:
    """Movies back to their ``^``-separated text form (fixture for S1)."""
    return movies.select(F.concat_ws("^", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                           for c in MOVIE_FIELDS]).alias("value"))


def csv_lines(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows back to comma-separated text (fixture for S2, S3)."""
    return df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in cols]).alias("value"))


MOVIE_SCHEMA = schemas.MOVIE
