"""Explicit schemas of the recommender's records (no inference on read)."""

from pyspark.sql import types as T

MOVIE = T.StructType([
    T.StructField("mid", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("descri", T.StringType()),
    T.StructField("timelong", T.StringType()),
    T.StructField("issue", T.StringType()),
    T.StructField("shoot", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("actors", T.StringType()),
    T.StructField("directors", T.StringType()),
])

RATING = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.IntegerType()),
])

TAG = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("timestamp", T.IntegerType()),
])

RECOMMENDATION = T.StructType([
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])

RECS = T.ArrayType(RECOMMENDATION)

USER = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("username", T.StringType()),
    T.StructField("first", T.BooleanType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("prefGenres", T.ArrayType(T.StringType())),
])

# Long (exploded) form of a recommendation list: the working form.
LONG_RECS = "key int, rank int, mid int, score double"
