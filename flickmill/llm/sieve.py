"""Rows that a join by key may find a partner for, kept before their texts are shuffled."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap, bits for each key, and bitmaps at most (4 KB each; beyond that more rows pass without a partner).
BITS, BITS_EACH, MOST = 32_768, 16, 4_096


def sieved(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in the one column of ``keys``, and some others (about 1 in 16, more beyond 8
    million keys). Row by row, against bitmaps of the keys' hashes, of 16 MB at most; both columns are of one type."""
    of = keys.columns[0]
    if df.schema[key].dataType != keys.schema[of].dataType:
        raise TypeError(f"{key} and {of} differ in type")
    n = min(MOST, max(1, math.ceil(keys.count() * BITS_EACH / BITS)))

    def place(name: str) -> F.Column:
        return F.pmod(F.xxhash64(F.col(f"`{name}`")), F.lit(n * BITS)) + 1

    bits = keys.where(F.col(f"`{of}`").isNotNull()).groupBy(F.bitmap_bucket_number(place(of)).alias("__bitmap")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place(of))).alias("__bits"))
    at = F.bitmap_bit_position(place(key))
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = df.withColumn("__bitmap", F.bitmap_bucket_number(place(key))).join(F.broadcast(bits), "__bitmap")
    return found.where(F.bit_get(byte, (at % 8).cast("int")) == 1).select(*[F.col(f"`{c}`") for c in df.columns])
