"""Table maintenance as bulk jobs: a frame of changes in, the new table out.

Each function returns the new version of the table; ``sinks.write_version``
stores it next to the old one, so readers never see a half-written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flickmill.functions.scalar import halve_score, name_to_uid


def _last_per_key(changes: DataFrame, keys: list[str], order: list[str], values: list[str]):
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("_b")
    return changes.groupBy(*keys).agg(best).select(*keys, *[F.col("_b." + v).alias(v) for v in values])


def merge_ratings(stored: DataFrame, changes: DataFrame, order_col: str | None = None,
                  halve: bool = True) -> DataFrame:
    """A pair that exists gets the new score only (timestamp unchanged); a
    new pair is inserted. Incoming scores are on the 10-point scale and halved
    (``halve=False`` for changes already on the 5-point scale).
    With several changes for one pair the last (timestamp, order_col) wins."""
    order = ["timestamp"] + ([order_col] if order_col else [])
    ch = changes.withColumn("score", halve_score(F.col("score"))) if halve else changes
    last = _last_per_key(ch, ["uid", "mid"], order, ["score", "timestamp"])
    old = stored.select("uid", "mid", F.col("score").alias("old_score"),
                        F.col("timestamp").alias("old_ts"))
    new = last.select("uid", "mid", F.col("score").alias("new_score"), F.col("timestamp").alias("new_ts"))
    j = old.join(new, ["uid", "mid"], "full_outer")
    return j.select("uid", "mid",
                    F.coalesce("new_score", "old_score").alias("score"),
                    F.coalesce("old_ts", "new_ts").alias("timestamp"))


def delete_by_key(df: DataFrame, keys: DataFrame, on: list[str] | str) -> DataFrame:
    """Remove every row whose key is listed."""
    on = [on] if isinstance(on, str) else on
    return df.join(keys.select(*on).distinct(), on, "left_anti")


def append_tags(docs: DataFrame, new_tags: DataFrame, order_col: str | None = None,
                sep: str = "|") -> DataFrame:
    """Append each new tag (in time order, repeats kept) to the document's
    tags text, or start it. Only existing documents are updated."""
    order = [F.col("timestamp")] + ([F.col(order_col)] if order_col else [])
    item = F.struct(*order, F.col("tag").alias("tag"))
    added = (new_tags.groupBy("mid")
             .agg(F.array_sort(F.collect_list(item)).alias("_l"))
             .select("mid", F.array_join(F.transform("_l", lambda x: x["tag"]), sep).alias("added")))
    return (docs.join(added, "mid", "left")
            .withColumn("tags", F.concat_ws(sep, F.col("tags"), F.col("added")))
            .withColumn("tags", F.when(F.col("tags") == "", F.lit(None)).otherwise(F.col("tags")))
            .drop("added"))


def insert_users_if_absent(users: DataFrame, names: DataFrame) -> DataFrame:
    """Every new user name becomes a row (uid = 32-bit hash of the name,
    first = true, no preferred genre); a name already present is refused.
    ``names`` has (username, timestamp)."""
    fresh = (names.groupBy("username").agg(F.min("timestamp").alias("timestamp"))
             .join(users.select("username"), "username", "left_anti"))
    rows = fresh.select(name_to_uid(F.col("username")).alias("uid"), "username",
                        F.lit(True).alias("first"), F.col("timestamp").cast("long").alias("timestamp"),
                        F.array().cast("array<string>").alias("prefGenres"))
    return users.select(*rows.columns).unionByName(rows)


def merge_preferences(users: DataFrame, prefs: DataFrame, order_col: str | None = None) -> DataFrame:
    """Append the listed genres (comma separated, repeats kept) to the
    user's preferred genres and set first = false. ``prefs`` has
    (username, genres, timestamp); several updates apply in order of (timestamp, order_col)."""
    from flickmill.functions.scalar import comma_list
    order = [F.col("timestamp")] + ([F.col(order_col)] if order_col else [])
    item = F.struct(*order, comma_list(F.col("genres")).alias("g"))
    add = (prefs.groupBy("username")
           .agg(F.array_sort(F.collect_list(item)).alias("_l"))
           .select("username", F.flatten(F.transform("_l", lambda x: x["g"])).alias("added")))
    j = users.join(add, "username", "left")
    return j.select("uid", "username",
                    F.when(F.col("added").isNotNull(), F.lit(False)).otherwise(F.col("first")).alias("first"),
                    "timestamp",
                    F.when(F.col("added").isNotNull(), F.concat("prefGenres", "added"))
                    .otherwise(F.col("prefGenres")).alias("prefGenres"))
