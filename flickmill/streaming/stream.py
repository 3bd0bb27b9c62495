"""Structured Streaming: rating events in, re-ranked lists out.

The job of the recommender, per micro-batch (every 4 s):
  parse ``UID|MID|SCORE|TIMESTAMP`` messages -> for every user of the batch:
  anchor = the user's last event, recent = last K ratings (events included),
  seen = all rated movies (events included) -> unseen similar candidates ->
  scores -> the user's list is replaced (an empty list replaces too).

Storage (``StreamStore``) is dealt by user into ``buckets`` folders, so a batch
reads the folders of its own users only:
  base/v=V/{pairs,recent,recs}/bucket=B   all up to some batch: the rated pairs,
                                          each user's newest K events, the lists
  events/epoch=E/bucket=B                 parsed events of batch E
  stream_recs/epoch=E                     the new lists of the users of batch E (a
                                          row with a null mid marks an empty list)
  rejects/epoch=E                         messages that did not parse
A replayed batch (after a failure) rewrites exactly its own partitions, so the
sink is idempotent and the checkpoint gives exactly-once results. No batch
rewrites a whole table. ``compact`` folds batches into a new version of the base
and swaps it in by one manifest row; folders that the version before had already
folded are then removed, so readers that started before the swap still find
theirs. The stream calls it every ``compact_every`` batches. The similarity table
is re-read every batch, so a refreshed table is picked up without a restart.
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass
from operator import itemgetter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from flickmill.operators.online import stream_priority, unseen_similar
from flickmill.operators.rank import top_n_per_group
from flickmill.sources.readers import extract_rating_log, parse_rating_events
from flickmill.sources.sinks import commit_version, current_version

EVENT_SCHEMA = "uid int, mid int, score double, timestamp int, seq long"
RECS_SCHEMA = "uid int, mid int, score double"
PAIR_SCHEMA = "uid int, mid int, score double, timestamp int"
#: The order of a user's events, newest first.
NEWEST = ["timestamp", "epoch", "seq"]


@dataclass
class StreamStore:
    """``buckets`` folders by user (many on a cluster: a batch reads those of its users) and the ``keep`` newest events of
    each; both are fixed when the store is made."""
    root: str
    buckets: int = 16
    keep: int = 20

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)


@dataclass
class Base:
    """The current base: its version, the last batch folded into it, and its tables (listed when asked for)."""
    spark: SparkSession
    path: str
    version: int
    upto: int

    @property
    def pairs(self) -> DataFrame:
        return self._table("pairs", PAIR_SCHEMA)

    @property
    def recent(self) -> DataFrame:
        return self._table("recent", PAIR_SCHEMA + ", epoch long, seq long")

    @property
    def recs(self) -> DataFrame:
        return self._table("recs", RECS_SCHEMA + ", epoch long")

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema + ", bucket int").parquet(os.path.join(self.path, name))


def _bucket(store: StreamStore) -> F.Column:
    return F.pmod(F.xxhash64("uid"), F.lit(store.buckets)).cast("int")


def _no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """Without Python: the parts of a local list are unpickled by a task each, of no rows too."""
    return spark.range(0, numPartitions=1).select(F.from_json(F.lit("{}"), schema).alias("r")).select("r.*")


def _newest(events: DataFrame, k: int) -> DataFrame:
    return top_n_per_group(events, ["uid"], [F.col(c).desc() for c in NEWEST] + [F.col("mid").asc()], k)


def init_store(store: StreamStore, ratings: DataFrame) -> None:
    """Base tables the stream starts from."""
    spark = ratings.sparkSession
    none = F.lit(-1).cast("long")

    def recent(pairs: DataFrame) -> DataFrame:
        return _newest(pairs.select("uid", "mid", "score", "timestamp", none.alias("epoch"), none.alias("seq")), store.keep).drop("rank")

    _write_base(store, spark, -1, ratings.select("uid", "mid", "score", "timestamp"), recent, _no_rows(spark, RECS_SCHEMA + ", epoch long"))


def _write_base(store: StreamStore, spark: SparkSession, upto: int, pairs: DataFrame, recent, recs: DataFrame) -> int:
    """``recent`` is made of the written pairs, or given."""
    version = time.time_ns() // 1000
    path = store.path(f"base/v={version}")

    def write(name: str, df: DataFrame) -> None:
        # rebalance: a large folder is written by several tasks, small ones share one
        df.withColumn("bucket", _bucket(store)).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(os.path.join(path, name))

    write("pairs", pairs)
    write("recent", recent(Base(spark, path, version, upto).pairs) if callable(recent) else recent)
    write("recs", recs)
    spark.range(1, numPartitions=1).select(F.lit(upto).cast("long").alias("upto")).write.parquet(os.path.join(path, "about"))
    commit_version(spark, store.path("base"), version)
    return version


def read_base(spark: SparkSession, store: StreamStore) -> Base:
    version = current_version(spark, store.path("base"))
    if version is None:
        raise ValueError(f"no store at {store.root}")
    path = store.path(f"base/v={version}")
    return Base(spark, path, version, spark.read.schema("upto long").parquet(os.path.join(path, "about")).first()["upto"])


def _read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A batch-partitioned log; empty before its first batch. Any other read error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return _no_rows(spark, schema)


def _events(spark: SparkSession, store: StreamStore) -> DataFrame:
    return _read_log(spark, store.path("events"), EVENT_SCHEMA + ", epoch long, bucket int")


def _lists(spark: SparkSession, store: StreamStore) -> DataFrame:
    return _read_log(spark, store.path("stream_recs"), RECS_SCHEMA + ", epoch long")


def _write_partition(df: DataFrame, path: str, epoch: int, by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).parquet(os.path.join(path, f"epoch={epoch}"))


def rating_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                  starting_offsets: str = "latest", **options) -> DataFrame:
    """The message stream as (value string, seq long).

    Kafka: subscribe with ``subscribe=<topic>`` and ``kafka.bootstrap.servers``;
    it starts at the latest offset and resumes from the checkpoint. Files:
    parquet files with (value, seq), or text files (seq = the file's modification
    time in microseconds; rows of one file and time stamp tie)."""
    if fmt == "kafka":
        r = spark.readStream.format("kafka").option("startingOffsets", starting_offsets)
        df = r.options(**options).load()
        return df.select(F.col("value").cast("string").alias("value"),
                         (F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("seq"))
    if fmt == "text":
        df = spark.readStream.options(**options).text(path)
        return df.select("value", F.unix_micros("_metadata.file_modification_time").alias("seq"))
    return spark.readStream.schema("value string, seq long").options(**options).format(fmt).load(path)


def process_batch(batch: DataFrame, epoch: int, store: StreamStore, sims_loader,
                  k: int = 20, n: int = 20, min_sim: float = 0.7, like_above: float = 3.0) -> None:
    """One micro-batch, all of its users at once."""
    spark = batch.sparkSession
    if k > store.keep:
        raise ValueError(f"the store keeps {store.keep} events of each user, not {k}")
    held = batch.select("value", "seq").persist()  # parsed for both outputs, read from the source once
    good, bad = parse_rating_events(held, mode="reject")
    _write_partition(bad, store.path("rejects"), epoch)
    _write_partition(good.select("uid", "mid", "score", "timestamp", "seq", _bucket(store).alias("bucket"))
                     .hint("rebalance", "bucket"), store.path("events"), epoch, "bucket")
    held.unpersist()

    ev = spark.read.schema(EVENT_SCHEMA + ", bucket int").parquet(os.path.join(store.path("events"), f"epoch={epoch}"))
    ev = ev.withColumn("epoch", F.lit(epoch).cast("long"))
    users = ev.select("uid").distinct()
    seen, history = user_history(spark, store, ev, epoch)
    recent = _newest(history, k)
    anchors = _newest(ev.select(*history.columns), 1).select("uid", F.col("mid").alias("anchor"))

    sims = sims_loader(spark)
    cands = unseen_similar(anchors, sims, seen, n)
    scores = stream_priority(cands, recent, sims, min_sim, like_above)
    out = users.join(scores, "uid", "left").select("uid", "mid", "score")
    _write_partition(out, store.path("stream_recs"), epoch)


def user_history(spark: SparkSession, store: StreamStore, ev: DataFrame, epoch: int) -> tuple[DataFrame, DataFrame]:
    """Of the users of the events ``ev`` of batch ``epoch``: rated pairs (uid, mid), and events (the newest ``keep`` of each
    at least). Only the folders of their buckets are read, of the base and of the batches that it does not hold yet."""
    buckets = [r.bucket for r in ev.select("bucket").distinct().collect()]  # at most as many numbers as there are folders
    own = F.col("bucket").isin(buckets) if buckets else F.lit(False)
    users = ev.select("uid").distinct()
    base = read_base(spark, store)
    log = _events(spark, store).where((F.col("epoch") > base.upto) & (F.col("epoch") <= epoch) & own).join(users, "uid", "left_semi")
    pairs = base.pairs.where(own).join(users, "uid", "left_semi")
    old = base.recent.where(own).join(users, "uid", "left_semi")
    columns = ["uid", "mid", "score", "timestamp", "epoch", "seq"]
    return pairs.select("uid", "mid").unionByName(log.select("uid", "mid")).distinct(), old.select(*columns).unionByName(log.select(*columns))


def current_stream_recs(spark: SparkSession, store: StreamStore) -> DataFrame:
    """StreamRecs as of the last batch: each user's newest list. (uid, rank, mid, score)."""
    rows = _newest_lists(spark, store, read_base(spark, store)).where(F.col("mid").isNotNull())
    return (top_n_per_group(rows.select("uid", "mid", "score"), ["uid"],
                            [F.col("score").desc(), F.col("mid").asc()], None)
            .select("uid", "rank", "mid", "score"))


def _newest_lists(spark: SparkSession, store: StreamStore, base: Base, upto: int | None = None) -> DataFrame:
    new = _lists(spark, store).where(F.col("epoch") > base.upto)
    new = new if upto is None else new.where(F.col("epoch") <= upto)
    log = base.recs.drop("bucket").unionByName(new)
    last = log.groupBy("uid").agg(F.max("epoch").alias("epoch"))
    return log.join(last, ["uid", "epoch"]).select("uid", "mid", "score", "epoch")


def current_ratings(spark: SparkSession, store: StreamStore) -> DataFrame:
    """The rating table with all events so far: a pair has the score of its event that arrived last, and the time it was
    first rated. (uid, mid, score, timestamp)."""
    base = read_base(spark, store)
    return _merged(base.pairs, _events(spark, store).where(F.col("epoch") > base.upto))


def _merged(pairs: DataFrame, log: DataFrame) -> DataFrame:
    """In the order of arrival, so that it makes no difference how many batches are folded at once."""
    arrival = F.struct("epoch", "seq", "timestamp")
    new = log.groupBy("uid", "mid").agg(F.max_by("score", arrival).alias("new_score"), F.min_by("timestamp", arrival).alias("new_time"))
    # the new pairs are hashed, so the stored ones, many more, are not sorted to be joined
    both = pairs.select("uid", "mid", "score", "timestamp").join(new.hint("shuffle_hash"), ["uid", "mid"], "full_outer")
    return both.select("uid", "mid", F.coalesce("new_score", "score").alias("score"), F.coalesce("timestamp", "new_time").alias("timestamp"))


def compact(spark: SparkSession, store: StreamStore, upto: int) -> int:
    """Fold the batches up to ``upto`` into a new base version, make it current, and remove the folders that the version
    before no longer needed. Nothing of what readers see changes. Returns the version.

    A run that dies before the swap leaves an unlisted folder and the store as it was; a batch replayed after the swap
    writes folders that are already folded and are not read again."""
    base = read_base(spark, store)
    if upto <= base.upto:
        return base.version
    log = _events(spark, store).where((F.col("epoch") > base.upto) & (F.col("epoch") <= upto))
    columns = ["uid", "mid", "score", "timestamp", "epoch", "seq"]
    # a user without new events keeps the newest ones as they are
    users = log.select("uid").distinct().hint("shuffle_hash")
    old = base.recent.select(*columns)
    ranked = _newest(old.join(users, "uid", "left_semi").unionByName(log.select(*columns)), store.keep).drop("rank")
    recent = old.join(users, "uid", "left_anti").unionByName(ranked)
    version = _write_base(store, spark, upto, _merged(base.pairs, log), recent, _newest_lists(spark, store, base, upto))
    _remove(spark, store.path("base"), "v=", lambda v: v < base.version)
    for name in ("events", "stream_recs"):
        _remove(spark, store.path(name), "epoch=", lambda e: e <= base.upto)
    return version


def _remove(spark: SparkSession, path: str, prefix: str, old) -> None:
    """Delete the numbered folders below ``path`` that are ``old``, through the file system that holds them."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(root):
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith(prefix) and old(int(name[len(prefix):])):
                fs.delete(status.getPath(), True)


def run_stream(source: DataFrame, store: StreamStore, sims_loader, checkpoint: str,
               trigger: str | None = "4 seconds", available_now: bool = False,
               k: int = 20, n: int = 20, compact_every: int = 100):
    """Start the streaming job; returns the StreamingQuery. Every ``compact_every``-th batch (0: none) is followed by a
    compaction, in the same thread, so no batch runs beside it."""
    def run(df: DataFrame, epoch: int) -> None:
        process_batch(df, epoch, store, sims_loader, k, n)
        if compact_every and (epoch + 1) % compact_every == 0:
            compact(df.sparkSession, store, epoch)

    w = (source.writeStream
         .foreachBatch(run)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def recent_state(events: DataFrame, k: int = 20) -> DataFrame:
    """Per user, the newest k (mid, score) as ``MID:SCORE`` strings,
    newest first, kept as keyed state (at most k entries per user). "Newest"
    is by (timestamp, seq); when events arrive in time order this is the
    arrival order of the recommender's queue. Emits the updated lists of the
    users of each batch. Events carry (uid, mid, score, timestamp, seq)."""
    import pandas as pd

    def fn(key, pdfs, state):
        top = list(zip(*state.get)) if state.exists else []  # (mid, score, timestamp, seq)
        for chunk in pdfs:  # k rows and one Arrow chunk at a time, however many events the user has
            top += zip(*(chunk[c].tolist() for c in ("mid", "score", "timestamp", "seq")))
            top.sort(key=itemgetter(2, 3), reverse=True)
            del top[k:]
        state.update(tuple([kind(r[i]) for r in top] for i, kind in enumerate((int, float, int, int))))
        yield pd.DataFrame({"uid": [int(key[0])],
                            "recent": [[f"{int(m)}:{float(sc)}" for m, sc, _, _ in top]]})

    return (events.select("uid", "mid", "score", "timestamp", "seq").groupBy("uid")
            .applyInPandasWithState(fn, "uid int, recent array<string>",
                                    "mids array<int>, scores array<double>, ts array<long>, seqs array<long>",
                                    "update", GroupStateTimeout.NoTimeout))


def bridge_stream(spark: SparkSession, log_dir: str, out_dir: str, checkpoint: str,
                  available_now: bool = False, trigger: str = "4 seconds",
                  prefix: str = "MOVIE_RATING_PREFIX"):
    """Application log lines -> rating messages, written as parquet
    (value, seq) for ``rating_stream(fmt='parquet')``."""
    lines = spark.readStream.text(log_dir)
    # arrival order = the log line's own time stamp (microseconds)
    stamp = F.to_timestamp(F.substring("value", 1, 23), "yyyy-MM-dd HH:mm:ss,SSS")
    msgs = (extract_rating_log(lines.withColumn("seq", F.unix_micros(stamp)), prefix)
            .select("value", "seq"))
    w = msgs.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def save_sims(sims, root: str) -> int:
    """Write a factored similarity table, with its places, as a new version below ``root`` and make it the current one."""
    sims = sims.placed()
    version = time.time_ns() // 1000
    sims.members.write.parquet(os.path.join(root, f"v={version}", "members"))
    sims.pairs.write.parquet(os.path.join(root, f"v={version}", "pairs"))
    commit_version(sims.members.sparkSession, root, version)
    return version


def sims_reader(root: str):
    """T5: a loader of the current similarity table (called every batch)."""
    from flickmill.operators.similarity import FactoredSims

    def load(spark):
        path = os.path.join(root, f"v={current_version(spark, root)}")
        return FactoredSims(spark.read.parquet(os.path.join(path, "members")),
                            spark.read.parquet(os.path.join(path, "pairs")))
    return load
