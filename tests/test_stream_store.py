"""The stream's store: folders by user, compaction, state of one busy user."""

import os
import re
import uuid

from pyspark.sql import functions as F

from flickmill.operators.similarity import content_similarity
from flickmill.session import scratch_dir
from flickmill.streaming import stream as st


def _items(spark):
    kinds = ["a|b|c", "a|b|d", "a|b", "x|y", "x|y|z", "q"]
    return spark.createDataFrame([(i, f"m{i}", kinds[i % 6]) for i in range(24)], "mid int, name string, genres string")


def _store(spark, buckets=16):
    store = st.StreamStore(scratch_dir(spark, f"store-{uuid.uuid4().hex}"), buckets=buckets, keep=20)
    ratings = [(u, (u * 7 + j) % 24, 1.0 + j % 5, 100 + j) for u in range(200) for j in range(5)]
    st.init_store(store, spark.createDataFrame(ratings, "uid int, mid int, score double, timestamp int"))
    st.save_sims(content_similarity(_items(spark), 0.3), store.path("sims"))
    return store


def _batch(spark, epoch):
    """Users 0 to 5 often, one pair again and again, one bad line; a new user."""
    rows = [(f"{u}|{(u + 3 * epoch + j) % 24}|{1.0 + (j + epoch) % 5}|{200 + 10 * epoch + j}", 100 * epoch + 10 * u + j) for u in range(6) for j in range(6)]
    rows += [(f"9|4|{epoch + 1}.0|{300 + epoch}", 100 * epoch + 90), ("9|4|x|1", 0), (f"{5_000 + epoch}|{epoch}|5.0|{400 + epoch}", 7)]
    return spark.createDataFrame(rows, "value string, seq long")


def _run(spark, store, epochs, compact_at=()):
    for e in epochs:
        st.process_batch(_batch(spark, e), e, store, st.sims_reader(store.path("sims")))
        if e in compact_at:
            st.compact(spark, store, e)
    lists = sorted(tuple(r) for r in st.current_stream_recs(spark, store).collect())
    return lists, sorted(tuple(r) for r in st.current_ratings(spark, store).collect())


def _numbers(store, name, prefix):
    return sorted(int(f[len(prefix):]) for f in os.listdir(store.path(name)) if f.startswith(prefix))


def test_a_batch_reads_its_users_folders_only(spark):
    store = _store(spark)
    _run(spark, store, [0, 1])
    ev = spark.read.schema(st.EVENT_SCHEMA + ", bucket int").parquet(os.path.join(store.path("events"), "epoch=1")).withColumn("epoch", F.lit(1).cast("long"))
    ev = ev.where("uid in (2, 9)")
    own = {r.bucket for r in ev.select("bucket").distinct().collect()}
    assert 0 < len(own) <= 2
    for df in st.user_history(spark, store, ev, 1):
        read = {int(b) for b in re.findall(r"bucket=(\d+)", " ".join(_files(df)))}
        assert read == own
    assert {r.uid for r in st.user_history(spark, store, ev, 1)[1].select("uid").distinct().collect()} == {2, 9}


def _files(df):
    """The folders that the plan's scans of the base and the log keep: their numbers stand in the partition filters."""
    text = df._jdf.queryExecution().sparkPlan().toString()
    filters = [f for f in re.findall(r"PartitionFilters: \[([^\]]*)\]", text) if "bucket" in f]
    assert len(filters) == 2, text
    return [f"bucket={b}" for f in filters for many, one in re.findall(r"bucket#\d+ IN \(([\d,]+)\)|bucket#\d+ = (\d+)\)", f) for b in (many or one).split(",")]


def test_compaction_changes_nothing_and_clears(spark):
    plain = _run(spark, _store(spark), range(3))
    store = _store(spark)
    assert _run(spark, store, range(3), compact_at=(0, 1)) == plain and len(plain[0]) > 0
    assert len({r[:2] for r in plain[1]}) == len(plain[1])
    base = st.read_base(spark, store)
    assert base.upto == 1 and base.recent.groupBy("uid").count().agg(F.max("count")).first()[0] <= store.keep
    assert _numbers(store, "events", "epoch=") == [1, 2] == _numbers(store, "stream_recs", "epoch=")
    assert len(_numbers(store, "base", "v=")) == 2
    # the last batch, replayed after it was folded
    st.compact(spark, store, 2)
    assert _run(spark, store, [2]) == plain
    assert st.compact(spark, store, 1) == st.read_base(spark, store).version


def test_reader_from_before_a_swap_still_reads(spark):
    store = _store(spark)
    _run(spark, store, range(1))
    before = st.current_ratings(spark, store)
    want = sorted(tuple(r) for r in before.collect())
    st.compact(spark, store, 0)
    assert sorted(tuple(r) for r in before.collect()) == want


def test_an_unfinished_compaction_is_not_seen(spark):
    store = _store(spark)
    want = _run(spark, store, range(1))
    base = st.read_base(spark, store)
    base.pairs.limit(0).drop("bucket").write.parquet(store.path("base/v=99999999999999999/pairs"))  # died before its manifest row
    assert st.read_base(spark, store).version == base.version
    assert _run(spark, store, []) == want


def test_stream_compacts_by_itself(spark):
    store = _store(spark)
    src = scratch_dir(spark, f"src-{uuid.uuid4().hex}")
    for e in range(2):
        _batch(spark, e).coalesce(1).write.mode("append").parquet(src)
        q = st.run_stream(st.rating_stream(spark, "parquet", src), store, st.sims_reader(store.path("sims")), store.path("ckpt"), available_now=True, compact_every=2)
        q.awaitTermination()
    assert st.read_base(spark, store).upto == 1
    assert _run(spark, store, []) == _run(spark, _store(spark), range(2))


def test_refreshed_similarities_hold_from_the_next_batch(spark):
    store = _store(spark)
    reader = st.sims_reader(store.path("sims"))
    st.process_batch(_batch(spark, 0), 0, store, reader)
    first = _run(spark, store, [])[0]
    assert first
    empty = content_similarity(_items(spark).where("mid < 0"), 0.3)
    st.save_sims(empty, store.path("sims"))
    assert _run(spark, store, [])[0] == first
    st.process_batch(_batch(spark, 1), 1, store, reader)
    assert _run(spark, store, [])[0] == [r for r in first if r[0] == 5_000]


def test_a_million_events_of_one_user_in_one_batch(spark):
    path = scratch_dir(spark, f"busy-{uuid.uuid4().hex}")
    n = 1_000_000
    rows = spark.range(n).select(F.lit(7).alias("uid"), (F.col("id") % 999).cast("int").alias("mid"), F.lit(4.0).alias("score"),
                                 (F.col("id") / 3).cast("int").alias("timestamp"), F.col("id").alias("seq"))
    rows.orderBy(F.xxhash64("seq")).write.parquet(path)
    schema = "uid int, mid int, score double, timestamp int, seq long"
    got = []
    q = (st.recent_state(spark.readStream.schema(schema).parquet(path), 20).writeStream.outputMode("update")
         .foreachBatch(lambda df, e: got.extend(df.collect())).option("checkpointLocation", path + "-ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert [(r.uid, r.recent) for r in got] == [(7, [f"{i % 999}:4.0" for i in range(n - 1, n - 21, -1)])]
