"""Vectors scanned in files: what a task keeps of them, and products that shuffle none."""

import os
import uuid

import numpy as np
import pyarrow as pa
import pytest

from flickmill.operators import factors as fa
from flickmill.operators import model, similarity
from flickmill.session import scratch_dir

HALF = ["dst", "src", "score", "v", "want"]


def _half_batch(rows):
    kinds = [pa.int32(), pa.int32(), pa.float32(), pa.binary(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=HALF)


def test_a_half_step_keeps_only_the_vectors_that_its_ratings_name():
    """Whether the vectors come after the ratings or before some of them; a block without ratings has no rows."""
    v = lambda *x: np.array(x, np.float32).tobytes()
    rated = [(1, 7, 2.0, None, 2), (1, 9, 3.0, None, 2)]
    vectors = [(None, i, None, v(i, 1.0), 2) for i in range(20)]
    out = [list(fa._half_step_fn(2, 0.1)(iter(map(_half_batch, order)))) for order in ([rated, vectors], [vectors[:3] + rated[:1], vectors[3:9], rated[1:] + vectors[9:]])]
    assert [b.num_rows for b in out[0]] == [1] and out[0][0].equals(out[1][0])
    assert not list(fa._half_step_fn(2, 0.1)(iter([_half_batch([(None, 1, None, v(1, 1), 0)])])))
    with pytest.raises(ValueError):
        list(fa._half_step_fn(2, 0.1)(iter([_half_batch(rated), _half_batch(vectors[:8])])))
    x, there = fa.wanted(np.array([2, 30]), 2, iter([(np.arange(20), np.ones((20, 2), np.float32))]))
    assert x.shape == (2, 2) and there.tolist() == [True, False]


def test_blocks_hold_a_bounded_number_of_vectors(spark):
    width = spark.sparkContext.defaultParallelism
    assert fa.block_count(spark, 10, 500_000) == width and fa.block_count(spark, 36_000_000, 500_000) == 64
    assert fa.block_count(spark, 216_000_000, 500_000) * fa.KEPT >= 216_000_000 * 200
    assert fa.block_count(spark, 36_000_000, 500_000, 300) * fa.KEPT >= 36_000_000 * 300


def test_best_items_are_found_batch_by_batch(spark):
    """Items of ever larger products, in many batches, with ties over the batches."""
    x = np.abs(np.random.default_rng(6).normal(size=(33, 3))).astype("f4")
    y = np.repeat(np.linspace(0.1, 4, 40), 2)[:, None].astype("f4") * np.ones(3, "f4")
    users, items = (spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(t)], "id int, features array<float>").coalesce(2) for t in (x, y))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = fa.best_items(users, items, 3, 5).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    s = np.cumsum(x[:, None] * y[None], axis=2)[..., -1]
    want = [(u, k + 1, int(m)) for u in range(33) for k, m in enumerate(np.lexsort((np.arange(80), -s[u]))[:5])]
    assert sorted((r.uid, r.rank, r.mid) for r in got) == want


def test_vectors_are_stored_once_in_as_few_bytes_as_they_need(spark):
    rng = np.random.default_rng(8)
    short, long = rng.normal(size=(200, 64)).astype("f4").astype(float), rng.normal(size=(200, 64))
    size = []
    for name, x in (("short", short), ("long", long)):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(500, None)], "id long, features array<double>")
        path = scratch_dir(spark, f"vector-files-{name}-{uuid.uuid4().hex}")
        files = fa.VectorFiles(df, path, lambda n: 5)
        got = [r for names, n in files.blocks for r in files.of(names).collect() if r.wide == (name == "long")]
        assert len(files.blocks) == 5 and sorted(r.id for r in got) == list(range(200)) and sum(n for _, n in files.blocks) == 200
        assert all(np.array_equal(np.frombuffer(r.v, "f8" if r.wide else "f4"), x[r.id]) for r in got)
        at = path.removeprefix("file://")
        size.append(sum(os.path.getsize(os.path.join(at, f)) for f in os.listdir(at)))
    assert size[0] < 0.75 * size[1]


def test_a_grid_shuffles_no_vector(spark):
    users = spark.createDataFrame([(u, [float(u), 0.1]) for u in range(9)] + [(99, None)], "uid int, features array<double>")
    items = spark.createDataFrame([(f"m{m}", [1.0, float(m)]) for m in range(6)], "mid string, features array<double>")
    got = model.user_item_grid(users, items, 2)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.uid, r.mid): r.pred for r in got.collect()} == pytest.approx({(u, f"m{m}"): u + 0.1 * m for u in range(9) for m in range(6)})


@pytest.mark.parametrize("size", [3, 8, 1024])
def test_each_pair_of_vectors_meets_once(spark, size):
    """In odd and even numbers of blocks; ids that come twice, vectors in one direction, vectors that need eight bytes."""
    rng = np.random.default_rng(size)
    x = rng.normal(size=(25, 3))
    x[4], x[7] = 2 * x[3], -x[3]
    ids = [i % 23 for i in range(25)]
    v = spark.createDataFrame([(i, r.tolist()) for i, r in zip(ids, x)], "mid int, features array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 9)
    for cut in (-0.5, 0.9):
        got = sorted((r.m1, r.m2, round(r.sim, 6)) for r in similarity.item_similarity_latent(v, cut, block_size=size).collect())
        assert got == sorted((ids[i], ids[j], round(s[i, j], 6)) for i in range(25) for j in range(25) if ids[i] != ids[j] and s[i, j] > cut)
