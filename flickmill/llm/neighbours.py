"""Approximate nearest neighbours by cosine: a forest of random-projection trees
searched through one shared priority queue, then exact reranking.

The trees are fitted on a bounded sample (``SAMPLE`` vectors, the only thing that
reaches the driver) and then index every vector. A query pops the node with the
best margin over all trees, follows both sides of its plane and stops after
``probes`` leaves. How many are enough is measured on each table: ``ASKED`` of its
queries are compared with every entry, and the least number of leaves, from
``LEAST`` on, that finds the share ``recall`` of their nearest is taken. Equal vectors are one entry, so
copies never fill a leaf, and a leaf with many entries is searched in blocks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flickmill.llm.scratch import written

#: Vectors that the trees are fitted on; entries of a leaf that are compared in one task; queries that the number of leaves is
#: measured on; leaves that a query visits at least, unless told otherwise.
SAMPLE, BLOCK, ASKED, LEAST = 20_000, 4_096, 512, 160


class Tree:
    """Planes through midpoints of two sampled vectors; children below zero are leaves (leaf k as -k - 1)."""

    def __init__(self, x: np.ndarray, leaf: int, rnd: np.random.Generator):
        self.planes: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.root = self.grow(x, leaf, rnd, 0)
        self.w = np.array(self.planes).reshape(len(self.planes), x.shape[1])
        self.b = np.array(self.offsets)
        self.child = np.array(self.children, np.int64).reshape(len(self.planes), 2)

    def grow(self, x: np.ndarray, leaf: int, rnd: np.random.Generator, depth: int) -> int:
        if len(x) > leaf and depth < 60:
            i, j = rnd.choice(len(x), 2, replace=False)
            w = x[i] - x[j]
            size = np.linalg.norm(w)
            if size:
                w = w / size
                d = x @ w
                b = float(np.median(d))
                right = d > b
                if right.any():
                    me = len(self.planes)
                    self.planes.append(w)
                    self.offsets.append(b)
                    self.children.append([0, 0])
                    self.children[me] = [self.grow(x[~right], leaf, rnd, depth + 1), self.grow(x[right], leaf, rnd, depth + 1)]
                    return me
        self.leaves += 1
        return -self.leaves

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.full(len(x), self.root, np.int64)
        while (on := np.flatnonzero(at >= 0)).size:
            node = at[on]
            side = (np.einsum("ij,ij->i", x[on], self.w[node]) > self.b[node]).astype(np.int64)
            at[on] = self.child[node, side]
        return -at - 1

    def margins_of(self, q: np.ndarray) -> np.ndarray:
        """For each query and leaf the margin by which ``search_leaves`` orders the leaves."""
        m = q @ self.w.T - self.b
        node, leaf = np.full((len(q), len(self.planes)), -np.inf), np.full((len(q), self.leaves), -np.inf)
        for i, children in enumerate(self.children):  # a node stands before those below it
            for c, side in zip(children, (m[:, i], -m[:, i])):
                at = np.maximum(node[:, i], side)
                if c < 0:
                    leaf[:, -c - 1] = at
                else:
                    node[:, c] = at
        return leaf


def search_leaves(trees: list[Tree], q: np.ndarray, probes: int) -> list[tuple[int, int]]:
    """The (tree, leaf) that a query visits, best margin first; one queue over all trees."""
    heap = [(-np.inf, t, tree.root) for t, tree in enumerate(trees)]
    heapq.heapify(heap)
    margins = [tree.w @ q - tree.b for tree in trees]
    out = []
    while heap and len(out) < probes:
        p, t, node = heapq.heappop(heap)
        if node < 0:
            out.append((t, -node - 1))
            continue
        m = float(margins[t][node])
        low, high = trees[t].child[node]
        heapq.heappush(heap, (max(p, m), t, int(low)))
        heapq.heappush(heap, (max(p, -m), t, int(high)))
    return out


def unit(vectors: pa.Array) -> np.ndarray:
    x = np.array(vectors.to_pylist(), np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


PLACES = T.StructType([T.StructField("entry", T.LongType()), T.StructField("tree", T.IntegerType()), T.StructField("leaf", T.IntegerType())])


def placed(entries: DataFrame, shared, probes: int | None) -> DataFrame:
    """The leaf of each entry in each tree; with ``probes``, the leaves that it visits as a query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(batch.column(1))
            if probes is None:
                row = np.tile(np.arange(len(x)), len(trees))
                tree = np.repeat(np.arange(len(trees)), len(x))
                leaf = np.concatenate([t.leaf_of(x) for t in trees])
            else:
                found = [search_leaves(trees, q, probes) for q in x]
                row = np.repeat(np.arange(len(x)), [len(f) for f in found])
                tree, leaf = np.array([p for f in found for p in f]).T
            for k in range(0, len(row), 20_000):
                s = slice(k, k + 20_000)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[s])), pa.array(tree[s], pa.int32()), pa.array(leaf[s], pa.int32())],
                                                 names=PLACES.names)

    return entries.select("entry", "vec").mapInArrow(run, PLACES)


FOUND = T.StructType([T.StructField("query", T.LongType()), T.StructField("entry", T.LongType()), T.StructField("score", T.DoubleType())])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed in order, so equal vectors get equal scores wherever they are compared."""
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    total = lambda x: np.cumsum(x, 1)[:, -1]
    return total(a * b) / (np.sqrt(total(a * a)) * np.sqrt(total(b * b)))


def best_of(queries: pa.Table, entries: pa.Table, k: int) -> pa.Table:
    """Each query's ``k`` nearest entries and those that tie with the last of them up to rounding."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if queries.num_rows and entries.num_rows:
        eid = entries.column("entry").to_numpy()
        ev = np.array(entries.column("vec").to_pylist(), np.float64)
        eu = unit(entries.column("vec").combine_chunks())
        for at in range(0, queries.num_rows, 256):
            some = queries.slice(at, 256)
            qid, qv = some.column("asker").to_numpy(), np.array(some.column("qvec").to_pylist(), np.float64)
            near = unit(some.column("qvec").combine_chunks()) @ eu.T
            n = min(k, near.shape[1])
            last = np.partition(near, near.shape[1] - n, axis=1)[:, near.shape[1] - n]
            i, j = np.nonzero(near >= last[:, None] - 1e-12)
            out.append((qid[i], eid[j], cosines(qv[i], ev[j])))
    cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.table(dict(zip(FOUND.names, cols)))


def closest(entries: DataFrame, ids: np.ndarray, x: np.ndarray, k: int) -> DataFrame:
    """(query, entry): each query's ``k`` nearest other entries, by comparison with all of them."""
    shared = entries.sparkSession.sparkContext.broadcast((ids, x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = shared.value
        score, entry = np.full((len(x), 0), 0.0), np.zeros((len(x), 0), np.int64)
        for batch in batches:
            if batch.num_rows:
                other = batch.column(0).to_numpy()
                near = np.where(ids[:, None] == other[None, :], -np.inf, x @ unit(batch.column(1)).T)
                score, entry = np.hstack([score, near]), np.hstack([entry, np.broadcast_to(other, near.shape)])
                best = np.argpartition(-score, min(k, score.shape[1]) - 1, axis=1)[:, :k]
                score, entry = np.take_along_axis(score, best, 1), np.take_along_axis(entry, best, 1)
        i, j = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(entry[i, j]), pa.array(score[i, j])], names=FOUND.names)

    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    found = entries.select("entry", "vec").mapInArrow(run, FOUND).withColumn("nth", F.row_number().over(best))
    return found.where(F.col("nth") <= k).select("query", "entry")


def enough_probes(entries: DataFrame, trees: list[Tree], k: int, recall: float, seed: int) -> int:
    """The least number of leaves by which a sample of the queries finds the share ``recall`` of its ``k`` nearest entries."""
    asked = entries.where("asked").select("entry", "vec").orderBy(F.xxhash64("entry", F.lit(seed + 1))).limit(ASKED).toArrow()
    if not asked.num_rows:
        return 1
    ids, x = asked.column("entry").to_numpy(), unit(asked.column("vec").combine_chunks())
    best = written(closest(entries, ids, x, k), "ann_closest")
    true = entries.select("entry", "vec").join(F.broadcast(best), "entry").select("query", "vec").toArrow()
    if not true.num_rows:
        return 1
    number = {q: i for i, q in enumerate(ids.tolist())}
    of = np.array([number[q] for q in true.column("query").to_pylist()])
    leaves = np.stack([t.leaf_of(unit(true.column("vec").combine_chunks())) for t in trees])
    needed = np.zeros(len(of), np.int64)
    for low in range(0, len(x), 64):
        margins = [t.margins_of(x[low:low + 64]) for t in trees]
        order = np.sort(np.concatenate(margins, axis=1), axis=1)
        for r in np.flatnonzero((of >= low) & (of < low + 64)):
            first = min(m[of[r] - low, leaf[r]] for m, leaf in zip(margins, leaves))
            needed[r] = np.searchsorted(order[of[r] - low], first, "right")
    return int(np.sort(needed)[math.ceil(recall * len(needed)) - 1])


def nearest(vectors: DataFrame, queries, k: int = 5, key: str = "vec_id", vector: str = "embedding", trees: int = 12,
            leaf_rows: int = 256, probes: int | None = None, recall: float = 0.99, seed: int = 7) -> DataFrame:
    """The ``k`` nearest found by cosine of each row that the condition ``queries`` selects: query_id, rank (from 1),
    vec_id, score; ties go to the smaller id.

    Candidates are all rows with another id. Null ids, and vectors that are null, empty, zero or hold null or
    non-finite components take no part; nor do vectors of another length than the most frequent one (ties: the
    longer). Repeated rows of one id and vector count once; ids with several vectors are ranked by their nearest.
    Other columns are not read. An empty table gives no rows.

    Without ``probes``, each query visits as many leaves (``LEAST`` or more) as find the share ``recall`` of the true nearest
    of a sample of ``ASKED`` queries (all of them, if there are fewer); the number grows with the table as its data asks for.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vec"), queries.alias("asked"))
    odd = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(~odd & F.exists("vec", lambda v: v != 0))
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = written(rows.where(F.size("vec") == length.n).withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(1), "vec")), "ann_rows")
    # Of equal vectors the k + 1 least ids are all that any answer can hold. A few ids of each partition go first.
    salt = F.pmod(F.xxhash64("id"), F.lit(64))
    ids = lambda c: F.slice(F.array_sort(F.array_distinct(c)), 1, k + 1)
    least = rows.select("h1", "h2", "id", salt.alias("salt"))
    for by in (["h1", "h2", "salt"], ["h1", "h2"]):
        w = Window.partitionBy(*by).orderBy("id")
        least = least.distinct().withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k + 1).drop("nth")
    groups = least.groupBy("h1", "h2").agg(ids(F.collect_list("id")).alias("ids"))
    firsts = rows.groupBy("h1", "h2").agg(F.first("vec").alias("vec"), F.max("asked").alias("asked"), F.min("id").alias("low"))
    entries = written(firsts.join(groups, ["h1", "h2"]).withColumn("entry", F.xxhash64("h1", "h2")), "ann_entries")

    total = entries.count()
    sample = entries.select("entry", "vec").orderBy(F.xxhash64("entry", F.lit(seed))).limit(SAMPLE).toArrow()
    x = unit(sample.column("vec").combine_chunks())
    leaf = max(4, int(leaf_rows * len(x) / total))
    rnd = np.random.default_rng(seed)
    forest = [Tree(x, leaf, rnd) for _ in range(trees)]
    if probes is None:
        probes = max(LEAST, enough_probes(entries, forest, k, recall, seed))
    shared = spark.sparkContext.broadcast(forest)

    index = written(placed(entries, shared, None).select("tree", "leaf", "entry"), "ann_index")
    sizes = index.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    visits = written(placed(entries.where("asked"), shared, probes).select("tree", "leaf", F.col("entry").alias("query")), "ann_visits")
    # a query and an entry may meet in several trees: the first of them compares
    asked = entries.where("asked").select(F.col("entry").alias("query"), F.col("vec").alias("qvec"))
    wanted = visits.join(sizes, ["tree", "leaf"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = wanted.join(asked, "query").select(F.col("tree").alias("t"), F.col("leaf").alias("l"), F.col("block").alias("b"), F.col("query").alias("asker"), "qvec")
    right = index.join(sizes.join(visits.select("tree", "leaf").distinct(), ["tree", "leaf"]), ["tree", "leaf"]).withColumn(
        "block", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int")).join(entries.select("entry", "vec"), "entry").select("tree", "leaf", "block", "entry", "vec")
    near = left.groupBy("t", "l", "b").cogroup(right.groupBy("tree", "leaf", "block")).applyInArrow(
        lambda a, b: best_of(a, b, k + 1), FOUND)
    near = near.groupBy("query", "entry").agg(F.max("score").alias("score"))
    # answers per distinct query vector: k + 1 ids, then each asking row leaves out its own
    ids_of = entries.select("entry", F.explode("ids").alias("vec_id"))
    pairs = near.join(ids_of, "entry").groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    pairs = pairs.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    lists = pairs.groupBy("query").agg(F.collect_list(F.struct("vec_id", "score")).alias("list"))
    keys = entries.select(F.col("entry").alias("query"), "h1", "h2").join(lists, "query")
    out = rows.where("asked").select("h1", "h2", F.col("id").alias("query_id")).distinct().join(keys, ["h1", "h2"]).select(
        "query_id", F.explode("list").alias("a")).where("a.vec_id <> query_id").groupBy("query_id", F.col("a.vec_id").alias("vec_id")).agg(F.max("a.score").alias("score"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
