"""N-gram Jaccard self-join by chosen paths.

A document is its set of word n-grams. In each run a set is sent down a tree: at
a node it follows the n-grams whose hash for that node is under
``SPREAD / (threshold * size)``, so two sets at the threshold share ``SPREAD``
chosen n-grams on average, and large nodes are split again by further n-grams.
Nodes with few sets are compared by brute force with exact set sizes, and so, in
blocks, are those that a split leaves more than half together; all others are
split until they have few. Only sets at a node that is split are sent further, so
a level below the first costs nothing where no node is large. Runs are repeated
until a pair at the threshold is missed with a probability under ``1 - recall``,
however deep the tree gets.

Equal sets are one class and join once. A pair is counted at the first node that
its sets share, so nodes report numbers of links and a spanning forest, never
their pairs.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flickmill.llm.batches import NOT_SPACE, Words, mix, pieces, window_hashes
from flickmill.llm.components import components
from flickmill.llm.scratch import written
from flickmill.llm.sieve import sieved

#: n-grams that two sets at the threshold share at a node, on average; sets of a node that is not split, and of a block.
SPREAD, FEW, BLOCK = 2.0, 256, 1024
#: Bytes of text whose sets are made at once.
PIECE = 500_000


def runs_for(recall: float) -> int:
    """Runs by which a pair at the threshold meets, at any depth, with this probability."""
    p = 1.0
    for _ in range(200):  # the probability of meeting at each depth falls to a limit
        p = 1 - math.exp(-SPREAD * p)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def shingle_sets(col: pa.Array, n: int) -> list[np.ndarray]:
    """Each text's set of hashed word n-grams, sorted; a text of fewer words has one n-gram of all of them, if any."""
    w = Words(col, NOT_SPACE)
    h, out = window_hashes(w.hash, n), []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        out.append(np.unique(h[a:b - n + 1]) if b - a >= n else window_hashes(w.hash[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    if not len(s):
        return 0, 0
    a, b = mix(s ^ np.uint64(0x5851F42D4C957F2D)), mix(s ^ np.uint64(0x14057B7EF767814F))
    return tuple(int(np.add.reduce(x).view(np.int64)) for x in (a, b))


def roots(runs: int) -> np.ndarray:
    """The node that each run begins at."""
    return mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def below(s: np.ndarray, above: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The nodes that a set goes to from these ones, and the node above each."""
    limit = np.uint64(min(1.0, SPREAD / (threshold * max(1, len(s)))) * (2**64 - 2048))
    drawn = mix(s[None, :] ^ above[:, None])
    at, gram = np.nonzero(drawn <= limit)
    return mix(drawn[at, gram] + above[at]).view(np.int64), above[at].view(np.int64)


SETS = T.StructType([T.StructField("doc", T.LongType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
                     T.StructField("size", T.IntegerType()), T.StructField("nodes", T.ArrayType(T.LongType()))])
WAYS = T.StructType([T.StructField("rep", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("node", T.LongType()), T.StructField("above", T.LongType())])


def read_sets(docs: DataFrame, n: int, threshold: float, runs: int) -> DataFrame:
    """(doc, k1, k2, size, nodes): each text's set by its name, and the nodes of the first level that it goes to."""
    def run(batches):
        top = roots(runs)
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                sets = shingle_sets(piece.column(1), n)
                keys = [set_key(s) for s in sets]
                ways = [below(s, top, threshold)[0] for s in sets]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                                                  pa.array([len(s) for s in sets], pa.int32()), pa.array(ways, pa.list_(pa.int64()))], names=SETS.names)

    return docs.mapInArrow(run, SETS)


def next_level(docs: DataFrame, inside: DataFrame, n: int, threshold: float) -> DataFrame:
    """(rep, size, node, above): where the classes at these nodes (rep, node) go from there."""
    lists = inside.groupBy("rep").agg(F.collect_list("node").alias("above"))  # a class's own nodes of one level

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                reps, above = piece.column(0).to_pylist(), piece.column(2).to_pylist()
                for rep, s, nodes_above in zip(reps, shingle_sets(piece.column(1), n), above):
                    node, of = below(s, np.array(nodes_above, np.int64).view(np.uint64), threshold)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), rep, np.int64)), pa.array(np.full(len(node), len(s), np.int32)), pa.array(node), pa.array(of)], names=WAYS.names)

    own = sieved(docs, "doc_id", inside.select("rep"))
    texts = own.join(lists, own["doc_id"] == lists["rep"]).select("rep", "text", "above")
    return texts.mapInArrow(run, WAYS).dropDuplicates(["rep", "node"])  # a document row can stand more than once


def nodes(docs: DataFrame, reps: DataFrame, n: int, threshold: float) -> DataFrame:
    """(node, rep, blocks): the nodes at which a class is compared; of nodes with the same classes, one."""
    chosen: list[DataFrame] = []
    at = reps.select("rep", "size", F.explode("nodes").alias("node")).withColumn("above", F.lit(None).cast("long"))
    parents: DataFrame | None = None  # those that are split, and who is at them
    inside: DataFrame | None = None
    while True:
        number = F.xxhash64("rep").cast("decimal(38,0)")
        sizes = written(at.groupBy("node", "above").agg(F.count("*").alias("n"), F.sum(number).alias("who"), F.sum(F.xxhash64(F.lit(1), "rep").cast("decimal(38,0)")).alias("who_else"))
                        .where("n > 1"), "jaccard_nodes")
        if parents is not None:  # a node that stays mostly together is not split
            largest = sizes.groupBy("above").agg(F.max("n").alias("most"))
            judged = parents.join(largest.withColumnRenamed("above", "node"), "node", "left")
            dense = judged.where(F.col("most") * 2 >= F.col("n"))
            chosen.append(members(inside, dense, threshold))
            sizes = sizes.join(dense.select(F.col("node").alias("above")), "above", "left_anti")
        chosen.append(members(at, sizes.where(F.col("n") <= FEW), threshold))
        parents = written(sizes.where(F.col("n") > FEW).select("node", "n", "who", "who_else"), "jaccard_splits")
        if parents.isEmpty():
            break
        # every node is less than half of the one above it, so this ends
        inside = written(at.join(parents.select("node"), "node", "left_semi").select("rep", "size", "node"), "jaccard_inside")
        at = written(next_level(docs, inside, n, threshold), "jaccard_ways")
    out = chosen[0]
    for more in chosen[1:]:
        out = out.unionByName(more)
    return out


def members(at: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """(node, rep, blocks) of these nodes, of nodes with the same classes, one. Where there are few, a class that no other
    there is near enough to in size to be linked with is left out."""
    one = sizes.groupBy("n", "who", "who_else").agg(F.min("node").alias("node")).select(
        "node", F.when(F.col("n") <= FEW, 1).otherwise(F.ceil(F.col("n") / BLOCK)).cast("int").alias("blocks"))
    here = at.select("rep", "size", "node").join(one, "node")
    ratio, by_size = Fraction(str(threshold)), Window.partitionBy("node").orderBy("size", "rep")

    def near(less: F.Column, more: F.Column) -> F.Column:
        return F.coalesce(less * ratio.denominator >= more * ratio.numerator, F.lit(False))

    size = F.col("size").cast("long")
    few = here.where("blocks = 1").withColumn("less", F.lag(size).over(by_size)).withColumn("more", F.lead(size).over(by_size))
    few = few.where(near(F.col("less"), size) | near(size, F.col("more")))
    return few.select("node", "rep", "blocks").unionByName(here.where("blocks > 1").select("node", "rep", "blocks"))


LINKS = T.StructType([T.StructField("rep", T.LongType()), T.StructField("links", T.LongType()), T.StructField("root", T.LongType())])


def compare(rep: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], others: list[np.ndarray], own: int,
            side: np.ndarray | None, ratio: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """For each class at a node (or at two blocks of it): the documents it is linked with whose first shared node is
    this one, and the least class of its part of the link graph. With sides, only pairs between two of them count."""
    m, sizes = len(rep), np.array([len(s) for s in sets], np.int64)
    gram, of = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    values, number, times = np.unique(gram, return_inverse=True, return_counts=True)
    common = times > 1
    rank = np.cumsum(common) - 1
    of, number = of[common[number]], rank[number[common[number]]]
    shared = overlaps(m, of, number)
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared * ratio.denominator >= union * ratio.numerator
    np.fill_diagonal(linked, False)
    if side is not None:
        linked &= side[:, None] != side[None, :]
    before = [np.unique(o[o < own]) for o in others]
    ids, at = np.unique(np.concatenate(before), return_inverse=True)
    earlier = overlaps(m, np.repeat(np.arange(m), [len(b) for b in before]), at) > 0
    links = ((linked & ~earlier) * copies[None, :]).sum(1)
    root = rep.copy()
    while True:
        least = np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1)
        new = np.minimum(root, least)
        if (new == root).all():
            return links, root
        root = new


def overlaps(m: int, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """How many columns each two rows share, from the (row, column) that are set; some columns at a time."""
    out = np.zeros((m, m))
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    width = int(col[-1]) + 1 if len(col) else 0
    step = max(1, min(width, max(256, 4_000_000 // max(m, 1))))
    for first in range(0, width, step):
        a, b = np.searchsorted(col, [first, first + step])
        part = np.zeros((m, step), np.float32)
        part[row[a:b], col[a:b] - first] = 1
        out += part @ part.T
    return out.astype(np.int64)


def linked_classes(docs: DataFrame, reps: DataFrame, n: int, threshold: float) -> DataFrame:
    """(rep, links, root) of each node that a class is compared at."""
    ratio = Fraction(str(threshold))
    meet = written(nodes(docs, reps, n, threshold), "jaccard_meetings")
    lists = meet.groupBy("rep").agg(F.collect_list(F.struct("node", "blocks")).alias("at"))
    lists = lists.join(reps.select("rep", "copies"), "rep")
    own = sieved(docs, "doc_id", meet.select("rep"))
    texts = own.join(lists, own["doc_id"] == lists["rep"]).select("rep", "text", "copies", "at")
    # texts are what is sent to the nodes: they are smaller than their sets of hashes
    here = texts.withColumn("own", F.explode("at")).select("rep", "copies", "text", F.transform("at", lambda x: x["node"]).alias("others"),
                                                          F.col("own.node").alias("node"), F.col("own.blocks").alias("blocks"))
    block = F.pmod(F.xxhash64("rep", "node"), F.col("blocks")).cast("int")
    # every two blocks meet once: a row goes to (its block, each later one) and (each earlier one, its block)
    here = here.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    here = here.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))

    def brute(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rep")
        rep, first = np.unique(rows.column("rep").to_numpy(), return_index=True)
        rows = rows.take(first)
        side = rows.column("block").to_numpy() if key[1].as_py() != key[2].as_py() else None
        grams = [s for batch in rows.to_batches() for piece in pieces(batch, "text", PIECE) for s in shingle_sets(piece.column("text"), n)]
        others = [np.array(o, np.int64) for o in rows.column("others").to_pylist()]
        links, root = compare(rep, rows.column("copies").to_numpy(), grams, others, key[0].as_py(), side, ratio)
        return pa.table({"rep": rep, "links": links, "root": root})

    return here.select("rep", "copies", "text", "others", "node", "block", "one", "two").groupBy("node", "one", "two").applyInArrow(brute, LINKS)


def near_duplicates(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """One row per document row: doc_id, class_id, copy_id, n_copies, n_links.

    Words are runs of other than ASCII white space. copy_id is the least doc_id with the same set of n-grams, n_copies
    how many documents have that set, n_links how many other documents have a Jaccard similarity of ``threshold`` or
    more (n_copies - 1 of them equal), class_id the least doc_id of all that are linked directly or through others.
    Null and empty texts have no n-grams and are linked with nothing: class_id and copy_id are their own doc_id. Rows
    with a null doc_id keep null ids and no links. Each row counts as a document; a doc_id names one text. Other
    columns are not read.
    """
    known = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    read = written(read_sets(known, n, threshold, runs_for(recall)), "jaccard_sets")
    some = read.where("size > 0")
    reps = written(some.groupBy("k1", "k2").agg(F.min("doc").alias("rep"), F.count("*").alias("copies"),
                                                F.first("nodes").alias("nodes"), F.first("size").alias("size")), "jaccard_classes")
    met = written(linked_classes(known, reps, n, threshold), "jaccard_links")
    parts = components(met.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = reps.select("k1", "k2", "rep", "copies").join(parts, reps["rep"] == parts["node"], "left").drop("node").join(links, "rep", "left")
    out = some.select("doc", "k1", "k2").join(classes, ["k1", "k2"]).select(
        F.col("doc").alias("doc_id"), F.coalesce("component", "rep").alias("class_id"), F.col("rep").alias("copy_id"),
        F.col("copies").alias("n_copies"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    empty = read.where("size = 0").select(F.col("doc").alias("doc_id"), F.col("doc").alias("class_id"), F.col("doc").alias("copy_id"),
                                          F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))
    nameless = docs.where("doc_id is null").select(*[F.lit(None).cast("long").alias(c) for c in ("doc_id", "class_id", "copy_id")],
                                                   F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(empty).unionByName(nameless)


def first_of_each(docs: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents, with their columns as they are, but one of each class of near-duplicates: that with the least doc_id.

    Of rows that repeat one doc_id and text, null texts included, one stays. Rows with a null doc_id all stay.
    """
    gone = near_duplicates(docs, n, threshold).where("class_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    # only rows of ids that stand more than once are dealt out again
    often = written(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "jaccard_repeated")
    return kept.join(often, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(
        kept.join(often, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*[F.col(f"`{c}`") for c in docs.columns]))
