"""Item-to-item similarity: TF-IDF content vectors and dense latent vectors.

Sparse all-pairs cosine (M10) is exact and avoids the full cartesian product:

1. items with the same (term, tf) multiset share a vector: they are grouped
   into *signatures* first and compared once (a pair of items inside one
   signature has cosine 1);
2. prefix filtering: terms are put in one global order, rarest first; every
   signature keeps as its *prefix* the leading terms up to the point where the
   rest of its unit vector has a norm below the cut. Two vectors whose cosine
   passes the cut always share a prefix term, so candidate pairs come from a
   join of prefix postings only, and frequent terms rarely take part in it;
3. the exact cosine of each candidate is summed over all shared terms, rounded
   to ``SIM_DIGITS`` places and cut (strictly).

The result is factored: ``members`` (mid, sig) and ``pairs`` (s1, s2, sim) in
both directions including (s, s). ``edges()`` expands it to movie pairs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flickmill.functions.scalar import SIM_DIGITS, bars_to_blanks, round_sim, tokenize
from flickmill.operators.factors import VectorFiles, beside, held_vectors, restored
from flickmill.session import scratch_dir


#: Ids per slice when the members of a signature are numbered.
ID_SLICE = 65536


@dataclass
class FactoredSims:
    """Similarity between items, grouped by identical vectors."""

    members: DataFrame  # (mid int, sig int[, pos long])
    pairs: DataFrame    # (s1 int, s2 int, sim double[, cum_before long]), both directions, incl. (s, s)

    def placed(self) -> "FactoredSims":
        """With each member's place by id in its signature (``pos``, from 1) and, per
        pair, the number of members in signatures nearer to s1 (``cum_before``).

        Places are counted per slice of ids and added up, so no task orders all
        members of a large signature."""
        if "pos" in self.members.columns:
            return self
        cut = self.members.withColumn("slice", F.floor(F.col("mid") / F.lit(ID_SLICE)))
        sizes = cut.groupBy("sig", "slice").agg(F.count(F.lit(1)).alias("size"))
        before = Window.partitionBy("sig").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select("sig", "slice", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
        inside = Window.partitionBy("sig", "slice").orderBy("mid")
        members = (cut.withColumn("row", F.row_number().over(inside)).join(starts, ["sig", "slice"])
                   .select("mid", "sig", (F.col("start") + F.col("row")).alias("pos")))
        totals = sizes.groupBy(F.col("sig").alias("s2")).agg(F.sum("size").alias("total"))
        down = Window.partitionBy("s1").orderBy(F.col("sim").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        tied = Window.partitionBy("s1", "sim")
        pairs = (self.pairs.join(totals, "s2")
                 .select("s1", "s2", "sim", (F.sum("total").over(down) - F.sum("total").over(tied)).alias("cum_before")))
        return FactoredSims(members, pairs)

    def edges(self) -> DataFrame:
        """Movie-level ordered pairs (m1, m2, sim), self pairs removed."""
        a = self.members.select(F.col("mid").alias("m1"), F.col("sig").alias("s1"))
        b = self.members.select(F.col("mid").alias("m2"), F.col("sig").alias("s2"))
        return (self.pairs.join(a, "s1").join(b, "s2")
                .where(F.col("m1") != F.col("m2"))
                .select("m1", "m2", "sim"))

    @staticmethod
    def from_edges(edges: DataFrame) -> "FactoredSims":
        """A plain (m1, m2, sim) table seen as one signature per movie."""
        ids = (edges.select(F.col("m1").alias("mid")).union(edges.select(F.col("m2").alias("mid")))
               .distinct())
        members = ids.select("mid", F.col("mid").alias("sig"))
        pairs = edges.select(F.col("m1").alias("s1"), F.col("m2").alias("s2"), "sim")
        return FactoredSims(members, pairs)


# ----------------------------------------------------------------- TF / IDF --

def content_tokens(items: DataFrame, text_col: str = "genres", bars: bool = True) -> DataFrame:
    """P2 + F4: (mid, name, genres with bars as blanks) -> tokens array."""
    text = bars_to_blanks(F.col(text_col)) if bars else F.col(text_col)
    return items.select("mid", tokenize(text).alias("tokens"))


def _hashed_vectors(tok: DataFrame, buckets: int) -> DataFrame:
    """(mid, tfv): HashingTF's term-count vector as a dense array of ``buckets``."""
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array
    v = HashingTF(inputCol="tokens", outputCol="_v", numFeatures=buckets).transform(tok)
    return v.select("mid", vector_to_array("_v").alias("tfv"))


def _explode_dense(df: DataFrame, col: str, keys) -> DataFrame:
    return (df.select(*keys, F.posexplode(col).alias("pos", "tf"))
            .where(F.col("tf") != 0)
            .select(*keys, F.col("pos").cast("string").alias("term"), "tf"))


def term_frequency(items: DataFrame, text_col: str = "genres", hashed: int | None = None,
                   bars: bool = True) -> DataFrame:
    """M7: (mid, term, tf). ``hashed=50`` is Spark's HashingTF with 50 buckets
    (the term is the bucket number); default is the exact term."""
    tok = content_tokens(items, text_col, bars)
    if hashed:
        return _explode_dense(_hashed_vectors(tok, hashed), "tfv", ["mid"])
    return (tok.select("mid", F.explode("tokens").alias("term"))
            .groupBy("mid", "term").agg(F.count(F.lit(1)).cast("double").alias("tf")))


def idf_fit(tf: DataFrame, n_docs) -> DataFrame:
    """(term, df, idf) with idf = ln((N + 1) / (df + 1))."""
    return (tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            .withColumn("idf", F.log((F.lit(n_docs) + 1) / (F.col("df") + 1))))


def tfidf(items: DataFrame, text_col: str = "genres", hashed: int | None = None) -> DataFrame:
    """M8: (mid, term, w = tf * idf)."""
    tf = term_frequency(items, text_col, hashed)
    n = items.select(F.count(F.lit(1))).scalar()
    return tf.join(idf_fit(tf, n), "term").select("mid", "term", (F.col("tf") * F.col("idf")).alias("w"))


# ------------------------------------------------------ sparse all-pairs ----

def sparse_signatures(items: DataFrame, text_col: str = "genres", bars: bool = True,
                      hashed: int | None = None):
    """Group items by their token multiset (= their sorted token list).

    The signature id is the smallest ``mid`` carrying it: an int, deterministic
    under recomputation. The grouping is an aggregate (partial on the map side)
    joined back to the items, so a signature shared by a third of all items is
    never gathered in one task. Term counts are taken once per signature.

    Returns (members (mid, sig), sig_tf (sig, term, tf, n_items), n_docs column)."""
    tok = content_tokens(items, text_col, bars)
    if hashed:
        # the dense bucket-count vector, joined with commas, is a lossless key
        keyed = _hashed_vectors(tok, hashed).select(
            "mid", F.array_join(F.transform("tfv", lambda x: x.cast("string")), ",").alias("key"),
            F.lit(1).alias("n_tok"))
    else:
        # tokens never contain white space, so joining the sorted list with one
        # blank is a lossless key (given the token count)
        keyed = tok.select("mid", F.array_join(F.array_sort("tokens"), " ").alias("key"),
                           F.size("tokens").alias("n_tok"))
    groups = keyed.groupBy("key", "n_tok").agg(F.min("mid").alias("sig"),
                                               F.count(F.lit(1)).alias("n_items"))
    members = keyed.join(groups, ["key", "n_tok"]).select("mid", "sig")
    reps = groups.where(F.col("n_tok") > 0)
    if hashed:
        sig_tf = _explode_dense(reps.select("sig", "n_items", F.split("key", ",").cast("array<double>")
                                            .alias("tfv")), "tfv", ["sig", "n_items"])
    else:
        sig_tf = (reps.select("sig", "n_items", F.explode(F.split("key", " ", -1)).alias("term"))
                  .groupBy("sig", "n_items", "term")
                  .agg(F.count(F.lit(1)).cast("double").alias("tf")))
    n_docs = items.select(F.count(F.lit(1))).scalar()
    return members, sig_tf, n_docs


#: Postings of one prefix term that a block holds, about.
PREFIX_BLOCK = 512


def sparse_weights(sig_tf: DataFrame, n_docs) -> DataFrame:
    """(sig, term, w, df) with IDF over items (df weighted by item count)."""
    df = (sig_tf.groupBy("term").agg(F.sum("n_items").alias("df"))
          .withColumn("idf", F.log((F.lit(n_docs) + 1) / (F.col("df") + 1))))
    return (sig_tf.join(df, "term")
            .select("sig", "term", "df", (F.col("tf") * F.col("idf")).alias("w"))
            .where(F.col("w") != 0))


def sparse_all_pairs(weights: DataFrame, theta: float, key: str = "sig") -> DataFrame:
    """Exact cosine > theta (after rounding) between all vectors of ``weights``
    (key, term, w, df). Returns (s1, s2, sim) both directions, including (s, s).

    Prefix bound of a vector x at term position i (terms rarest first): the
    rest of x can add at most min(||x[i:]||, sum_f x_f * maxweight_f) to a dot
    product with any unit vector (Cauchy-Schwarz, resp. the largest unit weight
    term f has anywhere). Terms whose bound reaches the cut form the prefix."""
    # Rounding to SIM_DIGITS happens before the cut, so vectors whose raw cosine
    # is a hair below theta can still pass: prune with a slightly lower bound.
    bound = theta - 10.0 ** (-SIM_DIGITS)
    by_key = Window.partitionBy(key)
    rarest_last = (Window.partitionBy(key).orderBy(F.col("df").desc(), F.col("term").desc())
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    v = (weights.withColumn("norm", F.sqrt(F.sum(F.col("w") * F.col("w")).over(by_key)))
         .withColumn("u", F.col("w") / F.col("norm")))
    maxw = v.groupBy("term").agg(F.max("u").alias("maxw"))
    v = (v.join(maxw, "term")
         .withColumn("suf_sq", F.sum(F.col("u") * F.col("u")).over(rarest_last))
         .withColumn("suf_mw", F.sum(F.col("u") * F.col("maxw")).over(rarest_last))
         .withColumn("in_prefix", F.least(F.sqrt("suf_sq"), F.col("suf_mw")) >= F.lit(bound))
         .select(key, "term", "df", "w", "norm", "in_prefix"))
    # a prefix posting carries the prefix up to it, rarest terms first
    so_far = Window.partitionBy(key).orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    postings = v.where("in_prefix").select(F.col(key).alias("id"), "term", F.collect_list("term").over(so_far).alias("before"))
    # a long posting list meets itself in pairs of blocks, so no task compares more than two blocks of it
    own = postings.join(prefix_blocks(postings), "term", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = own.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    left = own.select("term", F.col("id").alias("id1"), F.col("before").alias("before1"), F.col("part").alias("x"), F.explode(F.sequence("part", F.col("parts") - 1)).alias("y"))
    right = own.select("term", F.col("id").alias("id2"), F.col("before").alias("before2"), F.explode(F.sequence(F.lit(0), "part")).alias("x"), F.col("part").alias("y"))
    pairs = left.join(right, ["term", "x", "y"]).where((F.col("x") < F.col("y")) | (F.col("id1") < F.col("id2")))
    # taken at the first prefix term that both have, so a pair comes once
    cand = pairs.where(~F.arrays_overlap("before1", "before2")).select(F.least("id1", "id2").alias("s1"), F.greatest("id1", "id2").alias("s2"))
    full1 = v.select(F.col(key).alias("s1"), "term", F.col("w").alias("w1"), F.col("norm").alias("n1"))
    full2 = v.select(F.col(key).alias("s2"), "term", F.col("w").alias("w2"), F.col("norm").alias("n2"))
    dots = (cand.join(full1, "s1").join(full2, ["s2", "term"])
            .groupBy("s1", "s2")
            .agg(F.sum(F.col("w1") * F.col("w2")).alias("d"), F.first("n1").alias("n1"),
                 F.first("n2").alias("n2")))
    # both directions and the self pair of every signature in one pass
    sims = (dots.select("s1", "s2", round_sim(F.try_divide(F.col("d"), F.col("n1") * F.col("n2")))
                        .alias("sim"))
            .where(F.col("sim") > F.lit(theta))
            .select(F.explode(F.array(F.struct("s1", "s2", "sim"),
                                      F.struct(F.col("s2").alias("s1"), F.col("s1").alias("s2"),
                                               "sim"))).alias("p"))
            .select("p.*"))
    self_pairs = (v.groupBy(key).agg(F.sum(F.col("w") * F.col("w")).alias("d"), F.first("norm").alias("n"))
                  .select(F.col(key).alias("s1"), F.col(key).alias("s2"),
                          round_sim(F.try_divide(F.col("d"), F.col("n") * F.col("n"))).alias("sim"))
                  .where(F.col("sim") > F.lit(theta)))
    return sims.unionByName(self_pairs)


def prefix_blocks(prefix: DataFrame) -> DataFrame:
    """(term, parts) of the terms that stand in more than PREFIX_BLOCK prefixes."""
    return (prefix.groupBy("term").agg(F.ceil(F.count(F.lit(1)) / F.lit(PREFIX_BLOCK)).cast("int").alias("parts"))
            .where("parts > 1"))


def content_similarity(items: DataFrame, theta: float = 0.6, text_col: str = "genres",
                       hashed: int | None = None) -> FactoredSims:
    """M10 in factored form (members + signature pairs)."""
    members, sig_tf, n_docs = sparse_signatures(items, text_col, hashed=hashed)
    w = sparse_weights(sig_tf, n_docs)
    return FactoredSims(members, sparse_all_pairs(w, theta))


def item_similarity_content(items: DataFrame, theta: float = 0.6, text_col: str = "genres",
                            hashed: int | None = None) -> DataFrame:
    """(m1, m2, sim) for every ordered pair of distinct movies with
    TF-IDF cosine > theta."""
    return content_similarity(items, theta, text_col, hashed).edges()


# ------------------------------------------------------- dense all-pairs ----

#: Blocks that vectors are dealt to at most, unless one then holds more than LARGEST_BLOCK; products made at once, about.
MOST_BLOCKS, LARGEST_BLOCK, TILE = 32, 65_536, 2_000_000
#: So many blocks have as many pairs as there are tasks, unless one then holds more than LARGEST_BLOCK; vectors compared with a
#: block at once; pairs of which one may be over the cut for rough products to be worth it.
MOST_SCANS, BATCH, FEW = 12, 4096, 100


def block_count(n: int, block_size: int) -> int:
    """Blocks of about ``block_size`` vectors, or larger ones. A vector is sent to each block that its own one meets, so with
    a bounded number of blocks the shuffle grows with the vectors, not with their square."""
    return max(1, min(-(-n // block_size), MOST_BLOCKS), -(-n // LARGEST_BLOCK))


def best_of(row: np.ndarray, sim: np.ndarray, other: np.ndarray, n: int | None) -> np.ndarray:
    """Places of each row's n best by similarity (ties: the other id); all without ``n``."""
    if n is None:
        return np.arange(len(row))
    order = np.lexsort((other, -sim, row))
    first = np.concatenate([[True], np.diff(row[order]) != 0]) if len(row) else np.zeros(0, bool)
    at = np.arange(len(row))
    return order[at - np.maximum.accumulate(np.where(first, at, 0)) < n]


def _similar_fn(theta: float, digits: int, n: int | None = None):
    slack = 10.0 ** -digits  # what rounding can add

    def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        norm = np.sqrt((x * x).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            return norm, (x / norm[:, None]).astype(np.float32)

    def batch(m1: np.ndarray, m2: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(m1, pa.int32()), pa.array(m2, pa.int32()), pa.array(sim, pa.float64())], names=["m1", "m2", "sim"])

    def cosines(a: np.ndarray, na: np.ndarray, ua: np.ndarray, b: np.ndarray, nb: np.ndarray, ub: np.ndarray, rough: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
        """Places (i, j) and cosine of the pairs over the cut. With ``rough``, products of unit vectors in four bytes come first,
        to leave few pairs that are made exactly; also returned is whether they were few."""
        with np.errstate(divide="ignore", invalid="ignore"):
            if rough:
                err = (a.shape[1] + 8) * 2.0 ** -22  # more than four-byte sums of unit vectors can err
                i, j = np.nonzero(ua @ ub.T > theta - slack - err)
                rough = len(i) * FEW <= len(a) * len(b)
                s, step = np.empty(len(i) if rough else 0), max(1, TILE // a.shape[1])
                for k in range(0, len(s), step):
                    s[k:k + step] = np.einsum("ij,ij->i", a[i[k:k + step]], b[j[k:k + step]])
                s = s / (na[i] * nb[j]) if rough else s
            if not rough:
                s = (a @ b.T) / np.outer(na, nb)
                i, j = np.nonzero(s > theta - slack)
                s = s[i, j]
            sim = np.round(s, digits)
        ok = np.isfinite(sim) & (sim > theta)
        return i[ok], j[ok], sim[ok], rough

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, a, others = held_vectors(batches)
        if held is None:
            return
        ida, (na, ua) = held.to_numpy(), unit(a)
        rough = True  # while it leaves few pairs
        best = (np.zeros(0, int), ida[:0], np.zeros(0))  # of each vector of the block, the best so far
        inner = ((ida[k:k + BATCH], a[k:k + BATCH], True) for k in range(0, len(a), BATCH))
        for idb, b, same in chain(inner, ((r.column("b").to_numpy(), restored(r), False) for r in others)):
            nb, ub = unit(b)
            step, found = max(1, TILE // len(b)), []
            for at in range(0, len(a), step):
                i, j, sim, rough = cosines(a[at:at + step], na[at:at + step], ua[at:at + step], b, nb, ub, rough)
                apart = ida[at + i] != idb[j]
                found.append((at + i[apart], j[apart], sim[apart]))
                if n is None:
                    i, j, sim = found.pop()
                    yield batch(ida[i], idb[j], sim)
                    if not same:
                        yield batch(idb[j], ida[i], sim)
            if n is not None:
                i, j, sim = (np.concatenate(parts) for parts in zip(*found))
                if not same:  # the whole block has met these vectors
                    top = best_of(j, sim, ida[i], n)
                    yield batch(idb[j[top]], ida[i[top]], sim[top])
                i, other, sim = (np.concatenate(two) for two in zip(best, (i, idb[j], sim)))
                top = best_of(i, sim, other, n)
                best = i[top], other[top], sim[top]
        if n is not None:
            yield batch(ida[best[0]], best[1], best[2])
    return fn


def item_similarity_latent(factors: DataFrame, theta: float = 0.6, block_size: int = 1024,
                           id_col: str = "mid", vec_col: str = "features", n: int | None = None) -> DataFrame:
    """M9: cosine of dense latent vectors, self removed, > theta; (m1, m2, sim).

    Items are written once in files of few vectors (``VectorFiles``), and groups of files are blocks, as many as there would be
    pairs of ``block_count`` blocks (MOST_SCANS at most). A task holds a block and scans the half of the others that follow it in
    a ring, so each pair of blocks meets once: it holds one block and a batch, and no vector is shuffled. With ``n``, a task
    gives the n best that it finds for each vector, which hold its n best of all."""
    spark = factors.sparkSession

    def blocks(count: int) -> int:
        scans = min(block_count(count, block_size), MOST_SCANS)
        return max(scans * (scans + 1) // 2, -(-count // LARGEST_BLOCK))
    items = VectorFiles(factors.select(F.col(id_col).cast("int").alias("id"), F.col(vec_col).alias("features")),
                        scratch_dir(spark, f"latent-{uuid.uuid4().hex}"), blocks)
    rows = lambda df, held: df.select(*[F.col("id").alias(c) if own else F.lit(None).cast("int").alias(c) for c, own in (("a", held), ("b", not held))],
                                      F.lit(held).alias("held"), "v", "wide")
    own, others, count = [], [], len(items.blocks)
    for p, (files, size) in enumerate(items.blocks):
        # with an even number of blocks, the opposite ones meet in the first half only
        ring = [(p + k) % count for k in range(1, count // 2 + 1) if 2 * k < count or p < count // 2]
        own.append((rows(items.of(files), True), size))
        others.append(rows(items.of([f for q in ring for f in items.blocks[q][0]]), False) if ring else rows(items.table, False).where("v is null"))
    return beside(own, others or rows(items.table, False), "v").mapInArrow(_similar_fn(theta, SIM_DIGITS, n), "m1 int, m2 int, sim double")
