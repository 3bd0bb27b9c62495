"""Toxicity classifier: a convolutional network over words, trained in numpy.

A word's vector is the sum of hashed embeddings, of the word and of its beginnings
(so that unseen forms of a family of words share most of theirs). Filters of several
widths slide over a text's word vectors, each filter's largest value in the text is
kept, and a logistic layer over these gives the score. The network is first trained on
a bounded number of labelled rows on the driver. If there are more, tasks then go on
from it, each over a shard of all of them, and their networks are averaged; all rows
kept for it calibrate, by counts. Every whole text is scored in the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flickmill.llm.batches import LETTERS, Powers, mix, pieces, text_bytes
from flickmill.llm.scratch import written
from flickmill.llm.sieve import sieved

#: Labelled rows that training begins with at most (label 0, label 1) and the bytes of all their texts, for each label.
SAMPLE, SAMPLE_BYTES = (2_400, 1_200), 8_000_000
#: Rows and bytes of text of a shard of all labelled rows, about; rows of the embedding table that are averaged at once.
SHARD_ROWS, SHARD_BYTES, TABLE_PART = 4_000, 16_000_000, 1024
#: One row of so many is kept for calibration; a label of fewer than FEW rows has all of them in both parts.
CALIBRATE, FEW = 4, 64
#: Rows of the embedding table (row 0 is zero), its columns, filters of each width, widths in words, beginnings in bytes.
BUCKETS, SIZE, FILTERS, WIDTHS, BEGINNINGS = 1 << 16, 16, 16, (1, 2, 3), (3, 4, 5, 6, 7, 8)
#: Training: passes over the sample and steps, at least; texts of a step, step size, shrinkage, seed.
PASSES, STEPS, STEP_TEXTS, RATE, SHRINK, SEED = 5, 800, 16, 0.05, 1e-4, 7
#: Bytes of text whose words are handled at once; a longer text is cut between words, with the widest filter's overlap.
SLICE_BYTES = 2_000_000
#: Calibration rows of either label that a language needs for a threshold of its own.
LEAST_ROWS = 15

_POWERS = Powers(0x9E3779B97F4A7C15)


class Model(NamedTuple):
    """Embeddings, filters (width -> width x SIZE x FILTERS), their offsets, the last layer, and the calibration."""
    table: np.ndarray
    filters: tuple[np.ndarray, ...]
    offsets: tuple[np.ndarray, ...]
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def held_out(doc_id: Column) -> Column:
    """One row of five, by its id; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def word_rows(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each word of the bytes (runs of digits, letters and bytes beyond ASCII): where it begins, and the rows of the
    embedding table that add up to its vector (of the word, and of its beginnings if it is longer, else 0)."""
    inside = np.zeros(len(buffer) + 2, np.bool_)
    inside[1:-1] = LETTERS[buffer]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    up, down = _POWERS.get(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * up[:len(buffer)], out=sums[1:])
    rows = np.zeros((len(begin), 1 + len(BEGINNINGS)), np.int32)
    for j, k in enumerate((None, *BEGINNINGS)):
        long = slice(None) if k is None else np.flatnonzero(end - begin > k)
        a, b = begin[long], end[long] if k is None else begin[long] + k
        rows[long, j] = 1 + (mix((sums[b] - sums[a]) * down[a]) % np.uint64(BUCKETS - 1)).astype(np.int64)
    return begin, rows


def vectors(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = table[rows[:, 0]]
    for j in range(1, rows.shape[1]):
        out += table[rows[:, j]]
    return out


def convolved(x: np.ndarray, filters: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """The filters' values at each word; words behind a text's end count as zero vectors."""
    y = x @ filters[0]
    for k in range(1, min(len(filters), len(x))):
        y[:-k] += (x[k:] * (text_of[k:] == text_of[:-k])[:, None]) @ filters[k]
    return y


def pooled(model: Model, buffer: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Largest value of each filter in each text (0, that of a window without words, at least), before the offset.

    ``starts`` holds each text's first byte, and the end last. Memory is bounded by SLICE_BYTES, not by a text."""
    out = np.zeros((len(starts) - 1, len(WIDTHS) * FILTERS), np.float32)
    more, at = max(WIDTHS) - 1, 0
    while at < len(buffer):
        begin, rows, to = next_words(buffer, at)
        # windows that a cut would shorten belong to the next slice, which begins with their words
        own = len(begin) if to == len(buffer) else len(begin) - more
        if own > 0:
            text_of = np.searchsorted(starts, begin, side="right") - 1
            x = vectors(model.table, rows)
            texts, first = np.unique(text_of[:own], return_index=True)
            top = np.concatenate([np.maximum.reduceat(convolved(x, f, text_of)[:own], first, axis=0) for f in model.filters], axis=1)
            out[texts] = np.maximum(out[texts], top)
        at = to if to == len(buffer) or not more else int(begin[-more])
    return out


def next_words(buffer: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Of the words from ``at`` on, those of a slice of about SLICE_BYTES that cuts no word and holds more than the widest
    filter (or reaches the end): where each begins, its rows, and where the slice ends."""
    size = SLICE_BYTES
    while True:
        to = min(len(buffer), at + size)
        while to < len(buffer) and LETTERS[buffer[to]]:
            space = np.flatnonzero(~LETTERS[buffer[to:to + SLICE_BYTES]])
            to = to + int(space[0]) if len(space) else min(len(buffer), to + SLICE_BYTES)
        begin, rows = word_rows(buffer[at:to])
        if to == len(buffer) or len(begin) > max(WIDTHS):
            return begin + at, rows, to
        size *= 2


def logits(model: Model, top: np.ndarray) -> np.ndarray:
    return np.maximum(top + np.concatenate(model.offsets), 0).astype(float) @ model.weights.astype(float) + model.bias


def scores(model: Model, top: np.ndarray) -> np.ndarray:
    """To six places, so that they don't depend on which texts were multiplied at once."""
    return np.round(1 / (1 + np.exp(-np.clip(model.slope * logits(model, top) + model.shift, -700, 700))), 6)


class State(NamedTuple):
    """A network in training: embeddings, the other arrays (filters, offsets, last layer, bias), and both's past gradients."""
    table: np.ndarray
    dense: list[np.ndarray]
    past_table: np.ndarray
    past: list[np.ndarray]

    def model(self) -> Model:
        w = len(WIDTHS)
        return Model(self.table, tuple(self.dense[:w]), tuple(self.dense[w:2 * w]), self.dense[-2], float(self.dense[-1][0]), 1.0, 0.0)

    def copy(self) -> State:
        return State(self.table.copy(), [p.copy() for p in self.dense], self.past_table.copy(), [p.copy() for p in self.past])


def begun(rng: np.random.Generator) -> State:
    table = rng.normal(0, 0.05, (BUCKETS, SIZE)).astype(np.float32)
    table[0] = 0
    filters = [rng.normal(0, 0.3, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    offsets = [np.full(FILTERS, 0.05, np.float32) for _ in WIDTHS]
    dense = [*filters, *offsets, rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), np.zeros(1, np.float32)]
    return State(table, dense, np.full_like(table, 1e-3), [np.full_like(p, 1e-3) for p in dense])


def text_rows(text: str) -> np.ndarray:
    """A text to train on: its words' rows, or its bytes if it is long."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return data if len(data) > SLICE_BYTES else word_rows(data)[1]


def slices(text: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Words' rows of a text, a slice at a time, and how many of them begin a window that belongs to the slice."""
    if text.dtype != np.uint8:
        yield text, len(text)
        return
    more, at = max(WIDTHS) - 1, 0
    while at < len(text):
        begin, rows, to = next_words(text, at)
        yield rows, len(begin) if to == len(text) else len(begin) - more
        at = to if to == len(text) or not more else int(begin[-more])


def strongest(table: np.ndarray, filters: list[np.ndarray], text: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each width: its filters' largest values in a text, the rows of the words that these stand on (width x filter), and
    whether there is such a word (the text may end before it)."""
    none = np.zeros((1, SIZE), np.float32)
    best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for rows, own in slices(text):
        if not own and best:
            continue
        x = vectors(table, rows) if len(rows) else none
        same = np.zeros(len(x), np.int8)
        for w, f in enumerate(filters):
            y = convolved(x, f, same)[:max(1, own)]
            at = y.argmax(0)
            words = at + np.arange(len(f))[:, None]
            there = words < len(rows)
            found = y[at, np.arange(FILTERS)], rows[np.minimum(words, len(rows) - 1)] if len(rows) else np.zeros((*words.shape, 1 + len(BEGINNINGS)), np.int32), there
            if w == len(best):
                best.append(found)
            else:
                better = found[0] > best[w][0]
                best[w] = np.where(better, found[0], best[w][0]), np.where(better[None, :, None], found[1], best[w][1]), np.where(better, found[2], best[w][2])
    return best or strongest(table, filters, np.zeros((0, 1 + len(BEGINNINGS)), np.int32))


def learn(state: State, texts: list[np.ndarray], labels: np.ndarray, share: np.ndarray, passes: int, rng: np.random.Generator) -> None:
    """Adagrad steps over texts (text_rows), whose rows weigh ``share``. Only the words that a filter's largest value stands
    on get a gradient."""
    table, dense, past_table, past = state
    filters, offsets, (weights, bias) = dense[:len(WIDTHS)], dense[len(WIDTHS):2 * len(WIDTHS)], dense[-2:]
    for _ in range(passes):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), STEP_TEXTS):
            some = order[a:a + STEP_TEXTS]
            grads = [np.zeros_like(p) for p in dense]
            touched, pulls = [], []
            for i in some:
                best = strongest(table, filters, texts[i])
                value = np.maximum(np.concatenate([top for top, _, _ in best]), 0) + np.concatenate(offsets)
                z = np.maximum(value, 0)
                p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(z @ weights + bias[0])))))
                d = (p - labels[i]) * share[i] / len(some)
                grads[-2] += d * z
                grads[-1] += d
                dz = d * weights * (value > 0)
                for w, f in enumerate(filters):
                    top, words, there = best[w]
                    g = dz[w * FILTERS:(w + 1) * FILTERS]
                    grads[len(filters) + w] += g
                    g = np.where(top > 0, g, 0).astype(np.float32)
                    for k in range(len(f)):
                        here = np.flatnonzero(there[k] & (g != 0))
                        grads[w][k][:, here] += vectors(table, words[k][here]).T * g[here]
                        touched.append(words[k][here])
                        pulls.append(f[k][:, here].T * g[here][:, None])
            ids, inverse = np.unique(np.concatenate(touched).ravel(), return_inverse=True)
            if len(ids):
                pull = np.zeros((len(ids), SIZE), np.float32)
                np.add.at(pull, inverse, np.repeat(np.concatenate(pulls), 1 + len(BEGINNINGS), axis=0))
                pull += SHRINK * table[ids]
                pull[ids == 0] = 0
                past_table[ids] += pull * pull
                table[ids] -= RATE * pull / np.sqrt(past_table[ids])
            for p, g, q in zip(dense, grads, past):
                q += g * g
                p -= RATE * g / np.sqrt(q)


def shares(labels: np.ndarray, counts: tuple[float, float]) -> np.ndarray:
    """Weights by which both labels weigh the same, with these numbers of rows."""
    return np.where(labels == 1, 0.5 / max(1, counts[1]), 0.5 / max(1, counts[0])) * sum(counts)


def trained(texts: list[np.ndarray], labels: np.ndarray) -> State:
    rng = np.random.default_rng(SEED)
    state = begun(rng)
    passes = max(PASSES, math.ceil(STEPS * STEP_TEXTS / len(texts)))
    learn(state, texts, labels, shares(labels, ((1 - labels).sum(), labels.sum())), passes, rng)
    return state


def trained_on_all(rows: DataFrame, start: State, counts: tuple[int, int], size: int) -> State:
    """``start`` after a pass over all of ``rows`` (doc_id, toxic, text; ``counts`` of either label, ``size`` bytes of text):
    each shard is learned from in a task of its own, and the shards' changes are averaged, those of an embedding over the
    shards that changed it. Only the averages go through the driver. The order within and of shards is that of ids."""
    n = max(1, math.ceil(sum(counts) / SHARD_ROWS), math.ceil(size / SHARD_BYTES))
    shared = rows.sparkSession.sparkContext.broadcast(start)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        was = shared.value
        state = was.copy()
        table = table.sort_by([("doc_id", "ascending"), ("toxic", "ascending")])
        y = table.column("toxic").to_numpy().astype(float)
        texts = [text_rows(t.as_py()) for t in pc.utf8_lower(table.column("text"))]
        learn(state, texts, y, shares(y, counts), 1, np.random.default_rng([SEED, key[0].as_py()]))
        ids = np.flatnonzero((state.table != was.table).any(1)).astype(np.int32)
        parts = ids // TABLE_PART
        out = [(-1, key[0].as_py(), [], np.concatenate([(p - q).ravel() for p, q in zip(state.dense, was.dense)]))]
        out += [(int(p), key[0].as_py(), ids[parts == p], (state.table - was.table)[ids[parts == p]].ravel()) for p in np.unique(parts)]
        part, shard, own, values = zip(*out)
        return pa.table({"part": pa.array(part, pa.int32()), "shard": pa.array(shard, pa.int32()), "ids": pa.array(own, pa.list_(pa.int32())), "values": pa.array(values, pa.list_(pa.float32()))})

    def mean(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        ids, values = (table.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", "values"))
        if key[0].as_py() < 0:
            made = values.reshape(len(table), -1).mean(0, dtype=float)
        else:
            ids, inverse, times = np.unique(ids, return_inverse=True, return_counts=True)
            total = np.zeros((len(ids), SIZE))
            np.add.at(total, inverse, values.reshape(-1, SIZE))
            made = (total / times[:, None]).ravel()
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "ids": pa.array([ids], pa.list_(pa.int32())), "values": pa.array([made], pa.list_(pa.float64()))})

    dealt = rows.select("doc_id", "toxic", "text", F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(n)).cast("int").alias("shard"))
    # a number of parts that stays: learning takes longer than its text's size tells
    changes = dealt.repartition(n, "shard").groupBy("shard").applyInArrow(run, "part int, shard int, ids array<int>, values array<float>")
    state = start.copy()
    for row in changes.groupBy("part").applyInArrow(mean, "part int, ids array<int>, values array<double>").toArrow().to_batches():
        for part, ids, values in zip(*(row.column(i) for i in range(3))):
            change = values.values.to_numpy()
            if part.as_py() >= 0:
                state.table[ids.values.to_numpy()] += change.reshape(-1, SIZE).astype(np.float32)
                continue
            ends = np.cumsum([p.size for p in state.dense])
            for p, c in zip(state.dense, np.split(change, ends[:-1])):
                p += c.reshape(p.shape).astype(np.float32)
    return state


def calibrated(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a little shrinkage; rising at least slightly. ``n`` is how
    often each (x, y) stands."""
    scale = math.sqrt(np.average((x - np.average(x, weights=n)) ** 2, weights=n)) or 1.0
    m, w = np.stack([x / scale, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        w -= np.linalg.solve((m * (n * p * (1 - p))[:, None]).T @ m + 0.05 * np.eye(2), m.T @ (n * (p - y)) + 0.05 * w)
    return max(1e-3, float(w[0])) / scale, float(w[1])


def threshold(score: np.ndarray, label: np.ndarray, n: np.ndarray | None = None) -> float:
    """The score from which on a row counts as toxic: the middle of the cuts that are right for the largest share of
    either label, on average."""
    n = np.ones(len(score)) if n is None else n
    values, place = np.unique(score, return_inverse=True)
    cuts = np.concatenate([[0.0], (values[1:] + values[:-1]) / 2, [1.0]])
    toxic, clean = (np.bincount(place, n * (label == v), len(values)) for v in (1, 0))
    at = np.searchsorted(values, cuts)
    hit = np.append(np.cumsum(toxic[::-1])[::-1], 0)[at] / toxic.sum() + np.append(0, np.cumsum(clean))[at] / clean.sum()
    best = cuts[hit == hit.max()]
    return float(best[len(best) // 2])


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, text, lang) of all labelled rows outside the held-out fold, written. Null texts count as empty."""
    some = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    own = docs.select("doc_id", "text", "lang")
    if own.schema["doc_id"].dataType == some.schema["doc_id"].dataType:
        own = sieved(own, "doc_id", some.select("doc_id"))
    rows = own.withColumn("text", F.coalesce("text", F.lit(""))).join(some, "doc_id").groupBy("doc_id", "toxic").agg(F.min_by(F.struct("text", "lang"), F.struct("text", "lang")).alias("r"))
    return written(rows.select("doc_id", "toxic", "r.text", "r.lang"), "toxicity_rows")


def sample(rows: DataFrame) -> pa.Table:
    """(text, lang, toxic) of at most SAMPLE rows of each label, in the order of a hash of the id, as far as SAMPLE_BYTES go."""
    drawn, order = [], [F.xxhash64("doc_id"), F.col("doc_id")]
    for label, most in enumerate(SAMPLE):
        of = rows.select("doc_id", "toxic", F.octet_length("text").alias("size")).where((F.col("toxic") == label) & (F.col("size") <= SAMPLE_BYTES))
        # about twice as many as needed are kept before they are sorted, whatever the number of labels
        share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, (2 * most + 100) / max(1, of.count())))
        left = SAMPLE_BYTES
        for r in of.where(share).orderBy(*order).limit(most).collect():
            left -= r.size
            if left < 0:
                break
            drawn.append((r.doc_id, label))
    ids = rows.sparkSession.createDataFrame(drawn, T.StructType([rows.schema["doc_id"], T.StructField("toxic", T.IntegerType())]))
    return rows.join(F.broadcast(ids), ["doc_id", "toxic"]).orderBy(*order, "toxic").select("text", "lang", "toxic").toArrow()


def judged(rows: DataFrame, model: Model) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Languages, logits (to three places), labels and how many of ``rows`` have these."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                z = logits(shared.value, pooled(shared.value, *text_bytes(pc.utf8_lower(piece.column(2)))))
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(np.round(z, 3) + 0.0)], names=["lang", "toxic", "z"])

    kinds = T.StructType([rows.schema["lang"], rows.schema["toxic"], T.StructField("z", T.DoubleType())])
    found = rows.select("lang", "toxic", "text").mapInArrow(run, kinds).groupBy("lang", "z", "toxic").count().orderBy("lang", "z", "toxic").toArrow()
    return found.column("lang").to_pylist(), *(found.column(c).to_numpy().astype(float) for c in ("z", "toxic", "count"))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model, dict[str, float]]:
    """The network of ``labels.toxic`` and each language's threshold ("" for those without their own), from all labelled rows.

    Without rows of both labels the network is zero and all scores are the share of toxic ones (one half without any).
    """
    rows = labelled(docs, labels)
    found = {r.toxic: (r.n, r.size) for r in rows.groupBy("toxic").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).collect()}
    if len(found) < 2:
        p = min(0.99, max(0.01, float(max(found)))) if found else 0.5
        zero = np.zeros((BUCKETS, SIZE), np.float32)
        none = Model(zero, tuple(np.zeros((w, SIZE, FILTERS), np.float32) for w in WIDTHS), tuple(np.zeros(FILTERS, np.float32) for _ in WIDTHS),
                     np.zeros(len(WIDTHS) * FILTERS, np.float32), 0.0, 0.0, math.log(p / (1 - p)))
        return none, {"": 0.5}
    if all(n <= most and size <= SAMPLE_BYTES for most, (n, size) in zip(SAMPLE, (found[0], found[1]))):
        model, langs, x, y, n = fit_at_once(sample(rows))
    else:
        few = F.col("toxic").isin([v for v, (n, _) in found.items() if n < FEW])
        aside = F.pmod(F.xxhash64(F.lit(CALIBRATE), "doc_id"), F.lit(CALIBRATE)) == 0
        own = rows.where(~aside | few)
        first = sample(own)
        start = trained([text_rows(lowered(t)) for t in first.column("text").to_pylist()], np.array(first.column("toxic").to_pylist(), float))
        sizes = {r.toxic: (r.n, r.size) for r in own.groupBy("toxic").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).collect()}
        (none, size0), (ones, size1) = sizes.get(0, (0, 0)), sizes.get(1, (0, 0))
        model = trained_on_all(own, start, (none, ones), size0 + size1).model()
        langs, x, y, n = judged(rows.where(aside | few), model)
    slope, shift = calibrated(x, y, n)
    model = model._replace(slope=slope, shift=shift)
    s = 1 / (1 + np.exp(-np.clip(slope * x + shift, -700, 700)))
    cuts = {"": 0.5}
    for lang in sorted({v for v in langs if v}):
        own = np.array([v == lang for v in langs])
        if min(n[own & (y == v)].sum() for v in (0, 1)) >= LEAST_ROWS:
            cuts[lang] = threshold(s[own], y[own], n[own])
    return model, cuts


def fit_at_once(rows: pa.Table) -> tuple[Model, list, np.ndarray, np.ndarray, np.ndarray]:
    """The network of few rows, and languages, logits and labels of those that calibrate it, each standing once."""
    y = np.array(rows.column("toxic").to_pylist(), float)
    langs = rows.column("lang").to_pylist()
    texts = [word_rows(np.frombuffer(lowered(t).encode("utf-8", "surrogatepass"), np.uint8))[1] for t in rows.column("text").to_pylist()]
    aside = np.zeros(len(y), bool)
    for label in (0, 1):  # of either label, as far as it has enough
        of = np.flatnonzero(y == label)
        aside[of[::CALIBRATE] if len(of) >= CALIBRATE else of] = True
    own = [i for i in range(len(y)) if not aside[i] or (y == y[i]).sum() < CALIBRATE]
    model = trained([texts[i] for i in own], y[own]).model()
    rest = np.flatnonzero(aside)
    x = logits(model, np.array([top_of(model, texts[i]) for i in rest]))
    return model, [langs[i] for i in rest], x, y[rest], np.ones(len(rest))


def lowered(text: str) -> str:
    return pc.utf8_lower(pa.scalar(text)).as_py()


def top_of(model: Model, rows: np.ndarray) -> np.ndarray:
    """``pooled`` of one text given as its words' rows."""
    if not len(rows):
        return np.zeros(len(WIDTHS) * FILTERS, np.float32)
    x, same = vectors(model.table, rows), np.zeros(len(rows), np.int8)
    return np.maximum(np.concatenate([convolved(x, f, same).max(0) for f in model.filters]), 0)


def scored(docs: DataFrame, model: Model, cuts: dict[str, float] | None = None) -> DataFrame:
    """The rows with all their columns and score (0 to 1, higher: label 1 likelier), of the text alone; with ``cuts``, also
    flagged (score from its language's threshold on; ``lang`` is read for that only). Null and empty texts have the score
    of no words. Repeated rows are each scored. Input columns of these names are replaced."""
    keep = [c for c in docs.columns if c not in ("score", "flagged")]
    schema = T.StructType([f for f in docs.schema.fields if f.name in keep] + [T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = pc.utf8_lower(piece.column(piece.schema.get_field_index("text")))
                s = scores(m, pooled(m, *text_bytes(texts)))
                yield pa.RecordBatch.from_arrays([piece.column(i) for i in range(len(keep))] + [pa.array(s, pa.float64())], names=[*keep, "score"])

    made = docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)
    if cuts is None:
        return made
    own = F.lit(cuts[""])
    for lang, cut in cuts.items():
        own = F.when(F.col("lang") == lang, F.lit(cut)).otherwise(own)
    return made.withColumn("flagged", F.col("score") >= own)


def toxicity(docs: DataFrame, labels: DataFrame, cut: float = 0.5) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted (1 from ``cut`` on), flagged (from its language's
    threshold on)."""
    model, cuts = fit(docs, labels)
    out = scored(docs.select("doc_id", "text", "lang"), model, cuts)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), "flagged")
