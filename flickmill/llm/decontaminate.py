"""Benchmark decontamination: Wu-Manber search for many word sequences at once.

The test strings are the windows of ``window`` consecutive words of each
benchmark item (an item of fewer words is one string). Strings of one length
form a group: a shift table over blocks of two words says how far the search
may jump, a zero shift leads to the bucket of the strings whose last block it
is, and a direct comparison of the words confirms an occurrence. Texts are
searched in segments that overlap by a string's length less one, all segments
of a piece in step, so a step is one table lookup for many places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flickmill.llm.batches import LETTERS, Words, mix, with_columns

#: Characters of benchmark text held in a task at once; a larger benchmark is searched in several passes.
BLOCK_CHARS = 16_000_000
SEGMENT_WORDS = 256


class Strings:
    """Shift table, suffix buckets and words of the test strings of one length (in words)."""

    def __init__(self, rows: dict[tuple[bytes, ...], set[str]], hashes: dict[bytes, int]):
        self.words = list(rows)
        self.items = [sorted(rows[w]) for w in self.words]
        self.n = len(self.words[0])
        self.block = min(2, self.n)
        h = np.array([[hashes[w] for w in s] for s in self.words], np.uint64)
        self.hashes = h
        self.free = self.n - self.block + 1  # the shift of a block that no string has
        blocks = np.stack([block_hash(h[:, j:j + self.block]) for j in range(self.free)])  # by end place
        shifts = np.repeat(np.arange(self.free - 1, -1, -1), h.shape[0])
        self.bits = max(12, int(np.ceil(np.log2(4 * blocks.size + 1))))
        self.shift = np.full(1 << self.bits, self.free, np.int32)
        np.minimum.at(self.shift, self.slot(blocks.ravel()), shifts.astype(np.int32))
        last = blocks[-1]
        order = np.argsort(last, kind="stable")
        self.suffix, self.member = last[order], order

    def slot(self, block: np.ndarray) -> np.ndarray:
        return (block >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, string) of each occurrence."""
        n, count = self.n, np.diff(words.first)
        # segments: [a, b) are the places where a string may end
        many = np.maximum(0, -(-(count - n + 1) // SEGMENT_WORDS))
        text = np.repeat(np.arange(len(count)), many)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        at = words.first[:-1][text] + n - 1 + nth * SEGMENT_WORDS
        stop = np.minimum(at + SEGMENT_WORDS, words.first[1:][text])
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(at):
            block = block_hash(np.stack([words.hash[at - self.block + 1 + j] for j in range(self.block)], 1))
            shift = self.shift[self.slot(block)]
            hit = shift == 0
            if hit.any():
                found += self.confirm(words, at[hit], block[hit])
            at = at + np.maximum(shift, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def confirm(self, words: Words, at: np.ndarray, block: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        lo, hi = np.searchsorted(self.suffix, block), np.searchsorted(self.suffix, block, side="right")
        size = hi - lo
        place = np.repeat(at, size)
        string = self.member[np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
        start = place - self.n + 1
        same = (words.hash[start[:, None] + np.arange(self.n)] == self.hashes[string]).all(1)
        start, string = start[same], string[same]
        raw = memoryview(words.buffer)
        sure = [all(raw[words.begin[s + j]:words.end[s + j]] == w for j, w in enumerate(self.words[k]))
                for s, k in zip(start.tolist(), string.tolist())]
        return [(start[sure], string[sure])] if any(sure) else []


def block_hash(h: np.ndarray) -> np.ndarray:
    out = h[:, 0]
    for j in range(1, h.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[:, j])
    return mix(out)


def compile_strings(items: list[tuple[str, str]], window: int) -> list[Strings]:
    """A table for each length of test strings that these (item id, text) have."""
    rows: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    hashes: dict[bytes, int] = {}
    for item, text in items:
        w = Words(pa.array([text], pa.string()), LETTERS, lower=True)
        raw = w.buffer.tobytes()
        ws = [raw[a:b] for a, b in zip(w.begin.tolist(), w.end.tolist())]
        hashes.update(zip(ws, w.hash.tolist()))
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            rows.setdefault(n, {}).setdefault(tuple(ws[i:i + n]), set()).add(item)
    return [Strings(rows[n], hashes) for n in sorted(rows)]


def search(col: pa.Array, strings: list[Strings]) -> tuple[Words, np.ndarray, list[set[str]]]:
    """The texts' words, which of them lie in an occurrence, and each text's items."""
    words = Words(col, LETTERS, lower=True)
    edge = np.zeros(len(words) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(len(col))]
    for s in strings:
        start, string = s.find(words)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + s.n, -1)
        for t, k in zip((np.searchsorted(words.first, start, side="right") - 1).tolist(), string.tolist()):
            items[t].update(s.items[k])
    return words, np.cumsum(edge[:-1]) > 0, items


def blocks(benchmark: DataFrame, item: str, text: str, window: int) -> Iterator[Broadcast]:
    """The tables of the benchmark, in blocks of BLOCK_CHARS of its text: one block is collected at a time.

    The total is measured first; a usual benchmark is one block. Each block is searched for in a pass of its own.
    """
    spark = benchmark.sparkSession
    b = benchmark.select(F.col(f"`{item}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t")).where("i is not null and t is not null")
    total = b.agg(F.sum(F.length("t"))).first()[0] or 0
    n = int(-(-total // BLOCK_CHARS)) or 1
    for k in range(n):
        part = b if n == 1 else b.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield spark.sparkContext.broadcast(compile_strings([(r.i, r.t) for r in part.collect()], window))


RESULT = {"n_words": T.LongType(), "n_hit": T.LongType(), "n_items": T.LongType(), "items_sha256": T.StringType(),
          "contaminated": T.BooleanType(), "hit_spans": T.ArrayType(T.ArrayType(T.LongType())), "items": T.ArrayType(T.StringType())}


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, keep: list[str] | None = None, text: str = "text",
                  item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document row: ``keep`` (all columns by default) and n_words, n_hit, n_items,
    items_sha256, contaminated, hit_spans (first word and the word after the last of each hit stretch), items.

    Null and empty texts have no words and are never contaminated. Items with a null
    id or text, or without words, are never found; items with one id count once.
    Repeated document rows are each judged. Input columns named like a result are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULT]
    made = docs
    for k, shared in enumerate(blocks(benchmark, item, item_text, window)):
        before = [] if k == 0 else list(RESULT)
        made = with_columns(made.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text, *before])]),
                            lambda piece, s=shared, b=before: judged(piece, text, s.value, bool(b)), RESULT,
                            list(dict.fromkeys([*keep, text])), text, extra=before)
    return made.select(*[F.col(f"`{c}`") for c in [*keep, *RESULT]])


def judged(piece: pa.RecordBatch, text: str, strings: list[Strings], again: bool) -> dict[str, pa.Array]:
    """The result columns; ``again``: together with what an earlier pass has found."""
    words, hit, items = search(piece.column(piece.schema.get_field_index(text)), strings)
    if again:
        for t, (spans, ids) in enumerate(zip(piece.column("hit_spans").to_pylist(), piece.column("items").to_pylist())):
            items[t].update(ids)
            for a, b in spans:
                hit[words.first[t] + a:words.first[t] + b] = True
    of = words.text_of()
    change = np.ones(len(hit) + 1, np.bool_)
    change[1:-1] = (hit[1:] != hit[:-1]) | (of[1:] != of[:-1])
    edges = np.flatnonzero(change)
    spans = [[] for _ in items]
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if hit[a]:
            spans[of[a]].append([int(a - words.first[of[a]]), int(b - words.first[of[a]])])
    n_hit = np.bincount(of[hit], minlength=len(items))
    ids = [sorted(x) for x in items]
    return {"n_words": pa.array(np.diff(words.first), pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
            "n_items": pa.array([len(x) for x in ids], pa.int64()),
            "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids], pa.string()),
            "contaminated": pa.array(n_hit > 0), "hit_spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
            "items": pa.array(ids, pa.list_(pa.string()))}


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text") -> DataFrame:
    """The documents without a hit, with their columns as they are. Null and empty texts stay."""
    for shared in blocks(benchmark, "item_id", "text", window):
        def clean(piece: pa.RecordBatch, s=shared) -> dict[str | None, pa.Array]:
            words, hit, _ = search(piece.column(piece.schema.get_field_index(text)), s.value)
            return {None: pa.array(np.bincount(words.text_of()[hit], minlength=piece.num_rows) == 0)}

        docs = with_columns(docs, clean, {}, None, text, filtered=True)
    return docs
