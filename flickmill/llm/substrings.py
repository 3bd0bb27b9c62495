"""Substring dedup: removes passages that an earlier document has, by level-wise doubling.

Level one takes windows of ``base`` words, of each ``2 * base`` words' windows
only those with the least hash (a passage of 2 * base words picks the same ones
wherever it stands). Windows that repeat across documents are extended to twice
their length, those that repeat again to twice that, until the wanted length is
reached or none are left. Only hashes, ids and places are shuffled; words are
read again from the texts of documents that still have candidates.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flickmill.llm.batches import NOT_SPACE, Words, window_hashes, with_columns
from flickmill.llm.scratch import written


def sliding(x: np.ndarray, n: int, best: np.ufunc) -> np.ndarray:
    """The least or greatest of each ``n`` consecutive values."""
    out, width = x, 1
    while 2 * width <= n:
        out, width = best(out[:-width], out[width:]), 2 * width
    return best(out[:len(x) - n + 1], out[n - width:]) if width < n else out


def within(of: np.ndarray, n: int) -> np.ndarray:
    """Of each window of ``n`` words, whether it lies in one text."""
    return of[:len(of) - n + 1] == of[n - 1:] if len(of) >= n else np.zeros(0, np.bool_)


def least_windows(words: Words, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the windows of ``base`` words that are least in some window of 2 * base words."""
    of, hashes = words.text_of(), window_hashes(words.hash, base)
    whole = within(of, 2 * base)
    if not whole.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least = np.where(whole, sliding(hashes, base + 1, np.minimum), 0)
    around = np.zeros(len(hashes) + base, np.uint64)
    around[base:base + len(least)] = least
    place = np.flatnonzero((sliding(around, base + 1, np.maximum) == hashes) & (hashes > 0))
    return hashes[place], place


def spread_over(place: np.ndarray, back: int, n: int) -> np.ndarray:
    """Mask of the starts whose window holds a candidate: each place and ``back`` places before it."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.maximum(place - back, 0), 1)
    np.add.at(edge, np.minimum(place + 1, n), -1)
    return np.cumsum(edge[:-1]) > 0


FOUND = T.StructType([T.StructField("h", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("place", T.IntegerType())])


def rows(h: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(doc, pa.int64()), pa.array(place, pa.int32())], names=FOUND.names)


def first_level(docs: DataFrame, base: int) -> DataFrame:
    from flickmill.llm.batches import pieces

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                w = Words(piece.column(1), NOT_SPACE)
                h, place = least_windows(w, base)
                of = np.searchsorted(w.first, place, side="right") - 1
                yield rows(h, piece.column(0).to_numpy(zero_copy_only=False)[of], place - w.first[of])

    return docs.mapInArrow(run, FOUND)


def next_level(docs: DataFrame, candidates: DataFrame, n: int, dense: bool) -> DataFrame:
    """Windows of ``n`` words around the candidates: those that hold a candidate of the first level,
    or whose two halves are candidates of the level before."""
    from flickmill.llm.batches import pieces
    half = n // 2

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                w = Words(piece.column(1), NOT_SPACE)
                lists = piece.column(2)
                counts = np.diff(lists.offsets.to_numpy())
                text = np.repeat(np.arange(len(counts)), counts)
                place = lists.flatten().to_numpy(zero_copy_only=False) + w.first[text]
                h = window_hashes(w.hash, n)
                if not len(h):
                    continue
                if dense:
                    mask = np.zeros(len(w) + n, np.bool_)
                    mask[place] = True
                    mask = mask[:len(h)] & mask[half:half + len(h)]
                else:
                    mask = spread_over(place, n - half, len(h))
                start = np.flatnonzero(mask & within(w.text_of(), n))
                of = np.searchsorted(w.first, start, side="right") - 1
                yield rows(h[start], piece.column(0).to_numpy(zero_copy_only=False)[of], start - w.first[of])

    lists = candidates.groupBy("doc").agg(F.collect_list("place").alias("places"))
    return docs.join(lists, docs["doc_id"] == lists["doc"]).select("doc_id", "text", "places").mapInArrow(run, FOUND)


def repeated(found: DataFrame) -> DataFrame:
    """The windows that stand in two documents at least, with the first of them."""
    firsts = found.groupBy("h").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc")).where("first_doc < last_doc")
    return found.join(firsts.select("h", "first_doc"), "h").select("doc", "place", "first_doc")


OUT = {"n_words": T.LongType(), "n_removed": T.LongType(), "kept_sha256": T.StringType(), "kept_text": T.StringType()}


def deduplicated(docs: DataFrame, window: int = 50, base: int = 25, with_text: bool = True) -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text (kept words
    joined by one space).

    A word goes if a window of ``window`` words over it also starts in a document with a smaller doc_id; ``window`` is
    ``base`` times a power of two. Null and empty texts have no words. Rows with a null doc_id are compared with no
    other and keep all words. A doc_id names one text: repeated rows are judged alike (of differing texts under one id,
    each is judged by the windows of all). Other columns are not read.
    """
    if window < 2 * base or window % base or (k := window // base) & (k - 1):
        raise ValueError("window must be base times 2, 4, 8, ...")
    out = {k: v for k, v in OUT.items() if with_text or k != "kept_text"}
    known = docs.select("doc_id", "text").where("doc_id is not null")
    candidates = repeated(written(first_level(known, base), "substring_anchors"))
    n, dense = 2 * base, False
    while True:
        candidates = repeated(next_level(known, candidates, n, dense))
        if n == window:
            break
        n, dense = 2 * n, True
        candidates = written(candidates, "substring_level")
    starts = candidates.where("first_doc < doc").groupBy("doc").agg(F.collect_list("place").alias("places"))
    joined = known.join(starts, known["doc_id"] == starts["doc"], "left").select("doc_id", "text", "places")
    nameless = docs.where("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<int>").alias("places"))

    def remove(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        words, keep = Words(piece.column(1), NOT_SPACE), None
        edge = np.zeros(len(words) + 1, np.int64)
        for t, places in enumerate(piece.column(2)):
            if places.is_valid:
                a, b = words.first[t], words.first[t + 1]
                start = places.values.to_numpy(zero_copy_only=False) + a
                start = start[start < b]
                np.add.at(edge, start, 1)
                np.add.at(edge, np.minimum(start + window, b), -1)
        keep = np.cumsum(edge[:-1]) == 0
        kept = [words.joined(t, keep) for t in range(piece.num_rows)]
        gone = np.bincount(words.text_of()[~keep], minlength=piece.num_rows)
        made = {"n_words": pa.array(np.diff(words.first), pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())}
        if with_text:
            made["kept_text"] = pa.array([x.decode("utf-8", "replace") for x in kept], pa.string())
        return made

    return with_columns(joined.unionByName(nameless), remove, out, ["doc_id"], "text", extra=["places"])
