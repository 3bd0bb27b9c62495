"""Packing: documents' token ids into sequences of a fixed capacity.

A document's full sequences are cut off first. What is left of the documents is
packed block by block with Karmarkar-Karp multiway differencing: every remainder
starts as a partial partition of m windows, the two partial partitions with the
largest imbalance are merged with opposing imbalances until one is left, and m
rises while a window exceeds the capacity. Every ``FILL`` th remainder stays out
of the partition and is cut to fill the windows' gaps; what is left over goes on
to the next block, and at a partition's end into sequences whose lengths are
powers of two. So no sequence needs padding but where the gaps outgrow the filler.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flickmill.llm.batches import pieces
from flickmill.llm.tokens import default_path, default_ranks, ids_of

END = (0).to_bytes(4, "little")
#: Windows of remainders in one block, and which remainders are filler.
BLOCK_WINDOWS = 192
FILL = 8


def differencing(sizes: list[int], m: int) -> list[list[int]]:
    """``m`` near-equal parts of the items (their numbers), by Karmarkar-Karp multiway differencing."""
    if m == 1 or not sizes:
        return [list(range(len(sizes)))] + [[] for _ in range(m - 1)]
    n, left, right = len(sizes), [], []
    heap = []
    for i, s in enumerate(sizes):
        sums, nodes = np.zeros(m, np.int64), np.full(m, -1, np.int64)
        sums[0], nodes[0] = s, i
        heap.append((-s, i, sums, nodes))
    heapq.heapify(heap)
    turn = n
    while len(heap) > 1:
        _, _, a, na = heapq.heappop(heap)
        _, _, b, nb = heapq.heappop(heap)
        sums, nb = a + b[::-1], nb[::-1]
        both = (na >= 0) & (nb >= 0)
        nodes = np.where(na < 0, nb, na)
        k = int(both.sum())
        if k:
            nodes[both] = np.arange(n + len(left), n + len(left) + k)
            left += na[both].tolist()
            right += nb[both].tolist()
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), turn, sums, nodes))
        turn += 1
    parts = []
    for node in heap[0][3].tolist():
        part, todo = [], [node] if node >= 0 else []
        while todo:
            x = todo.pop()
            if x < n:
                part.append(x)
            else:
                todo += [left[x - n], right[x - n]]
        parts.append(part)
    return parts


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """The fewest windows, from the sum's on, of which differencing lets none exceed the capacity."""
    m = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = differencing(sizes, m)
        if all(sum(sizes[i] for i in p) <= capacity for p in parts):
            return parts
        m += max(1, m // 64)


Piece = tuple[int, int, int]  # item, first token, tokens


def cut(stream: list[Piece], n: int) -> list[Piece]:
    """Takes ``n`` tokens from the end of the stream."""
    taken = []
    while n:
        item, start, length = stream.pop()
        if length > n:
            stream.append((item, start + n, length - n))
            length = n
        taken.append((item, start, length))
        n -= length
    return taken


def plan(rest: list[Piece], stream: list[Piece], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Sequences for a block's remainders and the stream, and what the stream has left (under one capacity)."""
    stream = stream + rest[::FILL]
    fixed = [p for i, p in enumerate(rest) if i % FILL]
    sizes = [p[2] for p in fixed]
    parts = sorted(([fixed[i] for i in part] for part in windows(sizes, capacity) if part), key=lambda p: -sum(x[2] for x in p))
    gaps = sum(capacity - sum(x[2] for x in p) for p in parts)
    have = sum(p[2] for p in stream)
    while gaps > have:  # the emptiest window becomes filler
        gone = parts.pop()
        size = sum(x[2] for x in gone)
        stream, gaps, have = stream + gone, gaps - capacity + size, have + size
    out = [p + cut(stream, capacity - sum(x[2] for x in p)) for p in parts]
    have -= gaps
    while have >= capacity:
        out.append(cut(stream, capacity))
        have -= capacity
    return out, stream


def last(stream: list[Piece]) -> list[list[Piece]]:
    """The stream in sequences whose lengths are powers of two."""
    n = sum(p[2] for p in stream)
    return [cut(stream, 1 << k) for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


PIECES = {"start": T.LongType(), "length": T.LongType(), "ids_crc32": T.LongType(), "doc_tokens": T.LongType(),
          "sequence_id": T.LongType(), "offset": T.LongType(), "ids": T.BinaryType()}
_ARROW = {"ids": pa.binary()}


def packed(docs: DataFrame, capacity: int = 1024, key: str = "doc_id", text: str = "text", with_ids: bool = True,
           path: str | None = None, ranks: str | None = None, special: bool = False) -> DataFrame:
    """One row per piece: the key, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for,
    ids (little-endian unsigned 32-bit).

    A document is its text's ids and then id 0; a null or empty text is that id alone. The strings of special tokens in
    a text are ordinary text or, with ``special``, those tokens, as by the tokenizer's default. Repeated rows are
    packed each; a null key stays null. Other input columns are not read. The sequences of a partition are
    made in one pass over it, with a block of documents in memory, and numbered from the partition's number
    times 2^33; nothing is shuffled.
    """
    names = [key] + [c for c in PIECES if with_ids or c != "ids"]
    schema = T.StructType([docs.select(F.col(f"`{key}`")).schema.fields[0]] + [T.StructField(c, PIECES[c]) for c in names[1:]])
    path, ranks = path or default_path(), ranks or default_ranks()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sequence = ids_of(path, ranks), TaskContext.get().partitionId() << 33
        items: dict[int, tuple[object, bytes]] = {}
        kind = None
        rest: list[Piece] = []
        stream: list[Piece] = []
        full: list[list[Piece]] = []
        size = 0

        def made(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequence
            cols: list[list] = [[] for _ in names]
            for s in sequences:
                offset = 0
                for i, start, length in s:
                    k, data = items[i]
                    view = memoryview(data)[4 * start:4 * (start + length)]
                    for col, v in zip(cols, (k, start, length, zlib.crc32(view), len(data) // 4, sequence, offset, bytes(view) if with_ids else None)):
                        col.append(v)
                    offset += length
                sequence += 1
            return pa.RecordBatch.from_arrays([pa.array(c, kind if j == 0 else _ARROW.get(n, pa.int64()))
                                               for j, (n, c) in enumerate(zip(names, cols))], names=names)

        n = 0
        for batch in batches:
            for piece in pieces(batch, "words"):
                kind = piece.column(0).type
                for k, x in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    data = ids.of(x, special) + END
                    items[n] = (k, data)
                    whole, over = divmod(len(data) // 4, capacity)
                    full += [[(n, w * capacity, capacity)] for w in range(whole)]
                    if over:
                        rest.append((n, whole * capacity, over))
                        size += over
                    n += 1
                    if size >= BLOCK_WINDOWS * capacity or len(full) >= 4 * BLOCK_WINDOWS:
                        done, stream = plan(rest, stream, capacity) if rest else ([], stream)
                        yield made(full + done)
                        items = {i: items[i] for i, _, _ in stream}
                        rest, full, size = [], [], 0
        if n:
            done, stream = plan(rest, stream, capacity) if rest else ([], stream)
            yield made(full + done + last(stream))

    return docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("words")).mapInArrow(run, schema)
