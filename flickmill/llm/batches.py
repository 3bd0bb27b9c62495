"""Arrow batches: running a function over a frame in bounded pieces, and words
of many texts at once as numpy arrays.

Text is handled as one byte buffer per piece, so splitting and hashing cost a
few vector operations per piece instead of Python work per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text handled at once; a longer text is a piece of its own.
PIECE_BYTES = 2_000_000

SPACES = b" \t\n\x0b\x0c\r"


def with_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, pa.Array]], out: dict[str, T.DataType],
                 keep: list[str] | None = None, text: str = "text", filtered: bool = False,
                 extra: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) with the columns ``out`` that ``fn`` makes of each piece.

    A column of ``out`` that is among ``keep`` replaces it. With ``filtered``,
    ``fn`` also returns a boolean mask under the name None; only those rows stay.
    ``fn`` sees ``keep``, ``text`` and the columns ``extra``.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in out]
    used = list(dict.fromkeys([*keep, text, *(extra or [])]))
    schema = T.StructType([f for f in df.select([F.col(f"`{c}`") for c in keep]).schema.fields]
                          + [T.StructField(k, t) for k, t in out.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                made = fn(piece)
                cols = [piece.column(piece.schema.get_field_index(c)) for c in keep] + [made[c] for c in out]
                result = pa.RecordBatch.from_arrays(cols, names=keep + list(out))
                yield result.filter(made[None]) if filtered else result

    return df.select([F.col(f"`{c}`") for c in used]).mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, text: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold ``most`` bytes together, or that have one row."""
    n = batch.num_rows
    if not n:
        return
    col = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(np.nan_to_num(lengths(col)))
    at = 0
    while at < n:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def lengths(col: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 as one buffer, a space after each, and where each begins (with the end last). Null is empty."""
    raw = col.to_pylist()
    parts = [x.encode("utf-8", "surrogatepass") if x else b"" for x in raw]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return np.frombuffer(b" ".join(parts) + b" ", np.uint8), starts


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's last steps, on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n + n // 4, 1 << 16)  # no more than pieces of this size ask for: every worker holds them
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                                  for b in (self.base, self.inverse))
        return self.up, self.down


_BYTES = Powers(0x9E3779B97F4A7C15)
_WORDS = Powers(0xD1342543DE82EF95)


class Words:
    """Words of the texts of one piece.

    ``word_bytes`` is a table of 256 booleans: what belongs to words. All of a
    text's words stand together: text i has words ``first[i]`` to ``first[i + 1]``.
    ``begin`` and ``end`` are places in ``buffer``, ``hash`` is a 64-bit hash of each word.
    """

    def __init__(self, col: pa.Array, word_bytes: np.ndarray, lower: bool = False):
        self.buffer, self.texts = text_bytes(col)
        if lower:
            low = np.arange(256, dtype=np.uint8)
            low[65:91] += 32
            self.buffer = low[self.buffer]
        inside = np.zeros(len(self.buffer) + 1, np.bool_)
        inside[1:] = word_bytes[self.buffer]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.begin, self.end = edges[::2], edges[1::2]
        self.first = np.searchsorted(self.begin, self.texts)
        up, down = _BYTES.get(len(self.buffer) + 1)
        sums = np.zeros(len(self.buffer) + 1, np.uint64)
        np.cumsum((self.buffer.astype(np.uint64) + np.uint64(1)) * up[:len(self.buffer)], out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.begin]) * down[self.begin])

    def __len__(self) -> int:
        return len(self.begin)

    def text_of(self) -> np.ndarray:
        """Of each word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def joined(self, text: int, keep: np.ndarray) -> bytes:
        """The kept words of a text with one space between; ``keep`` is over all words of the piece."""
        a, b = self.first[text], self.first[text + 1]
        raw = memoryview(self.buffer)
        return b" ".join(raw[s:e] for s, e in zip(self.begin[a:b][keep[a:b]].tolist(), self.end[a:b][keep[a:b]].tolist()))


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each ``n`` consecutive word hashes (over the ends of texts as well)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    up, down = _WORDS.get(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[:len(hashes) - n + 1])


def outside(chars: bytes) -> np.ndarray:
    """Word bytes: all but these."""
    table = np.ones(256, np.bool_)
    table[list(chars)] = False
    return table


#: All but ASCII white space.
NOT_SPACE = outside(SPACES)
#: Digits, a-z and all bytes of characters beyond ASCII.
LETTERS = np.zeros(256, np.bool_)
LETTERS[0x30:0x3A] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
