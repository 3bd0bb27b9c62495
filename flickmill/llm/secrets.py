"""Secret scan: fixed patterns, and a battery of randomness tests for strings that no pattern names.

A candidate is a long run of token characters whose encoding (hex, base 32, 36,
62 or 64) can be inferred. Three tests ask whether its symbols could be drawn
evenly from that alphabet: chi-squared uniformity, runs about the middle and
lag-one serial correlation. Candidates of a text for which that is refuted,
under a Benjamini-Hochberg control weighted by length, are ordinary text; the
rest are reported as ``random``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Shortest candidate (below it the tests tell little), and the false-discovery rate of calling one ordinary.
SHORTEST, RATE = 20, 0.05

# fixed patterns of the base scan
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ["assign", "access", "hex", "random"]

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % SHORTEST)
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = [_DIGITS + "abcdef", _DIGITS + "ABCDEF", _UPPER + "234567", _DIGITS + _LOWER, _DIGITS + _UPPER, _UPPER + _LOWER + _DIGITS,
             _UPPER + _LOWER + _DIGITS + "+/", _UPPER + _LOWER + _DIGITS + "-_"]
_PLACES = [{c: i for i, c in enumerate(a)} for a in ALPHABETS]

Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str) -> list[Span]:
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def encoding(token: str) -> dict[str, int] | None:
    """The smallest alphabet that holds the token; none without digits and letters, or without both cases in a mixed one."""
    used = set(token)
    if used.isdisjoint(_DIGITS) or used.isdisjoint(_LOWER + _UPPER):
        return None
    for places in _PLACES:
        if used <= places.keys():
            mixed = len(places) >= 62
            return None if mixed and (used.isdisjoint(_LOWER) or used.isdisjoint(_UPPER)) else places
    return None


def upper_tail(x: float, df: int) -> float:
    """Of the chi-squared distribution, by Wilson and Hilferty's cube root."""
    v = 2 / (9 * df)
    return 0.5 * math.erfc(((x / df) ** (1 / 3) - 1 + v) / math.sqrt(2 * v))


def p_even(token: str, places: dict[str, int]) -> float:
    """Probability of a battery as extreme as the token's if its symbols are drawn evenly (three tests, Bonferroni)."""
    x = [places[c] for c in token]
    n, size = len(x), len(places)
    groups = max(2, min(size, n // 5, 16))
    counts = [0] * groups
    for v in x:
        counts[v * groups // size] += 1
    share = [(-(-(g + 1) * size // groups) - -(-g * size // groups)) / size for g in range(groups)]
    chi = upper_tail(sum((c - n * s) ** 2 / (n * s) for c, s in zip(counts, share)), groups - 1)
    high = [v >= size // 2 for v in x]
    a = sum(high)
    b = n - a
    if not a or not b:
        return 0.0
    runs = 1 + sum(p != q for p, q in zip(high, high[1:]))
    mean = 1 + 2 * a * b / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    run = math.erfc(abs(runs - mean) / math.sqrt(2 * var)) if var > 0 else 1.0
    m = sum(x) / n
    around = sum((v - m) ** 2 for v in x)
    r = sum((p - m) * (q - m) for p, q in zip(x, x[1:])) / around if around else 1.0
    serial = math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2))
    return min(1.0, 3 * min(chi, run, serial))


def random_spans(text: str, base: list[Span]) -> list[Span]:
    """Candidates clear of the base spans that the battery does not call ordinary."""
    found = []
    for m in CANDIDATE.finditer(text):
        if (places := encoding(m[0])) is not None and not any(s < m.end() and m.start() < e for s, _, e in base):
            found.append((p_even(m[0], places), m.start(), m.end()))
    if not found:
        return []
    # weighted Benjamini-Hochberg: longer strings, of which the tests tell more, get more of the rate
    total = sum(e - s for _, s, e in found) / len(found)
    ranked = sorted((p * total / (e - s), s, e) for p, s, e in found)
    ordinary = max((i + 1 for i, (p, _, _) in enumerate(ranked) if p <= RATE * (i + 1) / len(ranked)), default=0)
    return sorted((s, 3, e) for _, s, e in ranked[ordinary:])


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


RESULT = T.StructType([T.StructField(c, T.LongType()) for c in ("n_assign", "n_access", "n_hex")]
                      + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_random", T.LongType())])


def scan(text: str | None) -> tuple:
    text = text or ""
    base = base_spans(text)
    more = random_spans(text, base)
    n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
    return (*n, hashlib.sha256(written_out(base).encode()).hexdigest(), written_out(sorted(base + more)), len(more))


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: the key, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, code points,
    end exclusive) and n_random. Spans of a base kind are the whole match.

    Null and empty texts have none. Whole texts are read; each row is judged by itself, repeated rows alike. A null key
    stays null; other columns are not read."""
    schema = T.StructType([docs.select(F.col(f"`{key}`")).schema.fields[0], *RESULT.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(zip(*[scan(t.as_py()) for t in batch.column(1)])) or [()] * len(RESULT)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=schema.names)

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)
