"""Personal data by a semi-Markov conditional random field over whole spans, beside fixed patterns.

Text near a digit or an at sign is cut into tokens; every run of up to
``MOST_TOKENS`` tokens is a candidate segment of each type, scored by features
of the whole span (shape, digit count, checksum, neighbours), and bounded-entity
dynamic programming chooses boundaries and types together. The weights maximise
the conditional likelihood of the fixed patterns' spans on a bounded sample of
texts. Text without digits and at signs holds no candidates and costs nothing.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tokens and characters of the longest candidate.
MOST_TOKENS, MOST_CHARS = 14, 64
#: Texts that the field is fitted on at most, the longest of them (characters), regions taken from them, and passes.
SAMPLE, LONGEST, REGIONS, PASSES = 1500, 20_000, 500, 6
#: Characters around a digit or at sign that may belong to the same candidate.
REACH = MOST_CHARS

KINDS = ["email", "ip", "card", "phone"]
# fixed patterns of the base scan; the look-behinds only skip starts at which a match cannot begin
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
TRIGGER = re.compile(r"[0-9@]+")
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s|.", re.DOTALL)

Span = tuple[int, int, int]  # start, number of the kind, end


def emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)  # the at sign itself belongs to no local part
        at = text.find("@", max(done, at + 1))
    return out


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def byte_parts(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def base_spans(text: str) -> list[Span]:
    out = emails(text)
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if byte_parts(m[0])]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(map(len, DIGITS.findall(m[0]))) <= 15]
    return sorted(out)


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of text that hold every candidate: chunks with a digit or at sign, those close to each other together."""
    start = end = -1
    for m in TRIGGER.finditer(text):
        if m.end() <= end:
            continue
        a, b = m.start(), m.end()
        while a > 0 and m.start() - a < REACH and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and b - m.end() < REACH and not text[b].isspace():
            b += 1
        if start >= 0 and a <= end + 2:
            end = max(end, b)
        else:
            if start >= 0:
                yield start, end
            start, end = a, b
    if start >= 0:
        yield start, end


def tokens(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [(m.start(), m.end()) for m in TOKEN.finditer(text, start, end)]


def features(text: str, start: int, end: int) -> list[str]:
    """Of a whole span; they do not depend on its type."""
    s = text[start:end]
    digits = "".join(DIGITS.findall(s))
    n, dots, groups = len(digits), s.count("."), len(DIGITS.findall(s))
    shape = re.sub(r"[^\W\d_]+", "a", DIGITS.sub("0", s))
    before, after = text[start - 1:start], text[end:end + 1]
    out = ["one", f"digits {n if n < 20 else 20}", f"groups {min(groups, 6)}", f"ats {min(s.count('@'), 2)}", f"dots {min(dots, 4)}",
           "first " + kind(s[0]), "last " + kind(s[-1]), "before " + kind(before), "after " + kind(after)]
    if len(shape) <= 24:
        out.append("shape " + shape)
    if 12 <= n <= 19 and not set(s) - set("0123456789 -"):
        out.append("checksum" if luhn(digits) else "no checksum")
    if dots == 3 and groups == 4 and n + 3 == len(s):
        out.append("bytes" if byte_parts(s) else "no bytes")
    if 9 <= n <= 15 and s[0] == "+":
        out.append("plus")
    if s.count("@") == 1 and dots:
        out.append("mail" if DOMAIN.fullmatch(s.split("@")[1]) else "no mail")
    return out


def kind(c: str) -> str:
    return "none" if not c else "digit" if c in "0123456789" else "letter" if c.isalpha() else "space" if c.isspace() else c if c.isascii() else "other"


def candidates(text: str, toks: list[tuple[int, int]]) -> list[list[tuple[int, list[str]]]]:
    """For each token, the (token after the last, features) of the candidates that begin there."""
    out: list[list[tuple[int, list[str]]]] = []
    for i, (start, _) in enumerate(toks):
        here = []
        if not text[start].isspace():
            seen = False
            for j in range(i, min(len(toks), i + MOST_TOKENS)):
                a, b = toks[j]
                if b - start > MOST_CHARS:
                    break
                seen = seen or text[a] in "0123456789@"
                if seen and (text[a].isalnum() or text[a] == "-") and b - start >= 6:
                    here.append((j + 1, features(text, start, b)))
        out.append(here)
    return out


Weights = dict[str, np.ndarray]
_NONE = np.zeros(len(KINDS))


def scores(found: list[list[tuple[int, list[str]]]], w: Weights) -> list[list[tuple[int, np.ndarray]]]:
    return [[(j, sum((w.get(f, _NONE) for f in fs), _NONE)) for j, fs in here] for here in found]


def decode(found: list[list[tuple[int, list[str]]]], w: Weights) -> list[tuple[int, int, int]]:
    """The best segmentation's (first token, kind, token after the last); tokens outside score 0."""
    n, scored = len(found), scores(found, w)
    best, back = [0.0] + [-math.inf] * n, [None] * (n + 1)
    for i, here in enumerate(scored):
        if best[i] > best[i + 1]:
            best[i + 1], back[i + 1] = best[i], None
        for j, s in here:
            k = int(s.argmax())
            if best[i] + s[k] > best[j]:
                best[j], back[j] = best[i] + float(s[k]), (i, k)
    out, at = [], n
    while at:
        if back[at] is None:
            at -= 1
        else:
            i, k = back[at]
            out.append((i, k, at))
            at = i
    return out[::-1]


def learn(examples: list[tuple[list[list[tuple[int, list[str]]]], set[tuple[int, int, int]]]], rate: float = 0.3) -> Weights:
    """Weights by stochastic ascent of the conditional log-likelihood, with forward and backward sums over segmentations."""
    w: Weights = {}
    order = list(range(len(examples)))
    rnd = random.Random(0)
    for turn in range(PASSES):
        rnd.shuffle(order)
        for e in order:
            found, gold = examples[e]
            n, scored = len(found), scores(found, w)
            total = [[(j, float(np.logaddexp.reduce(s))) for j, s in here] for here in scored]
            ahead, behind = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
            for i, here in enumerate(total):
                ahead[i + 1] = float(np.logaddexp(ahead[i + 1], ahead[i]))
                for j, s in here:
                    ahead[j] = float(np.logaddexp(ahead[j], ahead[i] + s))
            for i in range(n - 1, -1, -1):
                behind[i] = float(np.logaddexp.reduce([behind[i + 1], *(s + behind[j] for j, s in total[i])]))
            step = rate / (1 + turn)
            for i, here in enumerate(scored):
                for (j, s), (_, fs) in zip(here, found[i]):
                    p = np.exp(ahead[i] + s + behind[j] - ahead[n])
                    d = -p
                    for k in range(len(KINDS)):
                        d[k] += (i, k, j) in gold
                    if np.abs(d).max() > 1e-4:
                        for f in fs:
                            w[f] = w.get(f, _NONE) + step * (d - 1e-3 * w.get(f, _NONE))
    return w


def drawn(texts: list[str]) -> list[tuple[str, list[tuple[int, int]]]]:
    """At most REGIONS regions by text, in turns over the texts: of each the region with the least hash, then the next."""
    order = [sorted(regions(t), key=lambda r: (zlib.crc32(t[r[0]:r[1]].encode()), r)) for t in texts]
    took = [0] * len(texts)
    left, at = REGIONS, [i for i, here in enumerate(order) if here]
    while left and at:
        at = at[:left]
        for i in at:
            took[i] += 1
        left -= len(at)
        at = [i for i in at if took[i] < len(order[i])]
    return [(t, here[:n]) for t, here, n in zip(texts, order, took) if n]


def fit(docs: DataFrame, text: str = "text") -> Weights:
    """Weights from at most REGIONS regions, in turns over at most SAMPLE texts of up to LONGEST characters drawn by a hash of the text."""
    some = docs.select(F.col(f"`{text}`").alias("t")).where(F.length("t") <= LONGEST).where(F.col("t").rlike("[0-9@]")).distinct()
    rows = some.orderBy(F.xxhash64("t"), "t").limit(SAMPLE).collect()
    examples = []
    for t, here in drawn([r.t for r in rows]):
        base = base_spans(t)
        for a, b in here:
            toks = tokens(t, a, min(b, a + 400))
            first, after = {s: i for i, (s, _) in enumerate(toks)}, {e: i + 1 for i, (_, e) in enumerate(toks)}
            gold = {(first[s], k, after[e]) for s, k, e in base if s in first and e in after}
            found = candidates(t, toks)
            known = {(i, j) for i, from_i in enumerate(found) for j, _ in from_i}
            examples.append((found, {g for g in gold if (g[0], g[2]) in known}))
    return learn(examples)


def field_spans(text: str, w: Weights, base: list[Span]) -> list[Span]:
    """The field's spans that are clear of the base spans."""
    out = []
    for a, b in regions(text):
        toks = tokens(text, a, b)
        for i, k, j in decode(candidates(text, toks), w):
            s, e = toks[i][0], toks[j - 1][1]
            if not any(x < e and s < y for x, _, y in base):
                out.append((s, k, e))
    return out


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


RESULT = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
                      + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_added", T.LongType())])


def scan(text: str | None, w: Weights) -> tuple:
    text = text or ""
    base = base_spans(text) if TRIGGER.search(text) else []
    more = field_spans(text, w, base) if w else []
    return (*[sum(k == x for _, k, _ in base) for x in range(len(KINDS))], hashlib.sha256(written_out(base).encode()).hexdigest(),
            written_out(sorted(base + more)), len(more))


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", weights: Weights | None = None) -> DataFrame:
    """One row per document row: the key, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (kind:start:end,
    code points, end exclusive) and n_added (the field's spans clear of base ones).

    Null and empty texts have none. Whole texts are read; each row is judged by itself, repeated rows alike. A null key
    stays null; other columns are not read. Without texts to learn from, the field adds nothing."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, text) if weights is None else weights)
    schema = T.StructType([docs.select(F.col(f"`{key}`")).schema.fields[0], *RESULT.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            cols = list(zip(*[scan(t.as_py(), w) for t in batch.column(1)])) or [()] * len(RESULT)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=schema.names)

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)
