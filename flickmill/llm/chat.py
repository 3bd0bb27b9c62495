"""Chat formatting: where each turn stands in a rendered conversation, from a template that is a black box.

The template renders successive prefixes of the conversation. If each output
begins with the one before, the rest is the turn's span; if not, the template
rewrites history and the conversation is marked so. Where a turn's text stands in
its span is found the same way: two renderings in which the last turn's text is
another single letter differ at that letter alone.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flickmill.llm.batches import with_columns

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

_TURN = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<]|\\.)*)</turn>\n", re.S)


def escape(text: str, also: str = "") -> str:
    return re.sub(rf"([\\#<{also}])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def hashes_template(turns: list[Turn]) -> str:
    """``### role: text</turn>`` and a line end for each turn; backslashes, # and < are escaped, in roles : as well."""
    return "".join(f"### {escape(role, ':')}: {escape(text)}</turn>\n" for role, text in turns)


def read_back(formatted: str) -> list[Turn]:
    """The turns that ``hashes_template`` was given."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def spans(turns: list[Turn], template: Template) -> tuple[str, list[tuple[int, int, int, int]], bool]:
    """The rendered conversation; of each turn its span's and its text's begin and end; whether history was rewritten.

    A turn by which earlier output changes has the span from the first difference on and no text (begin = end).
    """
    before, out, rewritten = template([]) if not turns else "", [], False
    for i, (role, _) in enumerate(turns):
        now = template(turns[:i + 1])
        if now.startswith(before):
            one, two = (template(turns[:i] + [(role, x)]) for x in "ab")
            head = len(os.path.commonprefix([one, two]))
            tail = len(one) - head - 1
            out.append((len(before), len(now), head, max(head, len(now) - tail)))
        else:
            rewritten = True
            at = len(os.path.commonprefix([before, now]))
            out = [s if s[1] <= at else (min(s[0], at), min(s[1], at), at, at) for s in out]
            out.append((at, len(now), len(now), len(now)))
        before = now
    return before, out, rewritten


RESULT = {"formatted": T.StringType(), "rewritten": T.BooleanType(),
          "turn_spans": T.ArrayType(T.ArrayType(T.LongType())), "loss_spans": T.ArrayType(T.ArrayType(T.LongType()))}


def formatted(rows: DataFrame, template: Template = hashes_template, learn: str = "assistant", conv: str = "conv_id", turn: str = "turn",
              role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its id, formatted, rewritten, turn_spans and loss_spans (code points, end exclusive).

    ``rows`` has a row per turn; null roles and texts are empty, a null turn comes first, turns of one number are
    ordered by role and text, repeated rows are turns each, and rows of a null id are one conversation. Other columns
    are not read. loss_spans are where the texts of role ``learn`` stand. A conversation is one row of the result,
    so its turns meet in one task, as that row must.
    """
    c = rows.select(F.col(f"`{conv}`").alias(conv), F.struct(F.col(f"`{turn}`").alias("n"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("r"),
                                                             F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")).alias("turn_row"))
    whole = c.groupBy(conv).agg(F.sort_array(F.collect_list("turn_row")).alias("turns"))
    whole = whole.select(conv, F.transform("turns", lambda x: F.array(x["r"], x["t"])).alias("turns"), F.lit("").alias("_piece"))

    def render(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        made = [(t, *spans(t, template)) for t in ([tuple(x) for x in c] for c in piece.column(piece.schema.get_field_index("turns")).to_pylist())]
        loss = [[[s[2], s[3]] for (r, _), s in zip(t, found) if r == learn and s[3] > s[2]] for t, _, found, _ in made]
        pairs = pa.list_(pa.list_(pa.int64()))
        return {"formatted": pa.array([m[1] for m in made], pa.string()), "rewritten": pa.array([m[3] for m in made], pa.bool_()),
                "turn_spans": pa.array([[[a, b] for a, b, _, _ in m[2]] for m in made], pairs), "loss_spans": pa.array(loss, pairs)}

    return with_columns(whole, render, RESULT, [conv], "_piece", extra=["turns"])


DIGEST = {"n_turns": T.LongType(), "turns_sha256": T.StringType(), "loss_chars": T.LongType(), "loss_sha256": T.StringType(), "formatted_chars": T.LongType()}


def digest(made: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What ``formatted`` with ``hashes_template`` has made, read back from its output."""
    def read(piece: pa.RecordBatch) -> dict[str, pa.Array]:
        cols: list[tuple] = []
        for text, loss in zip(piece.column(piece.schema.get_field_index("formatted")).to_pylist(), piece.column(piece.schema.get_field_index("loss_spans")).to_pylist()):
            turns = read_back(text)
            learnt = "".join(unescape(text[a:b]) for a, b in loss)
            cols.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt), len(text)))
        return {c: pa.array([x[i] for x in cols], pa.string() if "sha" in c else pa.int64()) for i, c in enumerate(DIGEST)}

    return with_columns(made, read, DIGEST, [conv, "rewritten"], "formatted", extra=["loss_spans"])


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
