"""Token ids of whole texts, with the ids of words kept between texts of a task.

A space between two other characters always begins a token, so a text is cut
there and each piece (with its space) is tokenized once and then looked up.
Pieces of Latin letters go through ``tiktoken``, all others through
``tokenizers``; both files hold one vocabulary and the tests compare the ids.
The strings of special tokens in a text are ordinary text, unless asked otherwise:
then a text that holds one is encoded whole, as the tokenizer does by default.
"""

from __future__ import annotations

import array
import base64
import re

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: Pieces whose ids a task keeps, and the characters of the longest of them.
KEPT = 400_000
KEPT_CHARS = 40

_ODD = re.compile(r"\s | \s|\A | \Z")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_LATIN = re.compile("[\x00-ɏ]*")


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def default_ranks() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Ids(dict):
    """Little-endian unsigned 32-bit ids of texts. ``self[piece]``: those of a space and the piece."""

    def __init__(self, path: str, ranks: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> bytes:
        if _LATIN.fullmatch(text):
            return array.array("I", self.fast.encode_ordinary(text)).tobytes()
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(" " + piece)
        if len(piece) <= KEPT_CHARS and len(self) < KEPT:
            self[piece] = ids
        return ids

    def of(self, text: str | None, special: bool = False) -> bytes:
        """The ids of a text; null is empty. With ``special``, the strings of special tokens are those tokens."""
        if not text:
            return b""
        if special and any(s in text for s in self.special):
            self.tokenizer.encode_special_tokens = False
            try:
                return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            finally:
                self.tokenizer.encode_special_tokens = True
        first, *rest = _CUT.split(text) if _ODD.search(text) else text.split(" ")
        return self.encode(first) + b"".join(map(self.__getitem__, rest))


_OPEN: dict[tuple[str, str], Ids] = {}


def ids_of(path: str, ranks: str) -> Ids:
    """One for each worker process, so that later tasks find what earlier ones have looked up."""
    if (path, ranks) not in _OPEN:
        _OPEN[path, ranks] = Ids(path, ranks)
    return _OPEN[path, ranks]
