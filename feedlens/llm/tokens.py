"""Token ids of whole texts through the ``tokenizers`` library.

Both tokenizers split a text at fixed places (white space, and where letters
meet punctuation) before anything else, so the ids of a text are the ids of the
units in between one after the other. Each distinct
unit goes through the library once per worker and is kept as packed ids; a
text that could make this untrue (special-token strings, or rare kinds of white
space) goes through the library whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

MEMO_UNITS = 500_000   # kept per worker; beyond it the memo starts anew
MEMO_CHARS = 64        # longer units are encoded but not kept
_RARE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000<]")
# A unit is a run of Latin letters before white space or punctuation other than
# the apostrophe, such punctuation before white space, or a white-space unit as it
# stands; with the white space before it if the tokenizer keeps that.
_LETTERS = "[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]++"
_MARKS = "[!-&(-/:-@\\[-`{-~]"
_DROPS = re.compile(f"{_LETTERS}(?={_MARKS}|[ \t\r\n]|$)|{_MARKS}++(?=[ \t\r\n]|$)|[^ \t\r\n]++")
# of a text in Latin-1, in lower case, for a tokenizer that folds case and splits into
# letters, single digits, endings behind an apostrophe and other marks
_LATIN = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_FOLDED = re.compile(f"[{_LATIN}]++|'(?:s|t|re|ve|m|ll|d)|[{_DIGITS}]|[^ \t\r\n{_LATIN}{_DIGITS}]++")
_KEEPS = re.compile(f" {_LETTERS}(?={_MARKS}|[ \t\r\n]|$)|{_MARKS}++(?=[ \t\r\n]|$)"
                    "|[ \t\r\n]*+[^ \t\r\n]++|[ \t\r\n]++")


class Encoder:
    """Packed little-endian ids (``dtype``) of texts, without special tokens."""

    def __init__(self, path: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        size = self.lib.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.keeps = keeps_space
        self.units = _KEEPS.findall if keeps_space else self._dropping
        # plain units (letters only) follow each other in one call; the ids tell them
        # apart, as each begins (or ends) with an id that says so
        self.plain = re.compile(f"{' ' if keeps_space else ''}{_LETTERS}").fullmatch
        self.edge = np.zeros(size, bool)
        for token, i in self.lib.get_vocab().items():
            self.edge[i] = token.startswith("\u0120") if keeps_space else token.endswith("</w>")
        self.memo: dict[str, bytes] = {}

    @staticmethod
    def _dropping(text: str) -> list[str]:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return _DROPS.findall(text)
        return _FOLDED.findall(text.lower())

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: list[str]) -> None:
        plain = [u for u in units if self.plain(u)]
        for i in range(0, len(plain), 10_000):
            part = plain[i:i + 10_000]
            [e] = self.lib.encode_batch_fast([("" if self.keeps else " ").join(part)], add_special_tokens=False)
            ids = np.array(e.ids, self.dtype)
            cut = np.flatnonzero(self.edge[ids]) + (0 if self.keeps else 1)
            cut = [*cut.tolist(), len(ids)] if self.keeps else [0, *cut.tolist()]
            if len(cut) == len(part) + 1:
                packed, w = ids.tobytes(), self.dtype.itemsize
                self.memo.update(zip(part, [packed[a * w:b * w] for a, b in zip(cut, cut[1:])]))
        rest = [u for u in units if u not in self.memo]
        for i in range(0, len(rest), 10_000):
            self.memo.update(zip(rest[i:i + 10_000], self._library(rest[i:i + 10_000])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """One packed id string per text; null is the empty text."""
        if len(self.memo) > MEMO_UNITS:
            self.memo = {}
        memo, new = self.memo, set()
        split: list[list[str] | None] = []
        for t in texts:
            rare = t and _RARE.search(t)
            u = None if rare and (rare[0] != "<" or "<|" in t or _RARE.search(t.replace("<", ""))) else self.units(t or "")
            split.append(u)
            if u:
                new.update(set(u).difference(memo))
        self._learn(list(new))
        get = memo.__getitem__
        out = [self._library([t])[0] if u is None else b"".join(map(get, u)) for t, u in zip(texts, split)]
        for u in new:
            if len(u) > MEMO_CHARS:
                del memo[u]
        return out


@lru_cache(maxsize=4)
def encoder(path: str, keeps_space: bool) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return Encoder(path, keeps_space)


def text_batches(column, limit: int = 4 << 20):
    """(first, texts) runs of an Arrow text column of about ``limit`` characters."""
    run, first, size = [], 0, 0
    for i, t in enumerate(column.to_pylist()):
        run.append(t)
        size += len(t or "")
        if size >= limit:
            yield first, run
            run, first, size = [], i + 1, 0
    if run:
        yield first, run
