"""Encoding whole texts with a public tokenizer file inside Spark tasks.

A text is cut where no match of the tokenizer's pattern can reach across: before white space
that follows other characters, and between letters and the punctuation after them. The ids of
a text are those of its pieces one after the other, so pieces are remembered and looked up.
"""

from __future__ import annotations

import functools
import json
import os
import re
import string
import struct
from operator import itemgetter

import numpy as np

#: The characters with Unicode's White_Space property.
_SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: White space with the run of other characters after it.
_PIECE = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: Python takes these as white space, the tokenizers do not.
_CONTROL = "\x1c\x1d\x1e\x1f"
#: Blanks that are not single ones between other characters, and line ends next to other white space.
_RUN = re.compile(r" \s|\s |\n\s|\s\n")
#: Longest piece that is remembered, in characters.
_LONGEST = 64


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, else the next free one."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Pieces(dict):
    """Ids (uint32, as bytes) of pieces that come after ``before``; unknown ones are encoded.

    Two generations: when this one is full it becomes the older one and a new one begins, into
    which pieces that are met again come back. So frequent pieces are never forgotten.
    """

    def __init__(self, owner: Encoder, before: str):
        super().__init__()
        self._owner, self._before, self._older = owner, before, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self._older.get(piece)
        if ids is None:
            ids = self._owner.encode_piece(self._before, piece)
        if len(piece) <= _LONGEST:
            if len(self) >= self._owner.remember:
                self._older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def _found(known: _Pieces, pieces: list[str]) -> bytes:
    """The ids of all pieces, looked up in one call."""
    if len(pieces) < 2:
        return known[pieces[0]] if pieces else b""
    return b"".join(itemgetter(*pieces)(known))


class Encoder:
    """Turns texts into ids; remembers the ids of short pieces.

    The memory only saves time: it has two generations of ``remember`` pieces each.
    """

    def __init__(self, path: str, remember: int = 300_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        # Both kinds of file map bytes to letters; one of them also drops white space and case.
        self._folds = rules["normalizer"] is not None
        self._model = self._tokenizer.model
        self._letters = _byte_letters()
        self.remember = remember
        self._bare, self._spaced = _Pieces(self, ""), _Pieces(self, " ")

    def _whole(self, text: str) -> bytes:
        found = self._tokenizer.encode(text, add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def encode_piece(self, before: str, piece: str) -> bytes:
        own = self._spaced if before else self._bare
        if piece[:1] == "\n" and not self._folds:
            # No blank stands before a line end; nothing but the line end may stand before the word.
            word = piece[1:]
            if word and not word[0].isspace():
                return self._bare["\n"] + self._bare[word]
            return self._whole(piece)
        if not piece.isalpha():
            word = piece.rstrip(string.punctuation)
            # Some letters become a letter and a mark in lower case, which would join the punctuation.
            if len(word) < len(piece) and word.isalpha() and (word.isascii() or word.lower().isalpha()):
                return own[word] + self._bare[piece[len(word) :]]
        elif piece.isascii() or max(piece) < "Ā":
            # One run of letters: the model may be asked without the steps before it.
            if self._folds:
                lower = piece.lower()
                if lower != piece:
                    return own[lower]
            elif before:
                piece = before + piece
            shown = piece if piece.isalpha() and piece.isascii() else "".join(map(self._letters.get, piece.encode()))
            ids = [t.id for t in self._model.tokenize(shown)]
            return struct.pack(f"<{len(ids)}I", *ids)
        return self._whole(before + piece)

    def encode(self, text: str | None, end_id: int | None = None) -> np.ndarray:
        """The ids of the whole text (null counts as empty), then ``end_id`` if given."""
        text = text or ""
        control = any(c in text for c in _CONTROL)
        if self._folds and not control:
            joined = _found(self._bare, text.split())
        elif not self._folds and not control and not _RUN.search(text):
            # A line end goes with the word after it, so that words of two lines are no piece of their own.
            first, *rest = text.replace("\n", " \n").split(" ")
            joined = self._bare[first] + _found(self._spaced, rest)
        else:
            joined = _found(self._bare, _PIECE.findall(text))
        ids = np.frombuffer(joined, "<u4")
        return ids if end_id is None else np.append(ids, np.uint32(end_id)).astype("<u4")


@functools.cache
def encoder(path: str, remember: int = 300_000) -> Encoder:
    """One per Python worker and tokenizer file."""
    return Encoder(path, remember)
