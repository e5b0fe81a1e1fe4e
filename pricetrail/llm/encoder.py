"""Whole texts to token ids with the tokenizers library, each distinct piece encoded once.

A byte-level tokenizer splits a text into words before it merges bytes, and a space before a word belongs
to the word. So a text cut before single spaces and single line breaks encodes to its pieces' ids
in a row. The library's merges see every distinct piece once; repeated ones come from a bounded
memory. Texts with other runs of white space, where the cut would change the ids, and pieces
that are not plain words go through the whole library.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache
from operator import attrgetter

import numpy as np
from tokenizers import Tokenizer

#: Pieces held in memory: so many newer ones and those of one batch, and as many older ones, dropped when those are full.
REMEMBERED = 600_000
ID = attrgetter("id")
HELD_MARKS = 20_000
SEPARATOR = "\n"
#: What may stand behind a word without changing its ids. An apostrophe is left out, as some letters join it.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_letters() -> dict[int, str]:
    """The printable letter a byte-level vocabulary writes for each byte: itself where it
    prints, else the next letter from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Memory(dict):
    """Pieces and their ids; one that is not there is taken from the older ones or made."""

    def __init__(self, make: Callable[[str], bytes | None], older: dict[str, bytes | None]) -> None:
        super().__init__()
        self.make, self.older = make, older

    def __missing__(self, piece: str) -> bytes | None:
        self[piece] = found = self.older[piece] if piece in self.older else self.make(piece)
        return found


class Encoder:
    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.merges = self.library.model
        self.letters = _byte_letters()
        self.gap = self.letters[ord(" ")]
        self.code, self.dtype = ("H", "<u2") if self.library.get_vocab_size() <= 1 << 16 else ("I", "<u4")
        self.known = _Memory(self._piece, {})
        self.marks: dict[str, bytes] = {"": b""}
        self.line = self._ids(SEPARATOR)

    def _ids(self, text: str) -> bytes:
        return self._packed(self.library.encode(text, add_special_tokens=False).ids)

    def _packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _word(self, word: str, space: str = " ") -> bytes:
        """Ids of a word of letters and the space before it, one unit to the library's merges."""
        if word.isascii():  # letters stand for themselves
            spelt = self.gap + word if space else word
        else:
            spelt = (space + word).encode().decode("latin-1").translate(self.letters)
        return array(self.code, list(map(ID, self.merges.tokenize(spelt)))).tobytes()

    def _tail(self, marks: str) -> bytes:
        """Ids of the marks behind a word, a unit of their own; the first HELD_MARKS short ones are held."""
        found = self.marks.get(marks)
        if found is None:
            found = self._ids(marks)
            if len(marks) <= 16 and len(self.marks) < HELD_MARKS:
                self.marks[marks] = found
        return found

    def _piece(self, piece: str) -> bytes | None:
        """Ids of a piece; None if white space in it could join with what stands beside it."""
        if piece.isalpha():
            return self._word(piece)
        stem = piece.rstrip(MARKS)
        marks = piece[len(stem) :]
        if stem.isalpha():
            return self.known[stem] + self._tail(marks)
        if stem.startswith(SEPARATOR) and stem[1:].isalpha():
            return self.line + self._word(stem[1:], "") + self._tail(marks)
        after_break = piece.startswith(SEPARATOR)
        body = piece[1:] if after_break else piece
        if not body or body != body.strip():
            return None
        return self._ids(piece if after_break else " " + piece)

    def _opening(self, piece: str) -> bytes:
        """Ids of the piece that a text begins with."""
        stem = piece.rstrip(MARKS)
        return self._word(stem, "") + self._tail(piece[len(stem) :]) if stem.isalpha() else self._ids(piece)

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.known) > REMEMBERED:
            self.known.older = {}
            self.known = _Memory(self._piece, self.known)
        of = self.known.__getitem__
        out = []
        for text in texts:
            pieces = text.replace(SEPARATOR, " " + SEPARATOR).split(" ")
            first = pieces[0]
            del pieces[0]
            try:
                later = b"".join(map(of, pieces))  # fails on a piece that is None
                splits = first == first.strip() and (first or not pieces)
            except TypeError:
                splits = False
            data = self._opening(first) + later if splits else self._ids(text)
            out.append(np.frombuffer(data, self.dtype))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and tokenizer file."""
    return Encoder(path)
