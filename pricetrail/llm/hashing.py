"""Hashes of the words of a text, made over whole byte arrays."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Longest run of bytes hashed in one go; a longer text is cut between words.
PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse modulo 2**64, to the powers 0 .. size."""
    up, down = np.ones(size + 1, np.uint64), np.ones(size + 1, np.uint64)
    up[1:], down[1:] = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_table(in_word: Callable[[int], bool]) -> np.ndarray:
    """Byte to its folded value, A-Z as a-z; 0 where a byte stands between words."""
    fold = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
    return np.array([fold[b] if in_word(b) else 0 for b in range(256)], np.uint8)


#: Words ended by ASCII white space.
SPACED = byte_table(lambda b: b != 0x20 and not 9 <= b <= 13)
#: Words of ASCII letters and digits and of anything beyond ASCII.
LETTERED = byte_table(lambda b: b >= 128 or chr(b).isalnum())


def _piece_hashes(folded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.concatenate(([False], folded != 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(max(PIECE, 1 << int(len(folded)).bit_length()))
    # A zero byte within a word would vanish from the sum, so values are taken plus one.
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((folded.astype(np.uint64) + np.uint64(1)) * up[: len(folded)])))
    return mix((sums[ends] - sums[starts]) * down[starts]), ends - starts


def word_hashes(data: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and byte length of every word of UTF-8 ``data``, in order."""
    folded = table[np.frombuffer(data, np.uint8)]
    if len(folded) <= PIECE:
        return _piece_hashes(folded)
    parts, at = [], 0
    while at < len(folded):
        to = min(at + PIECE, len(folded))
        if to < len(folded):
            gaps = np.flatnonzero(folded[at:to] == 0)
            if len(gaps):
                to = at + int(gaps[-1]) + 1
            else:
                later = np.flatnonzero(folded[to:] == 0)
                to = to + int(later[0]) + 1 if len(later) else len(folded)
        parts.append(_piece_hashes(folded[at:to]))
        at = to
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` words in a row, in order; of all words where they are fewer."""
    if not len(words):
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    found = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        found = mix(found * np.uint64(BASE) + words[i : i + len(found)] + np.uint64(i))
    return mix(found + np.uint64(size))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` words in a row; of all words where they are fewer."""
    return np.unique(runs(words, size))
