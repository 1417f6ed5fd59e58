"""Hashes of words and of runs of words, for whole batches at a time."""

from __future__ import annotations

import re

import numpy as np
import xxhash

_BLANKS = re.compile(r"[ \t\r\n]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(29)


class WordHashes(dict):
    """64-bit hashes of words; ``room`` bounds what is remembered, not what is hashed."""

    def __init__(self, room: int = 400_000):
        super().__init__()
        self.room = room

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= self.room:
            self.clear()
        self[word] = h
        return h


def mixed(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """A hash of ordered pairs of hashes."""
    x = (a ^ (a >> _SHIFT)) * _SPREAD + np.asarray(b, np.uint64)
    x = (x ^ (x >> _SHIFT)) * _ODD
    return x ^ (x >> np.uint64(32))


def words_of(texts: list[str | None], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in one array, and the number of words of each text (0 for null)."""
    flat: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    look = known.__getitem__
    for i, t in enumerate(texts):
        if t:
            words = _BLANKS.split(t)
            if not words[0]:
                del words[0]
            if words and not words[-1]:
                del words[-1]
            flat.extend(map(look, words))
            counts[i] = len(words)
    return np.array(flat, np.uint64), counts


def runs(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, the text each belongs to, and its first word's place in that text."""
    n = np.maximum(counts - size + 1, 0)
    owner = np.repeat(np.arange(len(counts)), n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    start = np.repeat(np.cumsum(counts) - counts, n) + place
    h = words[start] if len(start) else np.empty(0, np.uint64)
    for i in range(1, size):
        h = mixed(h, words[start + i])
    return (mixed(h, size), owner, place)
