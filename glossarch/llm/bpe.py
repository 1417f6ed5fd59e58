"""Problem 7: encoding with a public byte-level vocabulary, and its inverse.

The merge of one piece keeps its symbols in a doubly linked list and the possible merges in a priority queue by
rank; entries that no longer fit the list are skipped. So a piece of n bytes costs O(n log n), however long.
Pieces repeat, so each worker remembers the ids of those it has met (a bounded memory).
"""

from __future__ import annotations

import base64
import heapq
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: where the vocabulary files lie, unless a path is given
VOCABULARIES = os.environ.get("GLOSSARCH_VOCABULARIES", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"

# Fixed value: how the vocabulary's publisher splits text before the merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the white space of that pattern.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


class Encoder:
    """Ids of texts by a rank file (one ``base64 rank`` line per token)."""

    def __init__(self, path: str, room: int = 200_000):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.strings = {r: t for t, r in self.ranks.items()}
        # Every piece of SPLIT lies within one word of this coarser split (a word with at most one space before it).
        self.words = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self.pieces = regex.compile(SPLIT.replace(r"\s", SPACE).replace(f"(?!\\S)|{SPACE}+", "").replace(f"{SPACE}+", f"[{SPACE}]+").replace(r"\S", f"[^{SPACE}]"))
        self.known = _Known(self, room)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: merges by rank, leftmost first among equals."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        n = len(piece)
        part = [piece[i : i + 1] for i in range(n)]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, size = heapq.heappop(queue)
            j = after[i]
            if not part[i] or j >= n or len(part[i]) + len(part[j]) != size:
                continue  # stale: one of the two was merged since
            part[i] += part[j]
            part[j] = b""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(part[i] + part[k])) is not None:
                    heapq.heappush(queue, (r, i, len(part[i]) + len(part[k])))
            if (h := before[i]) >= 0 and (r := ranks.get(part[h] + part[i])) is not None:
                heapq.heappush(queue, (r, h, len(part[h]) + len(part[i])))
        return [ranks[p] for p in part if p]

    def word(self, word: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(self.merge(p.encode("utf-8", "replace")) for p in self.pieces.findall(word)))

    def encode(self, text: str | None) -> list[int]:
        """Null and empty texts give an empty list; strings of special tokens are plain text."""
        return list(chain.from_iterable(map(self.known.__getitem__, self.words.findall(text)))) if text else []

    def count(self, text: str | None) -> int:
        return sum(map(len, map(self.known.__getitem__, self.words.findall(text)))) if text else 0

    def decode(self, ids) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


class _Known(dict):
    def __init__(self, encoder: Encoder, room: int):
        super().__init__()
        self.encoder, self.room = encoder, room

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.encoder.word(word)
        if len(word) < 64:
            if len(self) >= self.room:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary(path: str | None = None) -> str:
    return path or os.path.join(VOCABULARIES, VOCABULARY)


def encoded(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """``key, ids`` for every row, ``ids`` an array of int; null and empty texts give an empty array. No exchange."""
    path = vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = encoder(path).encode
        for batch in batches:
            texts, at = batch.column(1), 0
            while at < len(texts):  # few rows at a time: long texts make long lists
                part = texts.slice(at, 256).to_pylist()
                lists = [write(t) for t in part]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                flat = np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1]))
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256), ids], ["key", "ids"])
                at += 256

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {rows.schema[0].dataType.simpleString()}, ids array<int>")


def token_counts(df: DataFrame, text: str, path: str | None = None, *keep: str) -> DataFrame:
    """Columns ``keep`` and ``tokens`` (bigint), the number of ids of ``text``; 0 for null and empty texts. No exchange."""
    path = vocabulary(path)
    fields = [f for f in df.select(*keep).schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder(path).count
        for batch in batches:
            n = pa.array([count(t) for t in batch.column("__text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), n], [*(f.name for f in fields), "tokens"])

    rows = df.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return rows.mapInArrow(run, f"{schema}, tokens bigint")
