"""Cutting cleaned text into overlapping windows of words under a token budget."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossarch.operators.cleaning import NOT_S, S

# Tokens of a window and of the overlap, and the forms of a number a chunk may start with.
SIZE, OVERLAP = 100, 20
START_NUMBER = r"\p{Nd}+[a-zA-Z]?\)?\.?"

#: what counts as one token in the stand-in for a tokenizer
WORD_COST = r"[A-Za-z0-9]+|[^A-Za-z0-9]"


def words(text: Column) -> Column:
    """The words of a text, split at any white space."""
    return F.filter(F.split(text, f"{S}+"), lambda w: w != "")


def word_cost(word: Column) -> Column:
    """Stand-in for a sub-word tokenizer: one per run of ASCII letters and digits, one per other character."""
    return F.size(F.regexp_extract_all(word, F.lit(WORD_COST), F.lit(0)))


def wordy(word: Column) -> Column:
    return word.rlike("[A-Za-z0-9]")


def start_valid(word: Column) -> Column:
    """Whether a chunk may start with the word: after leading symbols, a letter or a bare number with an optional list mark."""
    bare = F.regexp_replace(word, r"^[^\p{L}\p{N}_]+", "")
    return bare.rlike(f"^{START_NUMBER}$") | bare.rlike(r"^\p{L}")


_COST = re.compile(WORD_COST)
_WORDY = re.compile("[A-Za-z0-9]")
_SYMBOLS = re.compile(r"^[^\w]+")
_NUMBER = re.compile(START_NUMBER.replace(r"\p{Nd}", r"\d"))


def default_cost(word: str) -> int:
    return len(_COST.findall(word))


class _Facts(dict):
    """What is known of a word: cost, wordiness, and whether a chunk may start with it."""

    def __init__(self, cost: Callable[[str], int], room: int = 200_000):
        super().__init__()
        self.cost, self.room = cost, room

    def __missing__(self, word: str) -> tuple[int, bool, bool]:
        bare = _SYMBOLS.sub("", word)
        facts = self.cost(word), bool(_WORDY.search(word)), bool(_NUMBER.fullmatch(bare)) or bare[:1].isalpha()
        if len(self) < self.room:
            self[word] = facts
        return facts


def spans(tokens: list[str], facts: _Facts, size: int = SIZE, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Windows ``[first, end)`` of words.

    A window takes words while their cost stays within ``size`` (a dearer single word stands alone). A window that starts
    with an invalid word is dropped whole; one that ends no later than the last is not emitted. The next
    window starts at the shortest suffix that costs at least ``overlap``, or behind the window if there is none
    shorter than it.
    """
    known = [facts[w] for w in tokens]
    n, at, reached, out = len(tokens), 0, -1, []
    while True:
        while at < n and not known[at][1]:
            at += 1
        if at >= n:
            return out
        spent, end = 0, at
        while end < n and spent + known[end][0] <= size:
            spent += known[end][0]
            end += 1
        end = max(end, at + 1)
        if not known[at][2] or end <= reached:
            at = end
            continue
        out.append((at, end))
        reached = end
        back, kept = end, 0
        while back > at and kept < overlap:
            back -= 1
            kept += known[back][0]
        at = back if overlap > 0 and kept >= overlap and back > at else end


_SPLIT = re.compile(r"\s+")


def chunked(df: DataFrame, key: str, text: str, size: int = SIZE, overlap: int = OVERLAP, cost: Callable[[str], int] = default_cost) -> DataFrame:
    """``doc, seq, id, first, last, cost, chunk``: the chunks of each text, ``seq`` from 1, ``id = doc_seq``.

    ``first`` and ``last`` are places of words, from 0. Texts without a chunk (null, empty, no valid start) have no row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        facts = _Facts(cost)
        for batch in batches:
            rows = []
            for doc, t in zip(batch["doc"], batch["text"]):
                if t is None or not isinstance(t, str):
                    continue
                tokens = t.split()
                for seq, (a, b) in enumerate(spans(tokens, facts, size, overlap), 1):
                    rows.append((doc, seq, f"{doc}_{seq}", a, b - 1, sum(facts[w][0] for w in tokens[a:b]), " ".join(tokens[a:b])))
            yield pd.DataFrame(rows, columns=["doc", "seq", "id", "first", "last", "cost", "chunk"])

    rows = df.select(F.col(key).cast("string").alias("doc"), F.col(text).alias("text")).filter("text is not null and doc is not null")
    return rows.mapInPandas(run, "doc string, seq int, id string, first int, last int, cost int, chunk string")


# Fixed value: place of an id without a number at its end.
NO_SUFFIX = 1_000_000_000


def id_suffix(c: Column) -> Column:
    """The number at the end of an id, after an underscore; ids without one, or with one beyond 64 bits, come last."""
    digits = F.regexp_extract(c, "_([0-9]+)$", 1)
    return F.coalesce(digits.try_cast("bigint"), F.lit(NO_SUFFIX).cast("bigint"))
