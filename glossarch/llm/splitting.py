"""Problem 3: cutting oversized texts at natural boundaries, with overlap.

The runs of blanks of a text are its possible cuts, and each has a rank: before a heading by the heading's depth, then between paragraphs, before a
list item by its indentation, between lines, sentences, words. The cuts of the strongest rank within a node make its children, so that the ranks
give a tree: nested sections, paragraphs, nested items, lines, sentences, words. Nodes that fit are never opened; neighbouring subtrees are merged bottom-up while they fit together; only
oversized nodes are descended into. What an opened section leaves over is not merged with its siblings. A single word beyond the limit is cut between characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 1000, 100
#: kinds of boundary, strongest first; an index into it is the class of a run of blanks
KINDS = ["paragraph", "line", "sentence", "word"]

# Words that begin a heading when a number follows, by the depth of the section.
HEADING_WORDS = {
    "part": 1, "title": 1, "annex": 1, "appendix": 1, "chapter": 2, "section": 3, "article": 4, "item": 4,
    "teil": 1, "titel": 1, "anhang": 1, "kapitel": 2, "abschnitt": 3, "artikel": 4,
    "partie": 1, "titre": 1, "annexe": 1, "chapitre": 2,
    "parte": 1, "título": 1, "anexo": 1, "capítulo": 2, "sección": 3, "artículo": 4,
}
_BLANKS = re.compile(r"[ \t\r\n]+")
_HASHES = re.compile(r"#{1,6}(?= )|<h([1-6])\b", re.IGNORECASE)
_NUMBERED = re.compile(r"(\d+(?:\.\d+)*)\.? \S[^\r\n]{0,78}[^.;:,\s][ \t\r]*(?:\n|$)")
_WORDED = re.compile(rf"({'|'.join(HEADING_WORDS)})\s+[\divxlc]+\b[^\r\n]{{0,80}}(?:[\r\n]|$)", re.IGNORECASE)
_TITLE = re.compile(r"[^\W\d_][^\r\n]{0,78}[^.;:,!?\s](?=[ \t\r]*\n[ \t\r]*\n)")
_ITEM = re.compile(r"(?:[-*•·–]|\(?[a-z\d]{1,3}[.)]|\([ivx]+\)|<li\b)[ \t]")
#: depths of headings and of items; a plain line between paragraphs is the least of headings
DEPTHS, TITLE, INDENTS = 7, 6, 4
PARAGRAPH = DEPTHS
ITEM = PARAGRAPH + 1
LINE, SENTENCE, WORD = (ITEM + INDENTS + i for i in range(3))

Span = tuple[int, int]


def runs_of_blanks(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, class)`` of every run of space, tab, CR and LF."""
    out = []
    for m in _BLANKS.finditer(text):
        lines = m.group().count("\n")
        kind = 0 if lines > 1 else 1 if lines else 2 if m.start() and text[m.start() - 1] in ".!?" else 3
        out.append((m.start(), m.end(), kind))
    return out


def heading(text: str, at: int, after_paragraph: bool) -> int | None:
    """The depth, from 0, of the heading that starts at ``at``."""
    if m := _HASHES.match(text, at):
        return int(m[1] or len(m[0])) - 1
    if m := _WORDED.match(text, at):
        return HEADING_WORDS[m[1].lower()] - 1
    m = _NUMBERED.match(text, at)
    if m and (after_paragraph or "." in m[1]):
        return min(m[1].count("."), TITLE - 1)
    return TITLE if after_paragraph and _TITLE.match(text, at) else None


class Tree:
    """The cuts of a text with their kinds and ranks. Cuts at the edges of the text part nothing."""

    def __init__(self, text: str):
        self.end = len(text)
        self.cuts = runs_of_blanks(text)
        self.kinds = [kind for _, _, kind in self.cuts]
        self.ranks = []
        first = self.cuts[0][1] if self.cuts and not self.cuts[0][0] else 0
        titled = heading(text, first, True) is not None
        for cut in self.cuts:
            rank = self._rank(text, *cut)
            if titled and cut[0] and cut[2] < 2:  # the end of a heading, which stays with the words below it
                titled, rank = False, rank if rank < DEPTHS else WORD
            titled = titled or rank < DEPTHS
            self.ranks.append(rank)

    @staticmethod
    def _rank(text: str, start: int, end: int, kind: int) -> int:
        if kind > 1:
            return SENTENCE if kind == 2 else WORD
        depth = heading(text, end, kind == 0)
        if depth is not None:
            return depth
        if _ITEM.match(text, end) and kind == 1:
            return ITEM + min((end - 1 - text.rfind("\n", start, end)) // 2, INDENTS - 1)
        return PARAGRAPH if kind == 0 else LINE

    def children(self, ranks: list[int], lo: int, hi: int, node: Span) -> Iterator[tuple[int, int, Span]]:
        """The parts of a node at the strongest of its cuts ``lo`` to ``hi``, each with its own cuts."""
        top, first, at = min(ranks[lo:hi]), lo, node[0]
        for k in range(lo, hi):
            if ranks[k] == top:
                yield first, k, (at, self.cuts[k][0])
                first, at = k + 1, self.cuts[k][1]
        yield first, hi, (at, node[1])

    def boundary(self, limit: int) -> str:
        """The first kind at which cutting leaves no stretch above ``limit``, or ``none``: the weakest that oversized nodes are opened by,
        as kinds alone rank the cuts."""

        def weakest(lo: int, hi: int, node: Span) -> int:
            if node[1] - node[0] <= limit:
                return 0
            if lo == hi:
                return len(KINDS)
            return max(min(self.kinds[lo:hi]), *(weakest(*child) for child in self.children(self.kinds, lo, hi, node)))

        return [*KINDS, "none"][weakest(0, len(self.cuts), (0, self.end))]

    def pack(self, room: int) -> list[Span]:
        """Spans of at most ``room`` that cover the text but for the blanks between them."""

        def packed(lo: int, hi: int, node: Span) -> list[Span]:
            start, end = node
            if end - start <= room:
                return [node] if end > start else []
            if lo == hi:
                return [(i, min(end, i + room)) for i in range(start, end, room)]
            sections, merged, closed = min(self.ranks[lo:hi]) < DEPTHS, [], True
            for child in self.children(self.ranks, lo, hi, node):
                opened = sections and child[2][1] - child[2][0] > room
                for i, u in enumerate(packed(*child)):
                    if not closed and not (opened and i == 0) and u[1] - merged[-1][0] <= room:
                        merged[-1] = (merged[-1][0], u[1])
                    else:
                        merged.append(u)
                        closed = False
                closed = closed or opened
            return merged

        return packed(0, len(self.cuts), (0, self.end))


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP, tree: Tree | None = None) -> list[tuple[int, int, int]]:
    """``(start, fresh, end)`` of the pieces in order; ``text[start:fresh]`` repeats the end of the piece before.

    No piece is longer than ``limit``; the repeated part has at most ``overlap`` characters and starts at a word
    where there is one. Every character that is not a blank at a cut is in the fresh part of exactly one piece.
    A text of blanks only has one empty piece.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below limit")
    tree = tree or Tree(text)
    runs = tree.cuts
    out, before, r = [], 0, 0
    for start, end in tree.pack(limit - overlap):
        while r < len(runs) and runs[r][1] <= start:
            r += 1
        if not out or not overlap:
            out.append((start, start, end))
        else:
            # the blanks at the cut count as repeated characters; the first word start in the window is preferred
            begin, k, word = max(before, start - overlap), r - 1, None
            while k >= 0 and runs[k][1] >= begin:
                word = runs[k][1] if runs[k][1] < start else word
                k -= 1
            out.append((begin if word is None else word, start, end))
        before = out[-1][1]
    return out or [(0, 0, 0)]


def _oversized(df: DataFrame, key: str, text: str, limit: int) -> DataFrame:
    return df.select(F.col(key).alias("id"), F.col(text).alias("__t")).filter(F.length("__t") > limit)


def split_oversized(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """``id, piece, boundary, begin, fresh, piece_text`` for the texts of more than ``limit`` characters.

    ``piece`` counts from 1, ``begin`` and ``fresh`` are character offsets (0-based) of the piece and of its first
    character that is not repeated, ``boundary`` is the kind of cut the text as a whole needs. Null, empty and
    shorter texts have no rows; a text of blanks only has one, empty piece. No exchange; texts are worked on one by one.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, t in zip(batch["id"], batch["__t"]):
                tree = Tree(t)
                kind = tree.boundary(limit)
                rows = [(name, n, kind, b, f, t[b:e]) for n, (b, f, e) in enumerate(pieces(t, limit, overlap, tree), 1)]
                yield pd.DataFrame(rows, columns=["id", "piece", "boundary", "begin", "fresh", "piece_text"])

    rows = _oversized(df, key, text, limit)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(run, f"id {kind}, piece int, boundary string, begin bigint, fresh bigint, piece_text string")
