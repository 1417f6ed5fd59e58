"""Problem 6: long stretches that occur word for word in other documents, by compact windows.

A text is seen as the sequence of hashes of its runs of ``GRAM`` words. The Cartesian tree of that sequence gives each place c the widest
interval [l, r] around it in which its hash is the smallest; the window (l, c, r) stands for all subsequences within [l, r] that
contain c, as their min-hash lies there, and every subsequence belongs to exactly one window. A stretch of at least ``LEAST`` words has
the same place of the smallest hash in every text that holds it: windows with equal keys are the only candidates, and none is missed.
As these stretches are equal and not merely alike, one hash function is enough; candidates are verified by the hashes of the
``LEAST``-word runs their windows stand for. ``alike_passages`` takes as many hash functions as asked for and joins the intervals of the windows, so
that passages that are only nearly the same meet as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarch.llm.shingles import WordHashes, mixed, runs, words_of
from glossarch.plans.scratch import written

LEAST, GRAM = 25, 13


def cartesian(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the first and last place of its subtree in the Cartesian tree of its text: the widest interval in which its
    hash is the smallest (of equal ones the leftmost). All nearest smaller values, by pointers that jump over what is known to be greater."""
    n = len(h)
    at = np.arange(n)
    begin = np.searchsorted(owner, owner, "left")
    end = np.searchsorted(owner, owner, "right")
    left, right = at - 1, at + 1  # nearest smaller places; begin - 1 and end where there is none
    live = np.flatnonzero(left >= begin)
    while len(live := live[(left[live] >= begin[live])]):
        live = live[h[left[live]] > h[live]]
        left[live] = left[left[live]]
    live = np.flatnonzero(right < end)
    while len(live := live[(right[live] < end[live])]):
        live = live[h[right[live]] >= h[live]]
        right[live] = right[right[live]]
    return left + 1, right - 1


def compact_windows(h: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows ``(l, c, r)`` at least ``width`` wide."""
    l, r = cartesian(h, owner)
    c = np.flatnonzero(r - l + 1 >= width)
    return l[c], c, r[c]


class _Batch:
    """The hashes of one batch of texts."""

    def __init__(self, texts: list[str | None], known: WordHashes, least: int):
        self.gram = least // 2 + 1
        words, self.counts = words_of(texts, known)
        self.h, self.owner, self.place = runs(words, self.counts, self.gram)
        self.first = np.concatenate([[0], np.cumsum(np.maximum(self.counts - self.gram + 1, 0))])

    def full(self, at: np.ndarray, least: int) -> np.ndarray:
        """Hash of the run of ``least`` words that starts with the gram ``at``."""
        return mixed(self.h[at], self.h[at + least - self.gram])


def _windows(records: DataFrame, least: int) -> DataFrame:
    """``rid, doc_hash, window`` (hash at the window's place) of every compact window, once per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                b = _Batch(part.column("text").to_pylist(), known, least)
                _, places, _ = compact_windows(b.h, b.owner, least - b.gram + 1)
                take = pa.array(b.owner[places])
                yield pa.RecordBatch.from_arrays([part.column("rid").take(take), part.column("doc_hash").take(take), pa.array(b.h[places].astype(np.int64))], ["rid", "doc_hash", "window"])

    return records.select("rid", "doc_hash", "text").mapInArrow(run, "rid string, doc_hash bigint, window bigint")


def _covered(records: DataFrame, least: int) -> DataFrame:
    """``rid, doc_hash, words, run, start, before`` of the runs of ``least`` words that the windows ``windows`` of each record stand for. ``before`` is
    the run that starts a word earlier, null at the start of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                b = _Batch(part.column("text").to_pylist(), known, least)
                gap = least - b.gram
                l, c, r = compact_windows(b.h, b.owner, gap + 1)
                shared = [np.array(w, np.int64).astype(np.uint64) for w in part.column("windows").to_pylist()]
                edges = np.searchsorted(b.owner[c], np.arange(part.num_rows + 1))
                hit = np.concatenate([np.empty(0, bool), *(np.isin(b.h[c[lo:hi]], keys) for lo, hi, keys in zip(edges, edges[1:], shared))])
                # runs of grams [s, s + gap] within [l, r] that contain c; a run belongs to one window
                first, last = np.maximum(l, c - gap)[hit], np.minimum(c, r - gap)[hit]
                n = last - first + 1
                s = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                who = b.owner[s]
                start = s - b.first[who]
                inner = start > 0
                before = np.zeros(len(s), np.uint64)
                before[inner] = b.full(s[inner] - 1, least)
                take = pa.array(who)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rid").take(take), part.column("doc_hash").take(take), pa.array(b.counts[who]), pa.array(b.full(s, least).astype(np.int64)), pa.array(start)]
                    + [pa.array(before.astype(np.int64), mask=~inner)],
                    ["rid", "doc_hash", "words", "run", "start", "before"],
                )

    return records.select("rid", "doc_hash", "text", "windows").mapInArrow(run, "rid string, doc_hash bigint, words bigint, run bigint, start bigint, before bigint")


def _documents(df: DataFrame, key: str, *more) -> DataFrame:
    """Keys that occur in several documents. A key is counted by its smallest and greatest document, which tasks combine before the exchange."""
    return df.groupBy(key).agg(F.min("doc_hash").alias("lo"), F.max("doc_hash").alias("hi"), *more).filter("lo <> hi").drop("lo", "hi")


def shared_runs(records: DataFrame, least: int = LEAST) -> DataFrame:
    """``rid, doc_hash, words, run, start, first``: every run of ``least`` words that occurs in a record of another document.

    ``records`` has ``rid`` (unique), ``doc`` and ``text``; a null ``doc`` is a document of its own, null and short texts give
    nothing. ``words`` is the number of words of the record, ``run`` a 64-bit hash of the words, ``start`` the place of its first word. ``first`` is
    false for a run that follows one and the same run wherever it occurs: records that share it share that one, too.
    """
    records = records.select("rid", F.xxhash64("doc").alias("doc_hash"), "text")
    windows = written(_windows(records, least), "windows")
    met = windows.select("rid", "window").join(_documents(windows, "window"), "window", "left_semi")
    # one entry per distinct window of a text
    some = met.groupBy("rid").agg(F.collect_set("window").alias("windows"))
    found = written(_covered(records.join(some, "rid"), least), "runs")
    first = (F.count("before") < F.count(F.lit(1))) | (F.min("before") < F.max("before"))
    return found.join(_documents(found, "run", first.alias("first")), "run").select("rid", "doc_hash", "words", "run", "start", "first")


def sharing_pairs(shared: DataFrame) -> DataFrame:
    """``a, b``: each pair of records of different documents that have a run in common, once in either order of documents.

    Of a stretch only the first run of those that have all their partners in common is met. Runs meet by document first, so that the many records of one
    document that hold a run are not compared with each other.
    """
    rows = written(shared.filter("first").select("rid", "doc_hash", "run"), "shared").distinct()
    docs = rows.select("run", "doc_hash").distinct()
    met = docs.join(docs.withColumnRenamed("doc_hash", "other"), "run").filter("doc_hash < other")
    a = met.join(rows.withColumnRenamed("rid", "a"), ["run", "doc_hash"])
    b = rows.select("run", F.col("doc_hash").alias("other"), F.col("rid").alias("b"))
    return a.join(b, ["run", "other"]).select("a", "b").distinct()


def stretches(shared: DataFrame, least: int = LEAST) -> DataFrame:
    """``rid, words, stretches, shared_words, share``: the stretches (first and last word, from 0) of each record that are covered by runs
    occurring elsewhere, the words in them, and their part of all words. Records that share nothing have no row."""
    rows = shared.groupBy("rid", "words").agg(F.array_sort(F.collect_set("start")).alias("starts"))
    span = "array<struct<first:bigint,last:bigint>>"

    def add(done, s):
        last = F.element_at(done, -1)
        new = F.array(F.struct(s.alias("first"), (s + least - 1).alias("last")))
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["first"].alias("first"), (s + least - 1).alias("last"))))
        return F.when((F.size(done) > 0) & (s <= F.try_element_at(done, F.lit(-1))["last"] + 1), longer).otherwise(F.concat(done, new)).cast(span)

    rows = rows.select("rid", "words", F.aggregate("starts", F.array().cast(span), add).alias("stretches"))
    covered = F.aggregate("stretches", F.lit(0).cast("bigint"), lambda s, x: s + x["last"] - x["first"] + 1)
    return rows.withColumn("shared_words", covered).withColumn("share", F.round(F.col("shared_words") / F.col("words"), 6))


# -- passages that are nearly the same -----------------------------------------------------------------------------------------------------

#: words of a shingle, hash functions, and how many of them must agree for a passage to be a candidate
SHINGLE, HASHES, AGREE = 5, 8, 3
ALIKE = Fraction(8, 10)


def _hashed_windows(records: DataFrame, least: int, shingle: int, hashes: int) -> DataFrame:
    """``key, rid, doc_hash, fn, l, c, r``: the windows of each record by each hash function."""
    names = ["key", "rid", "doc_hash", "fn", "l", "c", "r"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                h, owner, place = runs(*words_of(part.column("text").to_pylist(), known), shingle)
                for fn in range(hashes):
                    each = mixed(h, fn + 1)
                    l, c, r = compact_windows(each, owner, least - shingle + 1)
                    take, start = pa.array(owner[c]), c - place[c]
                    cols = [pa.array(mixed(each[c], fn).astype(np.int64)), part.column("rid").take(take), part.column("doc_hash").take(take), pa.array(np.full(len(c), fn, np.int32))]
                    yield pa.RecordBatch.from_arrays(cols + [pa.array((x - start).astype(np.int32)) for x in (l, c, r)], names)

    return records.select("rid", "doc_hash", "text").mapInArrow(run, "key bigint, rid string, doc_hash bigint, fn int, l int, c int, r int")


def _meeting(pair: pd.DataFrame, agree: int, shingle: int, least: int) -> list[tuple]:
    """Passages (first and last word in either record) in which at least ``agree`` hash functions have their smallest hash in common, at least ``least`` words long.

    Each collision is an anchor: the collisions whose intervals hold its place in both records, and whose places its own intervals hold, have
    the intersection of their intervals in common. Of passages within others the wider ones stay.
    """
    x = {n: pair[n].to_numpy() for n in ("fn", "la", "ca", "ra", "lb", "cb", "rb")}
    found = []
    for i in range(len(pair)):
        s = np.flatnonzero(
            (x["la"] <= x["ca"][i]) & (x["ca"][i] <= x["ra"]) & (x["lb"] <= x["cb"][i]) & (x["cb"][i] <= x["rb"])
            & (x["la"][i] <= x["ca"]) & (x["ca"] <= x["ra"][i]) & (x["lb"][i] <= x["cb"]) & (x["cb"] <= x["rb"][i])
        )
        while len(np.unique(x["fn"][s])) >= agree:
            span = x["la"][s].max(), x["ra"][s].min(), x["lb"][s].max(), x["rb"][s].min()
            out = (x["ca"][s] < span[0]) | (x["ca"][s] > span[1]) | (x["cb"][s] < span[2]) | (x["cb"][s] > span[3])
            if not out.any() and min(span[1] - span[0], span[3] - span[2]) + shingle >= least:
                found.append((int(span[0]), int(span[1]) + shingle - 1, int(span[2]), int(span[3]) + shingle - 1))
                break
            # the narrowest interval excludes most: go on without it, but keep the anchor
            width = np.minimum(x["ra"][s] - x["la"][s], x["rb"][s] - x["lb"][s]) + (s == i) * (1 << 30)
            s = np.delete(s, width.argmin())
    found = sorted(set(found), key=lambda p: (p[0] - p[1], p))
    kept: list[tuple] = []
    for p in found:
        if not any(q[0] <= p[0] and p[1] <= q[1] and q[2] <= p[2] and p[3] <= q[3] for q in kept):
            kept.append(p)
    return kept


def alike_passages(records: DataFrame, least: int = LEAST, similarity: Fraction = ALIKE, shingle: int = SHINGLE, hashes: int = HASHES, agree: int = AGREE) -> DataFrame:
    """``a, b, first_a, last_a, first_b, last_b, similarity``: passages (places of words, from 0) of at least ``least`` words of records of different documents
    (``doc_hash`` of ``a`` smaller) whose shingles of ``shingle`` words are alike to at least ``similarity``.

    ``records`` as in ``shared_runs``. A candidate needs ``agree`` of ``hashes`` hash functions to agree: at a similarity of 0.8 three of eight do for 99.9 % of
    all passages. Candidates are verified on their words. Null and short texts and passages of one document have no row.
    """
    records = written(records.select("rid", F.xxhash64("doc").alias("doc_hash"), "text"), "records")
    windows = written(_hashed_windows(records, least, shingle, hashes), "windows")
    some = windows.join(_documents(windows, "key"), "key", "left_semi")
    a, b = (some.select("key", "doc_hash", *(F.col(c).alias(c + side) for c in ("rid", "l", "c", "r")), *(["fn"] if side == "a" else [])) for side in "ab")
    met = a.join(b.withColumnRenamed("doc_hash", "other"), "key").filter("doc_hash < other")
    # of two intervals around one smallest hash, what both can hold of it must be wide enough
    met = met.filter((F.least(F.col("ra") - F.col("la"), F.col("rb") - F.col("lb")) + 1) >= least - shingle + 1)

    def passages(pair: pd.DataFrame) -> pd.DataFrame:
        rows = [(pair["rida"].iloc[0], pair["ridb"].iloc[0], *p) for p in _meeting(pair, agree, shingle, least)]
        return pd.DataFrame(rows, columns=["a", "b", "first_a", "last_a", "first_b", "last_b"])

    spans = "a string, b string, first_a int, last_a int, first_b int, last_b int"
    found = met.groupBy("rida", "ridb").applyInPandas(passages, spans)
    for side in "ab":
        found = found.join(records.select(F.col("rid").alias(side), F.col("text").alias(f"text_{side}")), side)

    def verified(row, known: WordHashes) -> tuple | None:
        sides = []
        for text, lo, hi in ((row.text_a, row.first_a, row.last_a), (row.text_b, row.first_b, row.last_b)):
            words, _ = words_of([text], known)
            sides.append((lo, runs(words[lo : hi + 1], np.array([hi + 1 - lo]), shingle)[0]))
        (fa, a), (fb, b) = sides
        # what lies beyond the first and last shingle in common is no part of the passage
        shared = np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a))
        if not len(shared[0]):
            return None
        (la, ra), (lb, rb) = ((x[0], x[-1]) for x in shared)
        one, two = set(a[la : ra + 1].tolist()), set(b[lb : rb + 1].tolist())
        both = len(one & two)
        if min(ra - la, rb - lb) + shingle < least or similarity.denominator * both < similarity.numerator * len(one | two):
            return None
        return row.a, row.b, int(fa + la), int(fa + ra) + shingle - 1, int(fb + lb), int(fb + rb) + shingle - 1, both / len(one | two)

    order = ["a", "b", "first_a", "last_a", "first_b", "last_b"]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            out = [v for row in batch.itertuples(index=False) if (v := verified(row, known))]
            yield pd.DataFrame(out, columns=[*order, "similarity"])

    return found.select(*order, "text_a", "text_b").mapInPandas(verify, f"{spans}, similarity double").distinct()
