"""Hybrid retrieval: BM25 and dense scores, each scaled over all candidates of a query, weighted, stable top-k.

Two candidate sets: the earlier passages of the same document (a self join on the document), and an external corpus
(a stated query set against all rows, which tasks read in strips).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossarch.operators.vectors import l2_normalise
from glossarch.plans.scratch import written

# Parameters of BM25, and the weights of the two scores.
K1, B = 1.5, 0.75
DENSE, SPARSE = 0.6, 0.4


def tokens(text: Column) -> Column:
    """Lower-cased runs of a-z and 0-9; anything else separates, accented letters too."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def term_frequency(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """``key..., term, tf``."""
    rows = df.select(*key, F.explode(tokens(F.col(text))).alias("term"))
    return rows.groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(tf: DataFrame) -> DataFrame:
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_stats(df: DataFrame, text: str) -> DataFrame:
    """``n, avg_len, max_len`` over the texts; null texts count as empty."""
    n = F.size(tokens(F.coalesce(F.col(text), F.lit(""))))
    return df.select(n.alias("len")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("len"), 6).alias("avg_len"), F.max("len").cast("bigint").alias("max_len"))


def idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def saturation(tf: Column, length: Column, mean: Column, k1: float = K1, b: float = B) -> Column:
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))


# -- earlier passages of the same document -------------------------------------------------------------------


def prefix_df(postings: DataFrame) -> DataFrame:
    """``doc, seq, term, df``: in how many earlier passages of its document a passage's term occurs. Linear in the postings."""
    order = Window.partitionBy("doc", "term").orderBy("seq")
    return postings.select("doc", "seq", "term", (F.row_number().over(order) - 1).cast("bigint").alias("df"))


#: passages of a block of queries and of a strip of history (a multiple of it), and blocks of queries that meet a strip in one task
QUERY_BLOCK, STRIP, BLOCKS = 256, 2048, 16

_SCORED = "doc string, seq bigint, hist bigint, dense double, bm25 double, score double, dense_min double, dense_max double, bm25_min double, bm25_max double"
_LIMITS = ["dense_min", "dense_max", "bm25_min", "bm25_max"]


def _numbered(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of an array of lists of strings: the list and the number of each string, and the strings by number."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    coded = lists.flatten().dictionary_encode()
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(lists)), size), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _places(of: pa.Array, among: pa.Array) -> np.ndarray:
    """Where each string of ``of`` is in ``among``, -1 where it is not."""
    return pc.fill_null(pc.index_in(of, value_set=among), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _by_size(vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By size the vectors without nulls: their places and a matrix."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat, start = vectors.flatten(), np.cumsum(size) - size
    holes = np.add.reduceat(np.append(flat.is_null().to_numpy(zero_copy_only=False), 0), start) * (size > 0) if flat.null_count else np.zeros(len(size))
    numbers = flat.to_numpy(zero_copy_only=False).astype(float)
    usable = (size > 0) & (holes == 0)
    return {int(n): (at, numbers[start[at][:, None] + np.arange(n)]) for n in np.unique(size[usable]) if len(at := np.flatnonzero(usable & (size == n)))}


class _Strip:
    """Candidates that one task holds: a strip of the history of a document, or of a corpus. Rows have ``tokens, v`` and are in the order of ties."""

    def __init__(self, rows: pa.Table):
        self.size = rows.num_rows
        owner, term, self.terms = _numbered(rows["tokens"])
        self.lengths = np.bincount(owner, minlength=self.size).astype(float)
        key, self.tf = np.unique(term * self.size + owner, return_counts=True)  # by term, then by passage
        self.passage, self.tf = key % max(self.size, 1), self.tf.astype(float)
        self.first = np.searchsorted(key, np.arange(len(self.terms) + 1) * self.size)
        self.vectors = _by_size(rows["v"])

    def norm(self, mean: float) -> np.ndarray:
        """What the length of each candidate adds to the frequency of a term."""
        return K1 * (1 - B) + self.lengths * (K1 * B / mean)


@dataclass
class _Queries:
    """A block of queries: number and mean length of each one's candidates, its vector, and who asks for which term with what document frequency."""

    n: np.ndarray
    mean: np.ndarray
    v: pa.Array
    asker: np.ndarray
    asked: np.ndarray
    terms: pa.Array
    df: np.ndarray


def _scores(strip: _Strip, q: _Queries) -> tuple[np.ndarray, np.ndarray]:
    """Dense score and BM25 of each query (rows) and candidate (columns)."""
    # the postings of each term that a query asks for
    at = _places(q.terms, strip.terms)[q.asked] if len(q.asked) else q.asked
    use = (at >= 0) & (q.mean[q.asker] > 0)
    at, asker, df = at[use], q.asker[use], q.df[use]
    weight = np.log(1 + np.maximum(q.n[asker] - df + 0.5, 0.5) / (df + 0.5)) * (K1 + 1)
    shape = len(q.n), strip.size
    sparse = np.zeros(shape)
    first, count = strip.first[at], strip.first[at + 1] - strip.first[at]
    ends = np.searchsorted(asker, np.arange(shape[0] + 1))
    for i in range(shape[0]):  # one query after the other: its postings fit in the cache
        lo, hi = ends[i], ends[i + 1]
        if lo == hi:
            continue
        n = count[lo:hi]
        entry = np.repeat(first[lo:hi] - np.cumsum(n) + n, n) + np.arange(n.sum())
        passage, tf = strip.passage[entry], strip.tf[entry]
        part = np.repeat(weight[lo:hi], n) * tf / (tf + strip.norm(q.mean[i])[passage])
        sparse[i] = np.bincount(passage, part, minlength=shape[1])
    dense = np.zeros(shape)
    for k, (places, m) in _by_size(q.v).items():
        if k in strip.vectors:
            dense[np.ix_(places, strip.vectors[k][0])] = m @ strip.vectors[k][1].T
    return dense, sparse


def _weighted(d: np.ndarray, s: np.ndarray, weights: tuple[float, float], limits: np.ndarray | None) -> np.ndarray:
    """The weighted sum of both scores, scaled by the limits of each query (in the order of ``_LIMITS``) where given; 0 where all are equal."""
    if limits is not None:
        span = np.where(limits[1::2] > limits[::2], limits[1::2] - limits[::2], np.inf)
        d, s = (d - limits[0][:, None]) / span[0][:, None], (s - limits[2][:, None]) / span[1][:, None]
    return weights[0] * d + weights[1] * s


def _best(exact: np.ndarray, among: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Query and candidate of the k best of each query's candidates ``among``; equal scores (to 9 digits) keep the order of the candidates."""
    score, out = np.round(exact, 9), [(np.empty(0, np.int64),) * 2]
    for i in range(len(score)):
        at = np.flatnonzero(among[i])
        if len(at) > k:
            at = at[score[i, at] >= np.partition(score[i, at], len(at) - k)[len(at) - k]]
        at = at[np.lexsort((at, -score[i, at]))][:k]
        out.append((np.full(len(at), i), at))
    i, j = (np.concatenate(c).astype(np.int64) for c in zip(*out))
    return i, j


def _history_queries(block: dict) -> tuple[np.ndarray, _Queries]:
    """The passages of a block in order. Statistics of a passage's history are those before its block, which the block brings along, and those of
    the earlier passages of the block."""
    q = pa.Table.from_batches([pa.RecordBatch.from_struct_array(block["q"])]).sort_by("seq").combine_chunks()
    seq = q["seq"].to_numpy()
    owner, held, terms = _numbered(q["tokens"])
    asker, asked, asked_terms = _numbered(q["asked"])
    size = np.bincount(owner, minlength=len(seq))
    n = block["n"] + np.arange(len(seq))
    mean = (block["length"] + np.cumsum(size) - size) / np.maximum(n, 1)
    # earlier passages that hold the term
    each = np.unique(held * len(seq) + owner)
    here = _places(asked_terms, terms)[asked]
    within = np.searchsorted(each, here * len(seq) + asker) - np.searchsorted(each, here * len(seq))
    known = _places(asked_terms, block["terms"].field("term"))
    before = np.append(block["terms"].field("df").to_numpy(zero_copy_only=False), 0)[known]
    df = before[asked] + np.where(here >= 0, within, 0)
    return seq, _Queries(n, mean, q["v"], asker, asked, asked_terms, df)


def history_topk(passages: DataFrame, k: int, text: str = "text", vector: str | None = "emb", history_text: str | None = None, history_vector: str | None = None, dense: float = DENSE, sparse: float = SPARSE, scale: bool = True, gap: int = 0) -> DataFrame:
    """``doc, seq, hist, dense, bm25, score, place``: for each passage the ``k`` best of the earlier ones of its document.

    ``passages`` has ``doc, seq``, texts and vectors; (doc, seq) is unique. ``score`` is the weighted sum of both scores, each scaled over all earlier passages of the
    document (unscaled if not ``scale``); of equal scores (to 9 digits) the earlier passage. Only candidates more than ``gap`` before the passage are chosen. Vectors are compared as they are
    (cosine only if normalised); a pair without comparable vectors has dense score 0, a passage without earlier ones has no row.

    Queries come in blocks, history in strips of a document; a task scores the blocks that meet one strip as matrices, and no pair leaves it. Where the whole history of a
    block is one strip, its best are known at once; for longer documents strips first give the limits of the scores, then the best by these. Nothing is sorted
    or gathered by document: numbers, lengths and term frequencies of the history before a block are running sums over blocks.
    """
    empty, none = F.lit(""), F.lit(None).cast("array<double>")
    v, hv = (F.col(c).cast("array<double>") if c else none for c in (vector, history_vector or vector))
    rows = passages.select(
        F.col("doc").cast("string").alias("doc"), F.col("seq").cast("bigint").alias("seq"),
        F.array_distinct(tokens(F.coalesce(F.col(text), empty))).alias("asked"), tokens(F.coalesce(F.col(history_text or text), empty)).alias("tokens"), v.alias("v"), hv.alias("hv"),
    )
    # no document is apart from the others, so a null name is as good as any
    rows = rows.withColumn("block", F.floor(F.col("seq") / QUERY_BLOCK)).withColumn("doc", F.coalesce("doc", F.lit("")))
    rows = written(rows.withColumn("strip", F.floor(F.col("block") * QUERY_BLOCK / STRIP)), "history")
    sums = rows.groupBy("doc", "block", "strip").agg(F.count("seq").alias("n"), F.sum(F.size("tokens")).alias("length"))
    by_block = Window.partitionBy("doc").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({c: F.coalesce(F.sum(c).over(by_block), F.lit(0)) for c in ("n", "length")})
    # passages of earlier blocks that hold a term
    held = rows.select("doc", "block", F.explode(F.array_distinct("tokens")).alias("term"), F.lit(1).alias("held"), F.lit(0).alias("asked"))
    asked = rows.select("doc", "block", F.explode("asked").alias("term"), F.lit(0).alias("held"), F.lit(1).alias("asked"))
    by_term = Window.partitionBy("doc", "term").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    known = held.unionByName(asked).groupBy("doc", "block", "term").agg(F.sum("held").alias("held"), F.max("asked").alias("asked"))
    known = known.withColumn("df", F.sum("held").over(by_term)).filter("asked = 1 and df > 0")
    terms = known.groupBy("doc", "block").agg(F.collect_list(F.struct("term", "df")).alias("terms"))
    blocks = rows.groupBy("doc", "block").agg(F.collect_list(F.struct("seq", "asked", "tokens", "v")).alias("q"))
    blocks = blocks.join(sums, ["doc", "block"]).join(terms, ["doc", "block"], "left")
    salts = sums.groupBy("doc").agg((F.floor(F.max("block") / BLOCKS) + 1).alias("salts"))
    history = rows.select("doc", "strip", "seq", "tokens", F.col("hv").alias("v")).join(salts, "doc")
    history = history.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)))
    history = history.select(F.col("doc").alias("of"), F.col("strip").alias("part"), F.col("salt").alias("copy"), F.col("seq").alias("seq"), F.col("tokens").alias("tokens"), F.col("v").alias("v"))
    blocks = blocks.join(salts, "doc").select("doc", "block", "n", "length", "q", "terms", (F.col("block") % F.col("salts")).alias("salt"), F.col("strip").alias("last"))
    weights = dense, sparse

    def met(strips: pa.Table, asked: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in _SCORED.split(", ")]
        out = [pa.RecordBatch.from_arrays([pa.array([], f) for f in (pa.string(), pa.int64(), pa.int64(), *[pa.float64()] * 7)], names)]
        if not strips.num_rows or not asked.num_rows or k <= 0:
            return pa.Table.from_batches(out)
        strips = strips.sort_by("seq").combine_chunks()
        strip, hist, doc = _Strip(strips), strips["seq"].to_numpy(), strips["of"][0].as_py()
        no_terms = pa.array([], pa.struct([("term", pa.string()), ("df", pa.int64())]))
        for row in range(asked.num_rows):
            get = {c: asked[c][row] for c in asked.column_names}
            block = {"q": get["q"].values, "n": get["n"].as_py(), "length": get["length"].as_py(), "terms": get["terms"].values if get["terms"].is_valid else no_terms}
            seq, queries = _history_queries(block)
            early = hist[None, :] < seq[:, None]
            some = np.flatnonzero(early.any(1))
            if not len(some):
                continue
            d, s = (x[some] for x in _scores(strip, queries))
            seq, early = seq[some], early[some]
            limits = None
            if scale and "limits" in get:
                given = get["limits"].values
                order = np.searchsorted(given.field("seq").to_numpy(), seq)
                limits = np.stack([given.field(c).to_numpy()[order] for c in _LIMITS])
            elif scale:
                limits = np.stack([f(np.where(early, x, e), axis=1) for x in (d, s) for f, e in ((np.min, np.inf), (np.max, -np.inf))])
                if get["last"].as_py() > 0:  # there are more strips
                    none, number = pa.nulls(len(seq), pa.float64()), pa.nulls(len(seq), pa.int64())
                    out.append(pa.RecordBatch.from_arrays([pa.array([doc] * len(seq), pa.string()), pa.array(seq), number, none, none, none, *map(pa.array, limits)], names))
                    continue
            exact = _weighted(d, s, weights, limits)
            i, j = _best(exact, early & (hist[None, :] < seq[:, None] - gap), k)
            none = pa.nulls(len(i), pa.float64())
            columns = [pa.array([doc] * len(i), pa.string()), pa.array(seq[i]), pa.array(hist[j]), *(pa.array(x[i, j]) for x in (d, s, exact))]
            out.append(pa.RecordBatch.from_arrays(columns + [none] * 4, names))
        return pa.Table.from_batches(out)

    def scored(queries: DataFrame) -> DataFrame:
        spread = queries.withColumn("strip", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))))
        return history.groupBy("of", "part", "copy").cogroup(spread.groupBy("doc", "strip", "salt")).applyInArrow(met, _SCORED)

    found = scored(blocks)
    if scale:
        found = written(found, "scored")
        limits = found.filter("hist is null").groupBy("doc", "seq").agg(*((F.min if c.endswith("min") else F.max)(c).alias(c) for c in _LIMITS))
        limits = limits.groupBy("doc", F.floor(F.col("seq") / QUERY_BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("seq", *_LIMITS))).alias("limits"))
        found = found.filter("hist is not null").unionByName(scored(blocks.filter("last > 0").join(limits, ["doc", "block"])))
    return topk(found.select("doc", "seq", "hist", "dense", "bm25", "score"), ["doc", "seq"], "score", "hist", k)


def topk(scored: DataFrame, query: list[str], score: str, order: str, k: int) -> DataFrame:
    """The k best per query with their ``place``; equal scores (to 9 digits) keep the order of the candidates."""
    over = Window.partitionBy(*query).orderBy(F.round(score, 9).desc(), F.col(order))
    return scored.withColumn("place", F.row_number().over(over)).filter(F.col("place") <= k)


def without_local(best: DataFrame, before: int = 1) -> DataFrame:
    """Drops candidates that are local neighbours already - after the choice of the best, without refilling."""
    return best.filter(F.col("pos") - F.col("hist_pos") > before)


# -- an external corpus ------------------------------------------------------------------------------------------------

#: queries one task holds at most, terms of a corpus that are scored as a matrix and the share of its rows that holds each, and parts of a corpus by which queries leave some out
GROUP, FREQUENT, SHARE, CELLS = 16384, 384, 0.04, 128


def _pieces(files: list[str], rows: int) -> Iterator[pa.Table]:
    """The rows of parquet files, always in the same pieces of ``rows`` rows (the last has less)."""
    held, n = [], 0
    for uri in files:
        system, path = fs.FileSystem.from_uri(uri)
        with system.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=rows, use_threads=False):
                held, n = [*held, batch], n + batch.num_rows
                if n >= rows:
                    table = pa.Table.from_batches(held)
                    yield table.slice(0, rows)
                    held, n = table.slice(rows).to_batches(), n - rows
    if n:
        yield pa.Table.from_batches(held)


def _rows(vectors: pa.Array, size: int) -> np.ndarray:
    """A matrix of the vectors, zeros for unusable ones."""
    out = np.zeros((len(vectors), size))
    if size in (usable := _by_size(vectors)):
        at, m = usable[size]
        out[at] = m
    return out


class _Part:
    """A strip of a corpus: frequent terms as a matrix, the others by term. All queries have the same candidates, so what a term adds but for its idf is known."""

    def __init__(self, rows: pa.Table, mean: float, frequent: pa.Array, size: int):
        rows = rows.sort_by("id").combine_chunks()
        strip, self.ids, self.v = _Strip(rows), rows["id"].combine_chunks(), _rows(rows["v"], size)
        self.size, self.first, self.passage, self.terms = strip.size, strip.first, strip.passage, strip.terms
        self.adds = strip.tf / (strip.tf + strip.norm(mean)[strip.passage]) if mean else np.zeros(len(strip.tf))
        column = np.repeat(_places(strip.terms, frequent), np.diff(strip.first))
        self.often = np.zeros((self.size, len(frequent)))
        self.often[self.passage[column >= 0], column[column >= 0]] = self.adds[column >= 0]


class _Asked:
    """The queries one task holds, as matrices, and by query its terms that are not frequent."""

    def __init__(self, rows: pa.Table, n: int, df: Iterator[pa.Table], frequent: pa.Array, size: int):
        rows = rows.combine_chunks()
        self.ids, self.v, self.size = rows["id"].combine_chunks(), _rows(rows["v"], size), rows.num_rows
        owner, term, self.terms = _numbered(rows["terms"])
        known = np.zeros(len(self.terms))
        for piece in df:
            at = _places(piece["term"].combine_chunks(), self.terms)
            known[at[at >= 0]] = piece["df"].to_numpy()[at >= 0]
        weight = (np.log(1 + np.maximum(n - known + 0.5, 0.5) / (known + 0.5)) * (K1 + 1))[term] * (known[term] > 0)
        column = _places(self.terms, frequent)[term]
        self.often = np.zeros((self.size, len(frequent)))
        self.often[owner[column >= 0], column[column >= 0]] = weight[column >= 0]
        rare = (column < 0) & (weight > 0)
        self.owner, self.term, self.weight = owner[rare], term[rare], weight[rare]
        self.ends = np.searchsorted(self.owner, np.arange(self.size + 1))

    def scores(self, part: _Part, places: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Dense score and BM25 of the queries ``which`` (ascending) and all rows of the part; ``places`` are those of the terms in the part."""
        lo, hi = self.ends[which], self.ends[which + 1]
        entry = np.arange((hi - lo).sum()) + np.repeat(lo - np.cumsum(hi - lo) + hi - lo, hi - lo)
        row, at, weight = np.repeat(np.arange(len(which)), hi - lo), places[self.term[entry]], self.weight[entry]
        row, weight, at = row[at >= 0], weight[at >= 0], at[at >= 0]
        first, count = part.first[at], part.first[at + 1] - part.first[at]
        entry = np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)
        cell = np.repeat(row * part.size, count) + part.passage[entry]
        sparse = self.often[which] @ part.often.T
        sparse += np.bincount(cell, np.repeat(weight, count) * part.adds[entry], minlength=sparse.size).reshape(sparse.shape)
        return self.v[which] @ part.v.T, sparse


def _span_weights(limits: np.ndarray | None, weights: tuple[float, float], n: int) -> tuple[np.ndarray, np.ndarray]:
    """What each unit of both scores adds to the weighted sum, by query."""
    if limits is None:
        return np.full(n, weights[0]), np.full(n, weights[1])
    spans = limits[1] - limits[0], limits[3] - limits[2]
    return tuple(np.where(s > 0, w / np.where(s > 0, s, 1), 0) for s, w in zip(spans, weights))


class SystemSearch:
    """Scores of a query set against a whole corpus: every task holds a group of queries and reads the corpus, which is written once, in strips; no pair leaves a task and neither side is copied.

    ``corpus`` has ``id, text, vector``, ``queries`` the same (ids unique). All rows of the corpus are candidates of every query, none is
    left out, repeated ids are candidates each. Vectors are normalised; unusable ones score 0.

    A first reading scores all pairs and gives the limits of the scores. With it each query learns the most that each of up to ``CELLS`` parts of the corpus can give;
    the second reading scores it again only in parts that may hold one of its best.
    """

    def __init__(self, corpus: DataFrame, queries: DataFrame, size: int = 64, block: int = QUERY_BLOCK, strip: int = STRIP):
        text, v = F.coalesce(F.col("text"), F.lit("")), F.col("vector").cast("array<double>")
        unit = F.when(F.size(v) == size, l2_normalise(v)).alias("v")
        self.size, self.block, self.strip = size, block, strip
        held = written(corpus.select("id", unit, tokens(text).alias("tokens")), "corpus")
        stats = held.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("tokens")).alias("mean")).first()
        self.n, self.mean = stats["n"], stats["mean"] or 0.0
        df = written(held.select(F.explode(F.array_distinct("tokens")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "df")
        often = df.filter(F.col("df") > SHARE * self.n).orderBy(F.desc("df"), "term").limit(FREQUENT).collect()
        self.frequent = [r["term"] for r in often]
        self.files, self.df = sorted(held.inputFiles()), sorted(df.inputFiles())
        asked = written(queries.select("id", unit, F.array_distinct(tokens(text)).alias("terms")), "asked")
        count, tasks = asked.count(), int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.asked = asked.repartition(max(1, min(tasks, -(-count // STRIP)), -(-count // GROUP)), "id")

    def _each(self, make, schema: str) -> DataFrame:
        """``make(queries, strips)`` gives the batches of a group of queries; ``strips()`` reads the corpus: number of the part, the part, places of the terms of the queries."""
        n, mean, size, strip, files, df, often = self.n, self.mean, self.size, self.strip, self.files, self.df, self.frequent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            frequent = pa.array(often, pa.string())

            def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                queries = _Asked(pa.Table.from_batches(held), n, _pieces(df, 65536), frequent, size)

                def strips() -> Iterator[tuple[int, _Part, np.ndarray]]:
                    for i, rows in enumerate(_pieces(files, strip)):
                        part = _Part(rows, mean, frequent, size)
                        yield i, part, _places(queries.terms, part.terms)

                yield from make(queries, strips)

            held, count = [], 0
            for batch in batches:
                while n and batch.num_rows:
                    some = batch.slice(0, GROUP - count)
                    held, count, batch = [*held, some], count + some.num_rows, batch.slice(some.num_rows)
                    if count == GROUP:
                        yield from done(held)
                        held, count = [], 0
            if count:
                yield from done(held)

        return self.asked.mapInArrow(run, schema)

    def _first(self, weights: tuple[float, float] | None, scale: bool):
        """A function of the queries and strips: limits of the scores (in the order of ``_LIMITS``), and by part of the corpus the most of both scores, the most of
        dense + r x BM25, and r, which follows the limits so far."""
        block, per = self.block, max(1, -(-self.n // self.strip // CELLS))
        cells = -(-max(1, -(-self.n // self.strip)) // per)

        def first(q: _Asked, strips) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            limits = np.repeat(np.array([[np.inf], [-np.inf]] * 2), q.size, 1)
            top_d, top_s, top, r = (np.full((q.size, cells if weights else 0), x) for x in (-np.inf, -np.inf, -np.inf, 0.0))
            for i, part, places in strips():
                c = i // per
                if weights and i % per == 0:
                    if c or not scale:
                        w = _span_weights(limits if scale else None, weights, q.size)
                        r[:, c] = np.where(w[0] > 0, w[1] / np.where(w[0] > 0, w[0], 1), 0)
                for lo in range(0, q.size, block):
                    which = np.arange(lo, min(lo + block, q.size))
                    d, s = q.scores(part, places, which)
                    most = d.max(1), s.max(1)
                    limits[::2, which] = np.minimum(limits[::2, which], [d.min(1), s.min(1)])
                    limits[1::2, which] = np.maximum(limits[1::2, which], most)
                    if weights:
                        top_d[which, c], top_s[which, c] = np.maximum(top_d[which, c], most[0]), np.maximum(top_s[which, c], most[1])
                        s *= r[which, c][:, None]
                        s += d
                        top[which, c] = np.maximum(top[which, c], s.max(1))
            return limits, top_d, top_s, top, r

        return first, per

    def limits(self) -> DataFrame:
        """``query, dense_min, dense_max, bm25_min, bm25_max`` over all candidates."""
        first, _ = self._first(None, True)

        def make(q: _Asked, strips) -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([q.ids, *map(pa.array, first(q, strips)[0])], ["query", *_LIMITS])

        return self._each(make, "query string, " + ", ".join(f"{c} double" for c in _LIMITS))

    def best(self, k: int, dense: float = DENSE, sparse: float = SPARSE, scale: bool = True) -> DataFrame:
        """``query, candidate, score, place``: the k best by the weighted sum of the scaled scores (unscaled if not ``scale``). Equal scores (to 9 digits) go to the smaller id."""
        weights, block = (dense, sparse), self.block
        first, per = self._first(weights, scale)

        def make(q: _Asked, strips) -> Iterator[pa.RecordBatch]:
            if k <= 0:
                return
            limits, *tops = first(q, strips)
            given = limits if scale else None
            least, need = _bounds(limits, *tops, *_span_weights(given, weights, q.size), k)
            if min(weights) < 0:  # more of a score is no more of the sum
                least, need = np.full(q.size, -np.inf), np.ones_like(need)
            if given is not None:  # scaled scores begin at the lowest
                low = _span_weights(given, weights, q.size)
                least = least - low[0] * limits[0] - low[1] * limits[2]
            for i, part, places in strips():
                some = np.flatnonzero(need[:, i // per])
                for lo in range(0, len(some), block):
                    which = some[lo : lo + block]
                    exact = _weighted(*q.scores(part, places, which), weights, None if given is None else given[:, which])
                    a, b = _best(exact, exact >= least[which][:, None], k)
                    yield pa.RecordBatch.from_arrays([q.ids.take(pa.array(which[a])), part.ids.take(pa.array(b)), pa.array(exact[a, b])], ["query", "candidate", "score"])

        return topk(self._each(make, "query string, candidate string, score double"), ["query"], "score", "candidate", k)


def _bounds(limits: np.ndarray, top_d: np.ndarray, top_s: np.ndarray, top: np.ndarray, r: np.ndarray, wd: np.ndarray, ws: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """By query the least weighted sum that its k best have (less a margin), and by query and part whether the part may hold one of them.

    ``top`` is the most of d + r s in a part. With t = ws / wd for r, d + t s lies on the line through its values at 0 and r, so for t <= r it is at most the mean of
    ``top_d`` and ``top``, weighted by t / r; beyond r it grows by s at most. The candidates that have the most have as much at least, with the lowest other score.
    """
    wd, ws, d_low, s_low = wd[:, None], ws[:, None], limits[0][:, None], limits[2][:, None]
    t = np.where(wd > 0, ws / np.where(wd > 0, wd, 1), 0)
    near = np.where(r > 0, np.minimum(t / np.where(r > 0, r, 1), 1), 0)
    beyond = np.maximum(t - r, 0)
    most = np.minimum(wd * top_d + ws * top_s, np.where((wd > 0) & (r > 0), wd * (near * top + (1 - near) * top_d + beyond * top_s), np.inf))
    some = np.maximum(wd * top_d + ws * s_low, wd * d_low + ws * top_s)
    some = np.maximum(some, np.where((wd > 0) & (r > 0), wd * (near * top + (1 - near) * d_low + beyond * s_low), -np.inf))
    # each part has one of the best of its own, so the k-th of these is reached k times
    cells = some.shape[1]
    least = np.partition(some, cells - k, axis=1)[:, cells - k] if cells >= k else np.full(len(some), -np.inf)
    least = least - 1e-8 * (1 + np.abs(least))
    return least, most >= least[:, None]
