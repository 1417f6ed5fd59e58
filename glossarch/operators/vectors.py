"""Vectors as arrays of floats: normalisation, dot product, hashed bags of words, exhaustive top-k."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
_TOKEN = re.compile("[a-z0-9]+")


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalise(v: Column) -> Column:
    """v / (|v| + 1e-12) as doubles; a zero vector stays zero, null stays null."""
    # the one-element array binds vector and norm, so that the norm is not computed for each number
    bound = F.array(F.struct(v.alias("v"), norm(v).alias("n")))
    return F.get(F.transform(bound, lambda b: F.transform(b["v"], lambda x: x.cast("double") / (b["n"] + F.lit(1e-12)))), F.lit(0))


def dot(a: Column, b: Column) -> Column:
    """Sum of products; null where one is null or the sizes differ."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.when(F.size(a) == F.size(b), F.aggregate(products, F.lit(0.0), lambda s, x: s + x))


def bucket(token: str, buckets: int = BUCKETS) -> int:
    return int(hashlib.md5(token.encode()).hexdigest()[:4], 16) % buckets


class _Buckets(dict):
    def __init__(self, buckets: int, room: int = 300_000):
        super().__init__()
        self.buckets, self.room = buckets, room

    def __missing__(self, token: str) -> int:
        b = bucket(token, self.buckets)
        if len(self) < self.room:
            self[token] = b
        return b


def bag(tokens: list[str], places: _Buckets) -> np.ndarray:
    v = np.bincount(np.fromiter(map(places.__getitem__, tokens), np.int64, len(tokens)), minlength=places.buckets).astype(float)
    return (v / (np.sqrt((v**2).sum()) + 1e-12)).astype(np.float32)


@F.pandas_udf(T.ArrayType(T.FloatType()))
def hash_embedding(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Offline stand-in for an embedding model: counts of the tokens of a text by hash bucket, normalised. Null is as empty."""
    places = _Buckets(BUCKETS)
    for batch in texts:
        yield pd.Series([bag(_TOKEN.findall(t.lower()) if t else [], places) for t in batch], dtype=object)


def unit_matrix(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Normalised rows of a list column and whether they are usable; others (null, wrong size, zero) are zero rows."""
    out = np.zeros((len(column), size))
    fits = np.array([x is not None and len(x) == size for x in column.to_pylist()], bool) if column.null_count or len(column.flatten()) != size * len(column) else np.ones(len(column), bool)
    if fits.any():
        out[fits] = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    out = np.nan_to_num(out)
    length = np.sqrt((out**2).sum(1))
    return out / (length + 1e-12)[:, None], fits & (length > 0)


def dense_topk(corpus: DataFrame, key: str, vector: str, queries: DataFrame, k: int, size: int = BUCKETS, block: int = 2048) -> DataFrame:
    """``query, neighbour, score, place``: exhaustive search of a stated query set, in blocks of queries.

    ``queries`` has the columns ``key`` and ``vector`` of ``corpus``. Each block (a bounded matrix) goes to all tasks, which keep
    their k best per query; the row itself is left out. Ties (scores rounded to 9 digits) go to the smaller key.
    """
    spark = corpus.sparkSession
    kind = corpus.schema[key].dataType.simpleString()
    asked = queries.select(F.col(key).alias("key"), F.col(vector).alias("v")).toLocalIterator(prefetchPartitions=True)
    found: DataFrame | None = None

    def search(rows: list) -> DataFrame:
        names = [r["key"] for r in rows]
        m, ok = unit_matrix(pa.array([r["v"] for r in rows], pa.list_(pa.float64())), size)
        held = spark.sparkContext.broadcast(([n for n, o in zip(names, ok) if o], m[ok]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, q = held.value
            for batch in batches:
                keys = np.array(batch.column(0).to_pylist(), dtype=object)
                c, good = unit_matrix(batch.column(1), size)
                keys, c = keys[good], c[good]
                if not len(keys) or not len(names):
                    continue
                scores = np.round(q @ c.T, 9)
                out = []
                for i, row in enumerate(scores):
                    edge = np.partition(row, max(0, len(row) - k - 1))[max(0, len(row) - k - 1)]
                    at = np.flatnonzero(row >= edge)
                    best = sorted(((-row[j], keys[j]) for j in at if keys[j] != names[i]))[:k]
                    out += [(names[i], n, -s) for s, n in best]
                cols = list(zip(*out)) or [(), (), ()]
                t = batch.schema.field(0).type
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], t), pa.array(cols[1], t), pa.array(cols[2], pa.float64())], ["query", "neighbour", "score"])

        return corpus.select(key, vector).mapInArrow(run, f"query {kind}, neighbour {kind}, score double")

    part: list = []
    for row in asked:
        part.append(row)
        if len(part) == block:
            found = search(part) if found is None else found.unionByName(search(part))
            part = []
    if part or found is None:
        found = search(part) if found is None else found.unionByName(search(part))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "neighbour")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
