"""Problem 2: the most similar vectors, by an inverted multi-index.

Both halves of a vector are quantised by a codebook of their own; a cell of the index is a pair of centroids. A
query walks the cells in ascending order of the summed distances (a heap over the two sorted lists) until it has
met enough entries, and the entries of these cells are ranked by their exact cosine.

Codebooks are fitted on a bounded sample (``SAMPLE`` rows); every row is indexed. Cells are packed into shards of at most
``SHARD`` rows, a larger cell is spread over several; a task holds one shard and streams the queries that visit it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossarch.plans.scratch import written

#: rows the codebooks are fitted on; rows of a shard; visits one copy of a shard serves
SAMPLE, SHARD, VISITS = 20_000, 16_384, 100_000
#: queries that are compared with all rows, the part of their true neighbours the walks must reach, and what is met beyond that
PROBES, RECALL, MARGIN = 64, 0.95, 1.5
#: aimed rows per cell, and the largest codebook (a table of all cells stays below a million entries)
PER_CELL, CODEBOOK = 24, 1_000


def codebook(points: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """k-means centroids; fewer if there are fewer points. Empty ones are put on points far from theirs."""
    k = min(k, len(points))
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        near, gap = _nearest(points, centres)
        count = np.bincount(near, minlength=k)
        for d in range(points.shape[1]):
            total = np.bincount(near, points[:, d], minlength=k)
            centres[:, d] = np.where(count > 0, total / np.maximum(count, 1), centres[:, d])
        if (empty := np.flatnonzero(count == 0)).size:
            centres[empty] = points[np.argsort(-gap)[: empty.size]]
    return centres.astype(np.float32)


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = (centres**2).sum(1)[None, :] - 2 * points @ centres.T
    near = d.argmin(1)
    return near, d[np.arange(len(points)), near] + (points**2).sum(1)


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, meet: int) -> list[int]:
    """Cells (row * columns + column) in ascending order of ``first[row] + second[column]`` until ``meet`` entries
    are met; empty cells are passed over. Distances are those of one query to the centroids of either half."""
    a, b = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    fa, sb = first[a].tolist(), second[b].tolist()
    rows, columns = len(a), len(b)
    heap, next_column, met, cells = [(fa[0] + sb[0], 0, 0)], [0] * (rows + 1), 0, []
    while heap and met < meet:
        _, i, j = heapq.heappop(heap)
        next_column[i] = j + 1
        cell = a[i] * columns + b[j]
        if n := counts[cell]:
            cells.append(cell)
            met += n
        # (i, j) follows (i - 1, j) and (i, j - 1): each pair enters once, after both
        if i + 1 < rows and next_column[i + 1] == j:
            heapq.heappush(heap, (fa[i + 1] + sb[j], i + 1, j))
        if j + 1 < columns and (i == 0 or next_column[i - 1] > j + 1):
            heapq.heappush(heap, (fa[i] + sb[j + 1], i, j + 1))
    return cells


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Unit vectors of a list column whose entries all have ``size`` numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return flat / np.sqrt((flat**2).sum(1, keepdims=True))


def _units(column, number: type, size: int) -> np.ndarray:
    """Unit vectors of a column of stored bytes."""
    m = np.frombuffer(b"".join(column.to_pylist()), number).astype(np.float64).reshape(-1, size)
    return m / np.sqrt((m**2).sum(1, keepdims=True))


def usable(vector, size: int):
    """Vectors that take part: ``size`` numbers, none null or NaN or infinite, not all zero."""
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return (F.size(vector) == size) & (squares > 0) & (squares < float("inf"))


def _enough(index: DataFrame, books: tuple[np.ndarray, np.ndarray], counts: np.ndarray, number: type, size: int, k: int, recall: float) -> int:
    """Entries to meet: so many that the walks of ``PROBES`` of the queries (those of smallest hash), compared with all rows, reach ``recall``
    of their true neighbours, and ``MARGIN`` times that. The same rule at every size of the collection."""
    probes = index.filter("asked").orderBy(F.xxhash64("key"), "key").limit(PROBES).select("key", "v").toArrow()
    if not probes.num_rows:
        return 1
    names, queries = probes["key"].to_pylist(), _units(probes["v"], number, size)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            score = queries @ _units(batch.column(1), number, size).T
            out: list[tuple[int, float, int]] = []
            for i, row in enumerate(score):
                best = np.argpartition(-row, min(k, len(row) - 1))[: k + 1].tolist()
                out += [(i, float(row[j]), batch.column(2)[j].as_py()) for j in best if batch.column(0)[j].as_py() != names[i]]
            probe, cosine, cell = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(probe, pa.int32()), pa.array(cosine, pa.float64()), pa.array(cell, pa.int32())], ["probe", "cosine", "cell"])

    met = index.select("key", "v", "cell").mapInArrow(search, "probe int, cosine double, cell int")
    order = Window.partitionBy("probe").orderBy(F.desc("cosine"), "cell")
    true = met.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select("probe", "cell").collect()  # at most PROBES * k rows
    first, second = ((b**2).sum(1) - 2 * q @ b.T for b, q in zip(books, (queries[:, : size // 2], queries[:, size // 2 :])))
    needed = []
    for i in range(len(names)):
        if cells := [r["cell"] for r in true if r["probe"] == i]:
            far = (first[i][:, None] + second[i][None, :]).ravel()  # cells are walked in this order
            order = np.argsort(far, kind="stable")
            reached = np.cumsum(counts[order])
            needed += reached[np.searchsorted(far[order], far[cells])].tolist()
    if not needed:
        return 1
    return int(np.ceil(MARGIN * np.quantile(needed, recall, method="higher")))


def nearest(df: DataFrame, key: str, vector: str, queries: DataFrame, k: int = 5, size: int = 64, meet: int | None = None, recall: float = RECALL) -> DataFrame:
    """``query, neighbour, cosine, place``: for each key in ``queries`` (its one column) the ``k`` most similar rows.

    ``key`` is unique in ``df``. Null, all-zero, empty and wrongly sized vectors take no part, neither as query nor as neighbour; queries without
    such a row have no result. Ties go to the smaller key. With fewer than ``k`` other rows, all of them come out. A query meets ``meet`` entries
    at least; if that is not given, as many as ``recall`` takes by comparison of a bounded number of queries with all rows.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.col(vector).alias("v")).filter(usable(F.col("v"), size))
    asked = queries.select(F.col(queries.columns[0]).alias("key")).filter("key is not null").distinct().withColumn("asked", F.lit(True))
    kind, element = rows.schema["key"].dataType.simpleString(), rows.schema["v"].dataType.elementType.typeName()
    # entries keep their numbers as they are stored; cosines are computed in double precision from these
    number = np.float64 if element == "double" else np.float32
    rows = written(rows.join(asked, "key", "left").select("key", "v", F.coalesce("asked", F.lit(False)).alias("asked")), "vectors")
    n = rows.count()
    share = max(1, n // SAMPLE)
    sample = rows.filter(F.pmod(F.xxhash64("key"), F.lit(share)) == 0).select("v").limit(2 * SAMPLE).toArrow()
    if sample.num_rows == 0 and n > 0:
        sample = rows.select("v").limit(SAMPLE).toArrow()
    if sample.num_rows == 0:
        return spark.createDataFrame([], f"query {kind}, neighbour {kind}, cosine double, place int")
    points, half = _matrix(sample["v"].combine_chunks(), size), size // 2
    wanted = int(np.clip(np.sqrt(n / PER_CELL), 4, CODEBOOK))
    books = codebook(points[:, :half], wanted), codebook(points[:, half:], wanted, seed=1)
    columns = len(books[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch.column(1), size)
                cell = _nearest(m[:, :half], books[0])[0] * columns + _nearest(m[:, half:], books[1])[0]
                stored = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(number).reshape(-1, size)
                raw = pa.array([r.tobytes() for r in stored], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), raw, pa.array(cell.astype(np.int32)), batch.column(2)], ["key", "v", "cell", "asked"])

    # the cell of a row costs less than to write it beside the vector
    index = rows.select("key", "v", "asked").mapInArrow(assign, f"key {kind}, v binary, cell int, asked boolean")

    # Of equal vectors only the k + 1 smallest keys can be among the k best, so a large group of copies fills no cell.
    # At most CODEBOOK ** 2 cells.
    counts = np.zeros(len(books[0]) * columns, np.int64)
    copies = index.groupBy("cell", F.xxhash64("v").alias("h")).count()
    for r in copies.groupBy("cell").agg(F.sum(F.least("count", F.lit(k + 1))).alias("n")).toArrow().to_pylist():
        counts[r["cell"]] = r["n"]
    meet = meet or max(_enough(index, books, counts, number, size, k, recall), k + 1)
    shards = np.maximum(1, -(-counts // SHARD))  # of a cell
    first = np.zeros(len(counts), np.int64)
    at = filled = 0
    for cell in np.flatnonzero(counts).tolist():  # neighbouring cells share a shard
        if shards[cell] > 1:
            at += filled > 0
            first[cell], at, filled = at, at + int(shards[cell]), 0
            continue
        if filled + counts[cell] > SHARD:
            at, filled = at + 1, 0
        first[cell], filled = at, filled + int(counts[cell])
    plan = spark.sparkContext.broadcast((books, counts, shards, first))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (one, two), counts, shards, first = plan.value
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _units(batch.column(1), number, size)
            da = (one**2).sum(1) - 2 * m[:, :half] @ one.T
            db = (two**2).sum(1) - 2 * m[:, half:] @ two.T
            shard, who, visited = [], [], []
            for i in range(len(m)):
                by: dict[int, list[int]] = {}
                for c in walk(da[i], db[i], counts, meet):
                    for s in range(first[c], first[c] + shards[c]):
                        by.setdefault(int(s), []).append(c)
                shard += by
                who += [i] * len(by)
                visited += by.values()
            take = pa.array(who, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), batch.column(0).take(take), batch.column(1).take(take), pa.array(visited, pa.list_(pa.int32()))],
                ["shard", "key", "v", "cells"],
            )

    visits = written(index.filter("asked").select("key", "v").mapInArrow(route, f"shard int, key {kind}, v binary, cells array<int>"), "visits")
    # a shard that very many queries visit is served by several copies of it
    busy = written(visits.groupBy("shard").count().select("shard", F.ceil(F.col("count") / VISITS).cast("int").alias("copies")), "busy")
    visited = np.zeros(at + 1, bool)
    visited[[r["shard"] for r in busy.select("shard").collect()]] = True  # one number for SHARD rows of the table
    reached = spark.sparkContext.broadcast(visited)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, shards, first = plan.value
        for batch in batches:
            if batch.num_rows:
                cell = batch.column("cell").to_numpy()
                shard = (first[cell] + batch.column("spread").to_numpy() % shards[cell]).astype(np.int32)
                keep = pa.array(reached.value[shard])  # entries nobody visits are not moved
                yield pa.RecordBatch.from_arrays([pa.array(shard).filter(keep), *(batch.column(c).filter(keep) for c in ("key", "v", "cell"))], ["shard", "key", "v", "cell"])

    placed = index.select("key", "v", "cell", F.pmod(F.xxhash64("v"), F.lit(2**31)).alias("spread")).mapInArrow(place, f"shard int, key {kind}, v binary, cell int")
    # equal vectors lie in one shard
    first_keys = F.row_number().over(Window.partitionBy("shard", "v").orderBy("key"))
    entries = placed.withColumn("copy", first_keys).filter(F.col("copy") <= k + 1)
    entries = entries.join(busy, "shard").select("shard", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"), F.lit(0).alias("side"), "key", "v", F.array("cell").alias("cells"))
    visits = visits.join(busy, "shard").select("shard", (F.pmod(F.xxhash64("key"), F.col("copies")) + 1).cast("int").alias("copy"), F.lit(1).alias("side"), "key", "v", "cells")
    both = entries.unionByName(visits).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "side")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Shard | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            shard, copy, side = (batch.column(c).to_numpy() for c in ("shard", "copy", "side"))
            edges = np.flatnonzero(np.diff(shard) | np.diff(copy) | np.diff(side)) + 1
            for lo, hi in zip([0, *edges], [*edges, batch.num_rows]):
                name, part = (shard[lo], copy[lo]), batch.slice(lo, hi - lo)
                if held is None or held.name != name:
                    held = _Shard(name, size, number)
                if side[lo] == 0:
                    held.add(part)
                else:
                    yield held.best(part, k)

    found = both.mapInArrow(rank, f"query {kind}, neighbour {kind}, cosine double")
    # each query has at most k rows of a shard
    order = Window.partitionBy("query").orderBy(F.desc("cosine"), "neighbour")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


class _Shard:
    """Entries of one shard, and the queries' best among them."""

    def __init__(self, name, size: int, number: type):
        self.name, self.size, self.number, self.parts, self.ready = name, size, number, [], None

    def add(self, part: pa.RecordBatch) -> None:
        self.parts.append(part)

    def _prepare(self):
        if self.ready is None:
            t = pa.Table.from_batches(self.parts).combine_chunks()
            cell = t["cells"].combine_chunks().flatten().to_numpy()
            order = np.argsort(cell, kind="stable")
            m = _units(t["v"], self.number, self.size)[order]
            names, starts = np.unique(cell[order], return_index=True)
            spans = dict(zip(names.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(cell)])))
            self.ready = m, m.astype(np.float32), np.array(t["key"].to_pylist(), dtype=object)[order], spans
        return self.ready

    def best(self, asked: pa.RecordBatch, k: int) -> pa.RecordBatch:
        out: tuple[list, list, list] = ([], [], [])
        if self.parts:
            exact, m, keys, spans = self._prepare()
            queries = _units(asked.column("v"), self.number, self.size)
            q = queries.astype(np.float32)
            names = asked.column("key").to_pylist()
            for i, (name, cells) in enumerate(zip(names, asked.column("cells").to_pylist())):
                at = np.concatenate([np.arange(*spans[c]) for c in cells if c in spans] or [np.empty(0, int)])
                if not len(at):
                    continue
                score = m[at] @ q[i]
                if len(at) > 2 * k + 2:  # all that may be among the k after exact ranking, ties included
                    edge = np.partition(score, len(at) - k - 1)[len(at) - k - 1] - 1e-5
                    at = at[score >= edge]
                ranked = sorted((-s, n) for s, n in zip((exact[at] @ queries[i]).tolist(), keys[at].tolist()) if n != name)[:k]
                out[0].extend([name] * len(ranked))
                out[1].extend(n for _, n in ranked)
                out[2].extend(-s for s, _ in ranked)
        kind = asked.schema.field("key").type
        return pa.RecordBatch.from_arrays([pa.array(out[0], kind), pa.array(out[1], kind), pa.array(out[2], pa.float64())], ["query", "neighbour", "cosine"])
