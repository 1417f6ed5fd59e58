"""Streams: a keyed table kept up to date, chunks of arriving documents, retrieval from what has been seen of a document."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from glossarch.operators.upsert import upsert
from glossarch.plans.pipeline import Memory, chunk, hashed_vector


class VersionedTable:
    """A parquet table of which each upsert writes a whole new version. Readers see the last complete one."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        self._where = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._where.getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        if not self._files.exists(self._where):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(self._where)]
        done = [n for n in names if n.startswith("v") and self._files.exists(self._child(f"{n}/_SUCCESS"))]
        return sorted(int(n[1:]) for n in done)

    def _child(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def read(self) -> DataFrame | None:
        known = self.versions()
        return self.spark.read.parquet(f"{self.path}/v{known[-1]}") if known else None

    def upsert(self, incoming: DataFrame, key: str, order: str, version: int | None = None) -> None:
        """Writes version ``version`` (the next one by default). A version that exists is left alone, so a repeated batch does nothing."""
        known = self.versions()
        version = (known[-1] + 1 if known else 0) if version is None else version
        if version in known:
            return
        before = [v for v in known if v < version]
        existing = self.spark.read.parquet(f"{self.path}/v{before[-1]}") if before else incoming.limit(0)
        upsert(existing, incoming, key, order).write.mode("overwrite").parquet(f"{self.path}/v{version}")
        for old in before[: max(0, len(before) + 1 - self.keep)]:
            self._files.delete(self._child(f"v{old}"), True)


def keep_upserted(stream: DataFrame, table: VersionedTable, key: str, order: str, checkpoint: str) -> StreamingQuery:
    """Upserts each micro-batch; the number of the batch is the version, so every batch takes effect once."""
    return (
        stream.writeStream.foreachBatch(lambda batch, n: table.upsert(batch, key, order, n))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def chunk_stream(documents: DataFrame, **options) -> DataFrame:
    """The chunks of arriving documents; works on each alone, so nothing is kept."""
    return chunk(documents, **options)


def history_stream(passages: DataFrame, k: int = 2, dense: float = 0.6, sparse: float = 0.4, embed: Callable = hashed_vector) -> DataFrame:
    """``doc, id, found``: for each arriving passage (``doc, id, pos, text``) the ids of the best among those of its document seen before.

    Within a batch passages are taken by ``pos``. The state of a document is what it remembers.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        memory = Memory(None)
        if state.exists:
            memory.__dict__.update(pickle.loads(state.get[0]))
        memory.embed = embed
        rows = pd.concat(list(batches)).sort_values("pos", kind="stable")
        out = []
        for r in rows.itertuples(index=False):
            out.append((key[0], r.id, [memory.ids[i] for i in memory.best(r.text or "", k, dense, sparse)]))
            memory.add(r.id, r.pos, r.text or "")
        state.update((pickle.dumps({n: v for n, v in memory.__dict__.items() if n != "embed"}),))
        yield pd.DataFrame(out, columns=["doc", "id", "found"])

    return passages.groupBy("doc").applyInPandasWithState(run, "doc string, id string, found array<string>", "memory binary", "append", GroupStateTimeout.NoTimeout)
