"""SQLite databases as a data source: ``spark.read.format("sqlite_folder")`` and a keyed upsert into one database."""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage


def to_blob(vector) -> bytes | None:
    """Little-endian float32, without a header."""
    return None if vector is None else np.asarray(vector, "<f4").tobytes()


def from_blob(blob: bytes | None) -> list[float] | None:
    return None if blob is None else np.frombuffer(blob, "<f4").tolist()


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def databases(path: str) -> list[str]:
    """A database, or those directly in a folder, sorted; nothing for a folder that is missing."""
    if os.path.isfile(path):
        return [path]
    if not os.path.isdir(path):
        return []
    return sorted(os.path.join(path, n) for n in os.listdir(path) if n.endswith(".sqlite"))


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, options

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in databases(self.options["path"])] or [_File("")]

    def read(self, partition: _File) -> Iterator[tuple]:
        """Rows of one database. One without the table has none; a broken one gives the rows read before the fault."""
        if not partition.path:
            return
        fields, table = self.schema.fields, self.options["table"]
        vectors = [isinstance(f.dataType, T.ArrayType) for f in fields]
        needed = self.options.get("notempty")
        where = f" WHERE coalesce({_quoted(needed)}, '') <> ''" if needed else ""
        try:
            db = sqlite3.connect(f"file:{partition.path}?mode=ro", uri=True)
            try:
                if not db.execute("SELECT 1 FROM sqlite_master WHERE type = 'table' AND name = ?", (table,)).fetchone():
                    return
                columns = ", ".join(_quoted(f.name) for f in fields)
                for row in db.execute(f"SELECT {columns} FROM {_quoted(table)}{where}"):
                    yield tuple(from_blob(v) if is_vector else v for v, is_vector in zip(row, vectors))
            finally:
                db.close()
        except sqlite3.Error:
            if self.options.get("strict", "false").lower() == "true":
                raise


class _Rows(WriterCommitMessage):
    def __init__(self, rows: list[tuple]):
        self.rows = rows


class _Writer(DataSourceWriter):
    """Upserts on commit. SQLite has one writer, so tasks hand their rows to it; meant for exports of moderate size."""

    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        self.schema, self.options, self.overwrite = schema, options, overwrite

    def write(self, rows: Iterator) -> WriterCommitMessage:
        vectors = [isinstance(f.dataType, T.ArrayType) for f in self.schema.fields]
        return _Rows([tuple(to_blob(v) if is_vector else v for v, is_vector in zip(r, vectors)) for r in rows])

    def commit(self, messages: list) -> None:
        path, table, key = (self.options[k] for k in ("path", "table", "key"))
        fields = self.schema.fields
        db = sqlite3.connect(path)
        try:
            with db:
                if self.overwrite:
                    db.execute(f"DROP TABLE IF EXISTS {_quoted(table)}")
                kinds = ", ".join(f"{_quoted(f.name)} {'BLOB' if isinstance(f.dataType, T.ArrayType) else 'TEXT'}{' PRIMARY KEY' if f.name == key else ''}" for f in fields)
                db.execute(f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({kinds})")
                for column in filter(None, self.options.get("index", "").split(",")):
                    db.execute(f"CREATE INDEX IF NOT EXISTS {_quoted(f'idx_{table}_{column}')} ON {_quoted(table)} ({_quoted(column)})")
                names = ", ".join(_quoted(f.name) for f in fields)
                marks = ", ".join("?" * len(fields))
                for m in messages:
                    if m is not None:
                        db.executemany(f"INSERT OR REPLACE INTO {_quoted(table)} ({names}) VALUES ({marks})", m.rows)
        finally:
            db.close()


class SqliteFolder(DataSource):
    """Options: ``path`` (a database or a folder of them), ``table``, ``notempty`` (a column whose empty rows are skipped),
    ``strict``; for writing ``path`` of one database, ``table``, ``key``, ``index`` (columns, comma-separated)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_folder"

    def schema(self) -> str:
        return "doc string, id string, chunk_raw string, context_prefix string, chunk_ctx string, emb_ctx array<float>"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(schema, dict(self.options), overwrite)


def read(spark: SparkSession, path: str, table: str, schema: str, notempty: str | None = None) -> DataFrame:
    """Only the columns of ``schema`` are read. Databases are neither deduplicated among each other nor filtered."""
    spark.dataSource.register(SqliteFolder)
    reader = spark.read.format("sqlite_folder").schema(schema).option("path", path).option("table", table)
    return (reader.option("notempty", notempty) if notempty else reader).load()


def upsert(df: DataFrame, path: str, table: str, key: str, index: tuple[str, ...] = ()) -> None:
    """Last write wins per key; rows of other keys stay."""
    df.sparkSession.dataSource.register(SqliteFolder)
    df.write.format("sqlite_folder").mode("append").option("path", path).option("table", table).option("key", key).option("index", ",".join(index)).save()


def system_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """``id, text, vector`` of all contextualized passages in the databases of a folder, empty if there are none."""
    rows = read(spark, folder, "contextualized_chunks", "id string, chunk_ctx string, emb_ctx array<float>", "chunk_ctx")
    return rows.withColumnsRenamed({"chunk_ctx": "text", "emb_ctx": "vector"})
