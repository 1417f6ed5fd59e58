"""Text, JSON array and JSON lines files as DataFrames, and back."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _schema(strings: str, lists: str = "", more: str = "") -> T.StructType:
    """A schema of string fields, then fields of lists of strings, then string fields."""
    fields = [T.StructField(n, T.StringType()) for n in strings.split()] + [T.StructField(n, T.ArrayType(T.StringType())) for n in lists.split()]
    return T.StructType(fields + [T.StructField(n, T.StringType()) for n in more.split()])


DOCUMENT = _schema("doc path text")
CHUNK = _schema("doc id chunk")
CONTEXTUALIZED = _schema("doc id chunk contextualized_chunk", "local_neighbor_ids doc_retrieved_ids system_retrieved_ids", "context_prefix")
CLAIM = _schema("doc chunk_id claim_id claim_text source_quote")
TRIPLE = _schema("claim_id claim_text subject predicate object")

#: endings a stem loses before it gets a new one
ENDINGS = ("_cleaned", "_chunks", "_contextualized", "_claims")


def stem(path: str) -> str:
    return os.path.splitext(os.path.basename(path.rstrip("/")))[0]


def output_path(path: str, ending: str, *strip: str) -> str:
    """A sibling of ``path`` whose stem has lost the endings ``strip`` (all known ones by default) and got ``ending``."""
    base = stem(path)
    for s in strip or ENDINGS:
        base = base.removesuffix(s)
    return os.path.join(os.path.dirname(path.rstrip("/")), base + ending)


def text_inputs(path: str) -> list[str]:
    """A ``.txt`` file, or the ``.txt`` files directly in a folder, sorted; any case of the suffix. ValueError otherwise."""
    if os.path.isfile(path) and path.lower().endswith(".txt"):
        return [path]
    if os.path.isdir(path):
        return sorted(p for n in os.listdir(path) if n.lower().endswith(".txt") and os.path.isfile(p := os.path.join(path, n)))
    raise ValueError(f"neither a .txt file nor a folder: {path}")


def read_texts(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """``doc, path, text``, one row per file, line ends as LF. Invalid UTF-8 is dropped, or fails if ``strict``.

    ``path`` is a file, a folder or a glob of the cluster's file system; folders are not descended into. ``doc`` is the stem without ``_cleaned``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[tT][xX][tT]").option("recursiveFileLookup", "false").load(path)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            text = [bytes(c).decode("utf-8", "strict" if strict else "ignore").replace("\r\n", "\n").replace("\r", "\n") for c in b["content"]]
            yield pd.DataFrame({"doc": [re.sub("_cleaned$", "", stem(p)) for p in b["path"]], "path": b["path"], "text": text})

    return files.select("path", "content").mapInPandas(decode, DOCUMENT)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType = CHUNK) -> DataFrame:
    """Rows of files that hold one JSON array of objects each. A file that holds something else fails with ValueError."""
    names = [f.name for f in schema.fields]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"]):
                rows = json.loads(bytes(content).decode("utf-8"))
                if not isinstance(rows, list):
                    raise ValueError(f"not a JSON array: {name}")
                yield pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names, dtype=object)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, schema)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType = CLAIM, need: tuple[str, ...] = ("claim_id", "claim_text")) -> DataFrame:
    """Rows of JSON lines; blank and malformed lines and rows in which a field of ``need`` is null or empty are passed over."""
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    rows = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    rows = rows.filter(F.col("_bad").isNull()).drop("_bad")
    for n in need:
        rows = rows.filter(F.coalesce(F.trim(F.col(n)), F.lit("")) != "")
    return rows


def write_json_lines(df: DataFrame, path: str) -> None:
    """One record per line, null fields kept, replacing what is there."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_json_array(df: DataFrame, path: str) -> int:
    """One pretty file with a JSON array, rows in the order of ``df``; they pass the driver one partition at a time."""
    n = 0
    with open(path, "w", encoding="utf-8") as out:
        out.write("[")
        for row in df.toLocalIterator():
            out.write(",\n" if n else "\n")
            out.write("  " + json.dumps(row.asDict(recursive=True), ensure_ascii=False, indent=2).replace("\n", "\n  "))
            n += 1
        out.write("\n]" if n else "]")
    return n


def write_texts(df: DataFrame, folder: str, ending: str = "_cleaned.txt") -> DataFrame:
    """Writes ``text`` of each row to ``folder/<doc><ending>`` on the tasks' file system; gives ``doc, path`` when run."""

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for b in batches:
            paths = [os.path.join(folder, d + ending) for d in b["doc"]]
            for p, t in zip(paths, b["text"]):
                with open(p, "w", encoding="utf-8") as out:
                    out.write(t or "")
            yield pd.DataFrame({"doc": b["doc"], "path": paths})

    return df.select("doc", "text").mapInPandas(save, "doc string, path string")
