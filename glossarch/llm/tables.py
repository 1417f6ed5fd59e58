"""Reading of the tables the queries of this subpackage run over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarch.operators.upsert import current_rows

#: key, text and vector columns of the tables with versions
CHUNKS, CONTEXTS, CLAIMS = "raw_chunks", "contextualized_chunks", "claims"
KEY = {CHUNKS: "id", CONTEXTS: "id", CLAIMS: "claim_id"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def current(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Current rows of a table, with its key as ``key`` and ``columns``; only these reach the shuffle."""
    rows = table(spark, folder, name).select(F.col(KEY[name]).alias("key"), "run", *columns)
    return current_rows(rows, "key").drop("run")
