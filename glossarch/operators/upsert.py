"""Keyed upsert: the last write of a key wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``. Rows with a null in the key cannot be addressed and are left out.

    ``row_number() <= 1`` is planned with a group limit before the exchange, so of a key that holds a large
    part of the table each task sends one row.
    """
    keys = [key] if isinstance(key, str) else key
    out = df
    for k in keys:
        out = out.filter(F.col(k).isNotNull())
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return out.withColumn("__place", place).filter(F.col("__place") == 1).drop("__place")


def current_rows(df: DataFrame, key: str, version: str = "run") -> DataFrame:
    """The row of the highest ``version`` per key; a null version is the lowest, copies collapse to one row."""
    return latest_rows(df, key, [F.col(version).desc_nulls_last()])


def upsert(existing: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """``existing`` with ``incoming`` merged in: new keys added, known keys replaced, untouched keys kept.

    Within one side the row with the greatest ``order`` wins (null last); any incoming row beats an existing one.
    """
    both = existing.withColumn("__side", F.lit(0)).unionByName(incoming.withColumn("__side", F.lit(1)))
    return latest_rows(both, key, [F.col("__side").desc(), F.col(order).desc_nulls_last()]).drop("__side")
