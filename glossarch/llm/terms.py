"""Problem 5: how distinctive a term is of a record, by DataFrame arithmetic over the table of counts.

The counts form a contingency table of records by terms. Its residuals (observed minus expected over the root of the
expectation, with the variance adjusted by the margins) and the product of frequency and inverse record frequency
are both functions of a posting and of its margins, so one operator gives both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarch.plans.scratch import written

#: rows and characters that bound the broadcast table of the most frequent terms
HEAVY_TERMS, HEAVY_LENGTH = 20_000, 64


def postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, term, tf, record_tf``: terms are the longest runs of a-z and 0-9 in the lower-cased text."""
    rows = df.select(F.col(key).alias("key"), F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z0-9]+"), F.lit(0)).alias("terms"))
    rows = rows.select("key", F.size("terms").cast("bigint").alias("record_tf"), F.explode("terms").alias("term"))
    return rows.groupBy("key", "term", "record_tf").agg(F.count(F.lit(1)).alias("tf"))


def distinctive_terms(df: DataFrame, key: str, text: str, least: int = 2) -> DataFrame:
    """``key, term, tf, records, n, score, residual, adjusted`` for each term of each record (``key`` unique in ``df``).

    ``records`` is the number of records with the term, ``n`` that of records whose text is not null; terms in fewer
    than ``least`` records are left out. ``score`` is tf * ln(n / records), rounded to 6 decimals. ``residual`` is
    (observed - expected) / sqrt(expected) with the expectation from both margins, ``adjusted`` that over
    sqrt((1 - row share)(1 - column share)), null where a margin is the whole table. Null and empty texts and texts without terms give no rows.

    The margins of the most frequent terms are broadcast (``HEAVY_TERMS`` rows of bounded length, whatever the
    size of the corpus), so no task gets all postings of a common term; only postings of rarer terms are exchanged.
    """
    n = df.filter(F.col(text).isNotNull()).count()
    posts = written(postings(df, key, text), "postings")
    margins = written(
        posts.groupBy("term").agg(F.count(F.lit(1)).alias("records"), F.sum("tf").alias("term_tf")).filter(F.col("records") >= least),
        "margins",
    )
    total = posts.agg(F.sum("tf")).first()[0] or 0
    heavy = F.broadcast(written(margins.filter(F.length("term") <= HEAVY_LENGTH).orderBy(F.desc("records"), "term").limit(HEAVY_TERMS), "heavy"))
    common = posts.join(heavy, "term")
    rare = posts.join(heavy.select("term"), "term", "left_anti").join(margins, "term")
    expected = F.col("record_tf") * F.col("term_tf") / F.lit(float(total))
    share = (1 - F.col("record_tf") / F.lit(float(total))) * (1 - F.col("term_tf") / F.lit(float(total)))
    residual = (F.col("tf") - expected) / F.sqrt(expected)
    return common.unionByName(rare).select(
        "key",
        "term",
        "tf",
        "records",
        F.lit(n).cast("bigint").alias("n"),
        F.round(F.col("tf") * F.log(F.lit(float(n)) / F.col("records")), 6).alias("score"),
        residual.alias("residual"),
        F.when(share > 0, residual / F.sqrt(share)).alias("adjusted"),
    )


def best_terms(scored: DataFrame, by: str = "score") -> DataFrame:
    """``key, term, <by>`` of the best term of each record; with equal scores the smaller term."""
    best = scored.groupBy("key").agg(F.min(F.struct((-F.col(by)).alias("s"), "term")).alias("b"))
    return best.select("key", F.col("b.term").alias("term"), (-F.col("b.s")).alias(by))
