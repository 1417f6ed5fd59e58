"""Queries of this subpackage, by problem. ``QUERIES`` maps names to (spark, folder) -> DataFrame."""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarch.llm import bpe, lookalikes, mixing, neighbours, partenum, spam, spans, splitting, terms
from glossarch.llm.oracle import ORACLE  # noqa: F401
from glossarch.llm.tables import CHUNKS, CLAIMS, CONTEXTS, current, table
from glossarch.operators.upsert import current_rows
from glossarch.plans.scratch import written


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.same_look_pairs(current(spark, d, CHUNKS, "chunk"), "key", "chunk")


def p1_one_form(spark: SparkSession, d: str) -> DataFrame:
    rows = current(spark, d, CHUNKS, "chunk")
    return rows.select(F.col("key").alias("id"), lookalikes.one_form("chunk").alias("form"))


VECTORS = {"emb": CHUNKS, "emb_ctx": CONTEXTS, "claim_emb": CLAIMS}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    probes, parts = table(spark, d, "knn_probes"), []
    for field, name in VECTORS.items():
        asked = probes.filter(F.col("field") == field).select("key")
        # a few queries, so as many entries are met as none of those compared with all rows misses a neighbour by
        near = neighbours.nearest(current(spark, d, name, field), "key", field, asked, recall=1.0)
        parts.append(near.select(F.lit(field).alias("field"), F.col("query").alias("probe_key"), F.col("neighbour").alias("neighbour_key")))
    return reduce(DataFrame.unionByName, parts)


def p2_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """For every row whose number (that of its chunk) is divisible by 20 the 5 most similar rows of its table, with their cosines."""
    parts = []
    for field, name in VECTORS.items():
        rows = current(spark, d, name, field)
        number = F.regexp_extract("key", "_([0-9]+)(#[0-9]+)?$", 1).try_cast("bigint")
        near = neighbours.nearest(rows, "key", field, rows.filter(number % 20 == 0).select("key"))
        parts.append(near.select(F.lit(field).alias("field"), "query", "neighbour", F.round("cosine", 6).alias("cosine"), "place"))
    return reduce(DataFrame.unionByName, parts)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_pieces(spark, d).filter("piece = 1").select("id", "boundary")


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    # a text that is not oversized need not travel: which row is current depends on the key and the run
    long = F.when(F.length("chunk") > splitting.LIMIT, F.col("chunk")).alias("chunk")
    rows = current_rows(table(spark, d, CHUNKS).select("id", "run", long), "id")
    return splitting.split_oversized(rows, "id", "chunk")


SIMILAR = Fraction(6, 10)


def _sets(spark: SparkSession, d: str) -> DataFrame:
    parts = [partenum.sets_of(current(spark, d, name, text), kind, "key", text) for kind, (name, text) in enumerate(((CHUNKS, "chunk"), (CLAIMS, "claim_text")))]
    return written(parts[0].unionByName(parts[1]), "sets")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    sets = _sets(spark, d)
    return partenum.record_pairs(sets, partenum.similar_classes(sets, SIMILAR))


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    sets = _sets(spark, d)
    rows = partenum.groups(sets, partenum.similar_classes(sets, SIMILAR))
    return rows.withColumn("kind", F.when(F.col("kind") == 0, "chunk").otherwise("claim_text"))


def _terms(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for field, name in (("chunk", CHUNKS), ("chunk_ctx", CONTEXTS)):
        parts.append((field, terms.distinctive_terms(current(spark, d, name, field), "key", field)))
    return parts


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [terms.best_terms(scored).select(F.lit(field).alias("field"), F.col("key").alias("id"), "term") for field, scored in _terms(spark, d)]
    return reduce(DataFrame.unionByName, parts)


def p5_residuals(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        scored.select(F.lit(field).alias("field"), F.col("key").alias("id"), "term", "tf", "records", F.round("residual", 6).alias("residual"), F.round("adjusted", 6).alias("adjusted"))
        for field, scored in _terms(spark, d)
    ]
    return reduce(DataFrame.unionByName, parts)


def _passages(spark: SparkSession, d: str) -> DataFrame:
    """Chunks and quotes in one table; the first character of ``rid`` says which."""
    chunks = current(spark, d, CHUNKS, "doc", "chunk").select(F.concat(F.lit("c"), "key").alias("rid"), "doc", F.col("chunk").alias("text"))
    quotes = current(spark, d, CLAIMS, "doc", "source_quote").select(F.concat(F.lit("q"), "key").alias("rid"), "doc", F.col("source_quote").alias("text"))
    return chunks.unionByName(quotes)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.substring("a", 2, 2**31 - 1), F.substring("b", 2, 2**31 - 1)
    return spans.sharing_pairs(spans.shared_runs(_passages(spark, d))).select(F.least(a, b).alias("rec_a"), F.greatest(a, b).alias("rec_b"))


def p6_stretches(spark: SparkSession, d: str) -> DataFrame:
    rows = spans.stretches(spans.shared_runs(_passages(spark, d)))
    field = F.when(F.substring("rid", 1, 1) == "c", "chunk").otherwise("source_quote")
    places = F.array_join(F.transform("stretches", lambda s: F.concat_ws("-", s["first"], s["last"])), " ")
    return rows.select(field.alias("field"), F.substring("rid", 2, 2**31 - 1).alias("key"), "words", places.alias("stretches"), "shared_words", "share")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encoded(table(spark, d, "documents"), "doc_id", "text").withColumnRenamed("key", "doc_id")


def _mixture(spark: SparkSession, d: str):
    counted = bpe.token_counts(table(spark, d, "documents").filter("source is not null and text is not null"), "text", None, "doc_id", "source")
    return mixing.mixture(counted.withColumnRenamed("doc_id", "key"), table(spark, d, "source_weights"))


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[0].withColumnRenamed("key", "doc_id")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(*_mixture(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    rule = spam.calibrated(docs, "doc_id", "text", "lang", table(spark, d, "doc_labels"))
    return spam.spam_pages(docs, "doc_id", "text", "lang", rule).select(F.col("key").alias("doc_id"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_one_form, p2_found, p2_neighbours, p3_found, p3_pieces, p4_found, p4_groups, p5_found, p5_residuals, p6_found, p6_stretches, p7_ids, p8_mixture, p8_shares, p9_found)
}
