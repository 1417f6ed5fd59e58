import pytest
from pyspark.sql import functions as F

from glossarch.plans import pipeline
from glossarch.plans.metrics import Metrics


def test_counts_of_claims(spark):
    replies = {"a": '[{"claim_text": "x"}, 5, {"claim_text": " "}, {"claim_text": "y", "source_quote": "q"}]', "b": None, "c": "no array"}
    rows = spark.createDataFrame([("d", k, "text", "text", "p") for k in replies], "doc string, id string, chunk string, contextualized_chunk string, context_prefix string")
    table = spark.createDataFrame(list(replies.items()), "id string, reply string")
    metrics = Metrics()
    joined = rows.join(table, "id")
    found = pipeline.extract_claims(joined, generate=lambda prompt: F.col("reply"), metrics=metrics)
    assert sorted(r["claim_id"] for r in found.collect()) == ["a#1", "a#4"]
    got = metrics.values()
    assert got["claim_replies"] == {"passages": 3, "failed": 1} and got["claims"] == {"elements": 4, "claims": 2, "dropped": 2}
    with pytest.raises(ValueError):
        metrics.watch(rows, "claims", n=F.count(F.lit(1)))


def test_counts_of_chunks_and_triples(spark):
    metrics = Metrics()
    docs = spark.createDataFrame([("d", "The board met and kept the rule. " * 40), ("e", None)], "doc string, text string")
    chunks = pipeline.chunk(docs, metrics=metrics).collect()
    assert metrics.values()["chunks"]["chunks"] == len(chunks) > 1 and metrics.values()["chunks"]["documents"] == 1
    claims = spark.createDataFrame([("c1", "One two three."), ("c2", "Alone")], "claim_id string, claim_text string")
    pipeline.extract_triples(claims, metrics=metrics).collect()
    assert metrics.values()["triples"] == {"claims": 2, "with_empty_slot": 1}
