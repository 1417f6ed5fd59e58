import pytest
from pyspark.sql import functions as F

from glossarch.operators import context


@pytest.fixture
def union(spark):
    local = spark.createDataFrame([("q", 0, "a", "A")], "query string, rank int, id string, text string")
    doc = spark.createDataFrame([("q", 1, "a", "A"), ("q", 2, "b", "B"), ("q", 3, "w", " "), ("r", 1, "b", "B")], local.schema)
    system = spark.createDataFrame([("q", 1, "b", "sysB"), ("q", 2, "c", "C"), ("q", 3, "n", None)], local.schema)
    return context.candidates({"local_before": local, "doc": doc, "system": system})


def test_first_occurrence_wins(union, rows):
    got = rows(context.first_by_id(union).select("query", "id", "kind"))
    assert got == [("q", "a", "local_before"), ("q", "b", "doc"), ("q", "c", "system"), ("q", "n", "system"), ("q", "w", "doc"), ("r", "b", "doc")]


def test_relevance_fails_closed(spark, union, rows):
    found = context.first_by_id(union)
    none = spark.createDataFrame([], "query string, id string")
    assert rows(context.relevant(found, none).select("query", "id")) == [("q", "a")]
    some = spark.createDataFrame([("q", "c"), ("q", "w"), ("q", "c")], "query string, id string")
    assert rows(context.relevant(found, some).select("query", "id")) == [("q", "a"), ("q", "c")]


def test_buckets_and_ids(union, rows):
    found = context.first_by_id(union)
    got = {r["query"]: r for r in context.buckets(found).collect()}
    assert got["q"]["local_before"] == "A" and got["q"]["local_after"] == ""
    assert got["q"]["doc"] == "B\n\n---\n\n " and got["q"]["system"] == "C\n\n---\n\n"
    ids = {r["query"]: r for r in context.id_lists(found).collect()}
    assert ids["q"]["local_neighbor_ids"] == ["a"] and ids["q"]["doc_retrieved_ids"] == ["b", "w"] and ids["r"]["system_retrieved_ids"] == []


def test_neighbours(spark):
    df = spark.createDataFrame([("d", f"d_{i}", i, f"t{i}") for i in range(1, 5)] + [("e", "e_1", 1, "x")], "doc string, id string, pos int, text string")
    got = {r["id"]: ([e["id"] for e in r["before"]], [e["id"] for e in r["after"]]) for r in context.neighbours(df, 2, 1).collect()}
    assert got == {"d_1": ([], ["d_2"]), "d_2": (["d_1"], ["d_3"]), "d_3": (["d_1", "d_2"], ["d_4"]), "d_4": (["d_2", "d_3"], []), "e_1": ([], [])}
    assert all(not r["before"] and not r["after"] for r in context.neighbours(df, 0, 0).collect())


def test_combined(spark):
    df = spark.createDataFrame([(" note ", "text"), ("", "text"), (None, None)], "reply string, chunk string")
    prefix, whole = context.combined("prefix", F.col("reply"), F.col("chunk"))
    assert [tuple(r) for r in df.select(prefix, whole).collect()] == [("note", "note text"), (context.NO_CONTEXT, context.NO_CONTEXT + " text"), (context.NO_CONTEXT, context.NO_CONTEXT + " ")]
    prefix, whole = context.combined("rewrite", F.col("reply"), F.col("chunk"))
    assert [tuple(r) for r in df.select(prefix, whole).collect()] == [("note", "note"), ("text", "text"), ("", "")]
    with pytest.raises(ValueError):
        context.combined("other", F.col("reply"), F.col("chunk"))
