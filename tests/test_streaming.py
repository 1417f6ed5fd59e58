from glossarch.plans import pipeline
from glossarch.streaming import tables


def test_upserted_table(spark, tmp_path, rows):
    source, at = tmp_path / "in", str(tmp_path / "table")
    table = tables.VersionedTable(spark, at)
    assert table.read() is None
    for n, batch in enumerate([[("a", 1, "x"), ("b", 1, "y")], [("a", 2, "z"), ("c", 1, "w")], [("c", 0, "late")]]):
        spark.createDataFrame(batch, "key string, ord int, value string").coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("key string, ord int, value string").parquet(str(source))
        tables.keep_upserted(stream, table, "key", "ord", str(tmp_path / "check")).awaitTermination()
    assert rows(table.read().select("key", "value")) == [("a", "z"), ("b", "y"), ("c", "late")]
    assert len(table.versions()) <= 2
    last = table.versions()[-1]
    table.upsert(table.read().filter("false"), "key", "ord", last)
    assert table.versions()[-1] == last


def test_chunks_and_history(spark, tmp_path):
    text = "The board met on the rule. The rule was kept. The levy was raised by the board. " * 3
    docs = spark.createDataFrame([("a", text), ("b", "One passage only.")], "doc string, text string")
    docs.write.parquet(str(tmp_path / "docs"))
    stream = tables.chunk_stream(spark.readStream.schema(docs.schema).parquet(str(tmp_path / "docs")))
    stream.writeStream.format("memory").queryName("chunks_now").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("chunks_now").count() == pipeline.chunk(docs).count()

    passages = [("a", f"a_{i}", i, t) for i, t in enumerate(["tax rule", "bond levy", "tax rate", "levy bond"])]
    for part in (passages[:2], passages[2:]):
        spark.createDataFrame(part, "doc string, id string, pos int, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "p"))
    read = spark.readStream.schema("doc string, id string, pos int, text string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "p"))
    tables.history_stream(read, 1).writeStream.format("memory").queryName("found_now").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = {r["id"]: r["found"] for r in spark.table("found_now").collect()}
    assert got["a_0"] == [] and got["a_2"] == ["a_0"] and got["a_3"] == ["a_1"]
