from glossarch.operators.upsert import current_rows, upsert


def test_upsert(spark, rows):
    old = spark.createDataFrame([("stale", 1, "s"), ("changed", 9, "old")], "key string, ord int, value string")
    new = spark.createDataFrame([("changed", 1, "new"), ("added", 1, "first"), ("added", 2, "last"), (None, 1, "no key")], old.schema)
    assert rows(upsert(old, new, "key", "ord").select("key", "value")) == [("added", "last"), ("changed", "new"), ("stale", "s")]
    assert rows(upsert(old.filter("false"), new.filter("false"), "key", "ord")) == []


def test_current_rows(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", None, "n"), (None, 5, "z")], "id string, run int, v string")
    assert rows(current_rows(df, "id")) == [("a", 2, "y"), ("b", None, "n")]


def test_hot_key_is_cut_before_the_exchange(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)], "id string, run int")
    assert "WindowGroupLimit" in current_rows(df, "id")._jdf.queryExecution().executedPlan().toString()
