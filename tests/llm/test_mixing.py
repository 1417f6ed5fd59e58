import pytest

from glossarch.llm import mixing
from glossarch.llm.mixing import Allotment, fill

WEIGHTS = "source string, target_share double, max_repeats int"


def test_fill():
    def tokens(total, *sources):
        return [s.tokens for s in fill([Allotment(str(i), w, m, n) for i, (w, m, n) in enumerate(sources)], total)]

    assert tokens(100, (0.5, 1, 1000), (0.5, 1, 1000)) == [50, 50]
    assert tokens(100, (0.5, 1, 1000), (0.5, 2, 10)) == [80, 20]
    # the excess of one fills the next
    assert tokens(100, (0.4, 1, 1000), (0.3, 1, 10), (0.3, 1, 35)) == [55, 10, 35]
    assert tokens(1000, (0.5, 2, 10), (0.5, 1, 10)) == [20, 10]
    assert tokens(100, (0.5, 1, 0), (0.5, 1, 500), (0.0, 9, 500)) == [0, 100, 0]
    assert tokens(100) == []


def test_mixture(spark):
    docs = [(i, "big", 10) for i in range(3000)] + [(10_000 + i, "small", 7) for i in range(300)] + [(20_000 + i, "unknown", 5) for i in range(50)] + [(1, None, 9), (2, "big", 0), (3, "small", None)]
    df = spark.createDataFrame([(k, s, n, 5) for k, s, n in docs], "key bigint, source string, tokens bigint, repeats int")
    weights = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 4), ("absent", 0.2, 3), ("void", None, 3), (None, 0.4, 1), ("small", 0.1, 9)], WEIGHTS)
    mixed, plan = mixing.mixture(df, weights)
    rows = {r["source"]: r for r in mixing.shares(mixed, plan).collect()}
    assert set(rows) == {"big", "small", "absent", "void"}
    # small is held at four epochs, big takes the rest
    assert rows["small"]["tokens"] == 4 * 2100 and rows["small"]["most_repeats"] == 4 and rows["small"]["epochs"] == 4.0
    assert rows["big"]["tokens"] == pytest.approx(32100 - 8400, rel=0.002) and rows["big"]["most_repeats"] == 1
    assert rows["absent"]["tokens"] == rows["void"]["tokens"] == 0 and sum(r["share"] for r in rows.values()) == pytest.approx(1)
    again = {tuple(r) for r in mixing.mixture(df, weights)[0].collect()}
    assert again == {tuple(r) for r in mixed.collect()} != {tuple(r) for r in mixing.mixture(df, weights, seed=1)[0].collect()}
    half, plan = mixing.mixture(df, weights, total=3000)
    got = {r["source"]: r["tokens"] for r in mixing.shares(half, plan).collect()}
    assert got["big"] == pytest.approx(1500, abs=15) and got["small"] == pytest.approx(1500, abs=15)


def test_fractions_add_to_whole_repeats(spark):
    df = spark.createDataFrame([(i, "a", 1 + i % 5) for i in range(1000)] + [(5000 + i, "b", 100) for i in range(300)], "key bigint, source string, tokens bigint")
    weights = spark.createDataFrame([("a", 0.25, 9), ("b", 0.75, 9)], WEIGHTS)
    mixed, plan = mixing.mixture(df, weights)
    repeats = {r["repeats"] for r in mixed.filter("source = 'a'").select("repeats").distinct().collect()}
    epochs = next(s.epochs for s in plan if s.source == "a")
    assert repeats == {int(epochs), int(epochs) + 1}
    assert {r["source"]: r["share"] for r in mixing.shares(mixed, plan).collect()}["a"] == pytest.approx(0.25, abs=0.002)


def test_one_long_document(spark):
    """A document of a third of its source: the share reached is off by half of it at most, and by little where it lies elsewhere in the order."""
    df = spark.createDataFrame([(i, "a", 100) for i in range(200)] + [(900, "a", 10_000)] + [(1000 + i, "b", 100) for i in range(400)], "key bigint, source string, tokens bigint")
    weights = spark.createDataFrame([("a", 0.3, 3), ("b", 0.7, 3)], WEIGHTS)
    off = []
    for seed in range(3):
        for s in mixing.shares(*mixing.mixture(df, weights, total=50_000, seed=seed)).collect():
            off.append(abs(s["tokens"] - s["planned_tokens"]))
            assert off[-1] <= (5_000 if s["source"] == "a" else 50)
    assert min(off) <= 50


def test_empty(spark):
    df = spark.createDataFrame([], "key bigint, source string, tokens bigint")
    weights = spark.createDataFrame([("a", 1.0, 2)], WEIGHTS)
    mixed, plan = mixing.mixture(df, weights)
    assert mixed.count() == 0 and [tuple(r)[5] for r in mixing.shares(mixed, plan).collect()] == [0]
    mixed, plan = mixing.mixture(df, weights.filter("false"))
    assert mixed.count() == 0 and mixing.shares(mixed, plan).count() == 0
