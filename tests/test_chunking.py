import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glossarch.operators import chunking
from glossarch.operators.chunking import _Facts, default_cost, spans


@pytest.mark.parametrize(
    "word, ok",
    [("Word", True), ("2024", True), ("2023.", True), ("8B", True), ("12th", False), ("1,", False), ("72.3", False), ("(a)", True), ("(24)", True), ("1a)", True), ("_x", False), ("•", False), ("«été", True), ("—", False), ("1,000", False), ("2023))", False)],
)
def test_start(spark, word, ok):
    assert spark.range(1).select(chunking.start_valid(F.lit(word))).first()[0] is ok
    assert _Facts(default_cost)[word][2] is ok


def test_windows():
    facts = _Facts(lambda w: 1)
    words = [f"w{i}" for i in range(10)]
    assert spans([], facts) == [] == spans(["—", "•"], facts)
    assert spans(words, facts, 10, 2) == [(0, 10)]
    assert spans(words, facts, 9, 2) == [(0, 9), (7, 10)]
    assert spans(words, facts, 4, 0) == [(0, 4), (4, 8), (8, 10)]
    # the tail that only repeats is not emitted
    assert spans(words[:5], facts, 5, 2) == [(0, 5)]
    # a word dearer than the limit stands alone
    dear = _Facts(lambda w: 9 if w == "w1" else 1)
    assert spans(words[:3], dear, 4, 1) == [(0, 1), (1, 2), (2, 3)]


def test_rejected_start_drops_the_window():
    words = ["a", "b", "c", "1,", "d", "e", "f", "g"]
    assert spans(words, _Facts(lambda w: 1), 4, 1) == [(0, 4), (7, 8)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb-c", "1,", "—", "2024", "(x)", "d.e.f"]), max_size=60), st.integers(1, 12), st.integers(0, 11))
def test_invariants(words, size, overlap):
    facts = _Facts(default_cost)
    found = spans(words, facts, size, overlap)
    cost = lambda a, b: sum(facts[w][0] for w in words[a:b])
    for a, b in found:
        assert cost(a, b) <= size or b == a + 1
        assert facts[words[a]][1] and facts[words[a]][2]
    for (a, b), (c, d) in zip(found, found[1:]):
        assert d > b and c > a
        # symbols between the overlap's start and the window are passed over
        start = c
        while start and not facts[words[start - 1]][1]:
            start -= 1
        assert c >= b or cost(start, b) >= overlap


def test_chunked(spark, rows):
    df = spark.createDataFrame([("d", "one two three"), ("e", ""), ("f", None), ("g", "• —"), (None, "x")], "doc string, text string")
    assert rows(chunking.chunked(df, "doc", "text", 2, 1)) == [("d", 1, "d_1", 0, 1, 2, "one two"), ("d", 2, "d_2", 1, 2, 2, "two three")]
    assert rows(chunking.chunked(df.filter("false"), "doc", "text")) == []


def test_id_suffix(spark):
    ids = ["d_2", "d_10", "plain", "x_99999999999", "x_99999999999999999999", "a_b_3", None]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    assert [r[0] for r in df.select(chunking.id_suffix(F.col("id"))).collect()] == [2, 10, 10**9, 99999999999, 10**9, 3, 10**9]
