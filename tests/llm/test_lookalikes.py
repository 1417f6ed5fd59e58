import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glossarch.llm import lookalikes
from glossarch.llm.lookalikes import Transducer, transducer


@pytest.mark.parametrize(
    "a, b",
    [
        ("ｕｓｅ＇ ２００６", "use' 2006"), ("ﬁne diﬀer ﬂow", "fine differ flow"), ("é ñ å", "é ñ å"), ("сору Κorа", "copy Kora"),
        ("real‐time‑x－y", "real-time-x-y"), ("t‍he​ rem\xadote﻿", "the remote"), ("a\xa0b　c d\r\n\n e\t", "a b c d e"),
        (" ​ x ​ ", "x"), ("e​́", "é"), ("ӧ", "ö"), ("µm", "μm"), ("ｶﾞ", "ガ"), ("한", "한"), ("ạ́", "ạ́"), ("", ""), ("​", ""),
    ],
)
def test_same(a, b):
    write = transducer()
    assert write(a) == write(b) == unicodedata.normalize("NFC", write(b))


@pytest.mark.parametrize("a, b", [("A", "a"), ("é", "e"), ("2⁴", "24"), ("x²", "x2"), ("a–b", "a-b"), ("a—b", "a–b"), ("a,", "a"), ("ab", "a b"), ("’", "'"), ("ı", "i")])
def test_different(a, b):
    assert transducer()(a) != transducer()(b)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aeoА е́̈​\xa0　 \nﬁｅ漢가ﾞｶ-‐²️"), max_size=20))
def test_stable(text):
    once = transducer()(text)
    assert transducer()(once) == once


@settings(max_examples=500, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("ｶﾞﾟ̣́각가её᾽")), max_size=12))
def test_composed_in_one_pass(text):
    once = transducer()(text)
    assert unicodedata.is_normalized("NFC", once) and transducer()(once) == once


def test_conflicts_are_found():
    with pytest.raises(ValueError, match="mapped"):
        Transducer({"x": ("а", "a"), "y": ("а", "o")})
    with pytest.raises(ValueError, match="another rule"):
        Transducer({"x": ("аb", "bc")})
    with pytest.raises(ValueError, match="length"):
        Transducer({"x": ("аб", "a")})


def test_pairs(spark, rows):
    data = [("k2", "сopy  it", 9), ("k1", "copy it", 9), ("k3", "copy it", 9), ("k4", "Copy it", 9), ("k5", None, 9), ("k6", "", 9), ("k7", " ", 9), ("k8", "​", 9), (None, "copy it\n", 9)]
    df = spark.createDataFrame(data, "id string, chunk string, form int").withColumn("written", lookalikes.F.lit(1))
    got = rows(lookalikes.same_look_pairs(df.filter("id is not null"), "id", "chunk"))
    assert got == [("k1", "k2"), ("k2", "k3"), ("k7", "k8")]
    groups = {r["key"]: (r["class_id"], r["variants"]) for r in lookalikes.same_look_groups(df, "id", "chunk").collect()}
    assert groups["k1"] == groups["k3"] == groups["k2"] and groups["k1"][1] == 3 and "k4" not in groups
    assert rows(lookalikes.same_look_pairs(df.filter("false"), "id", "chunk")) == []
    long = spark.createDataFrame([("a", "x " * 300_000), ("b", "х　" * 300_000)], "id string, chunk string")
    assert rows(lookalikes.same_look_pairs(long, "id", "chunk")) == [("a", "b")]
