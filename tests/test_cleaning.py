import re

import pytest
from pyspark.sql import functions as F

from glossarch.operators import cleaning

CASES = {
    "quotes": ["‘a’ “b” c–d—e\xa0f"],
    "newlines": ["a\r\nb\rc", "a\n\n\n\nb", "a\n \n\t\nb", "a\n\nb"],
    "markers": ["(1)\n\nSome", "(a)\n\n(b)\ntext (12)\n y", "(EU)\n(2) x", "(A)\nb", "x)\n\n(y"],
    "join_lines": ["mid\nsentence", "end.\nNext", "a!\nb?\nc;\nd:\ne", "a\nb\nc\nd", "\nlead", "x\n\ny", "x.\n\nY z\nw", "a\n b"],
    "spacing": ["  (a) x\n\t(1) y", "a   b", " a \n b ", "a , b ; c : d .", "a\n.b", "  x  ", "", " "],
}


def python_steps(text, *names):
    s, n = cleaning.S.replace(r"\x{", "{"), None
    s = "[\t-\r\x1c-\x20\x85\xa0  -     　]"
    not_s = "[^" + s[1:]
    for name in names:
        if name == "quotes":
            text = text.translate({ord(a): b for a, b in cleaning.PLAIN.items()})
        elif name == "newlines":
            text = re.sub(rf"\n{s}*\n{s}*\n+", "\n\n", re.sub("\r\n?", "\n", text))
        elif name == "markers":
            text = re.sub(rf"\((\d+|[a-z])\){s}*\n+{s}*", r"(\1) ", text)
            text = re.sub(rf"\){s}*\n+{s}*\(", ")\n(", text)
            text = re.sub(rf"\(([a-z])\){s}*\n{s}*", r"(\1) ", text)
        elif name == "join_lines":
            text = re.sub(rf"(?<![.!?;:])\n(?={not_s})", " ", text)
        else:
            text = re.sub(r"(?m)^[ \t]+(\([a-z0-9]+\))", r"\1", text)
            text = re.sub(r"[ \t]*\n[ \t]*", "\n", re.sub(" {2,}", " ", text))
            text = re.sub(rf"{s}+([,.;:])", r"\1", text).strip()
    return text


@pytest.mark.parametrize("name", list(CASES))
def test_step(spark, name):
    df = spark.createDataFrame([(t,) for t in CASES[name]], "t string")
    got = [r[0] for r in df.select(cleaning.steps(F.col("t"), name)).collect()]
    assert got == [python_steps(t, name) for t in CASES[name]]


def test_whole(spark):
    texts = [t for c in CASES.values() for t in c] + [" ".join(t for c in CASES.values() for t in c), None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(cleaning.clean(F.col("t"))).collect()]
    assert got == [None if t is None else python_steps(t, *cleaning.STEPS) for t in texts]


def test_marker_lines_end_joined(spark):
    df = spark.createDataFrame([("(a)\n\n(b)\ntext (12)\n y",)], "t string")
    assert df.select(cleaning.clean(F.col("t"))).first()[0] == "(a) (b) text (12) y"
