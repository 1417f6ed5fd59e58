import re

from hypothesis import given, settings
from hypothesis import strategies as st

from glossarch.llm import splitting
from glossarch.llm.splitting import Tree, pieces

B = r"[ \t\r\n]"


def brute_boundary(t, limit):
    line = rf"[ \t\r]*\n{B}*"
    for kind, cut in (("paragraph", rf"[ \t\r]*\n[ \t\r]*\n{B}*"), ("line", line), ("sentence", rf"{line}|(?<=[.!?]){B}+"), ("word", rf"{B}+")):
        if max(map(len, re.split(cut, t))) <= limit:
            return kind
    return "none"


texts = st.lists(st.sampled_from(["a", "bcd", ". ", "\n", "\n\n", " ", "! ", "- ", "\n# x\n", "(a) ", "\r\n", "\t", "\nArticle 3\n", "漢字"]), max_size=100).map("".join)


@settings(max_examples=400, deadline=None)
@given(texts, st.integers(4, 60), st.integers(0, 30))
def test_pieces(t, limit, overlap):
    overlap = min(overlap, limit - 1)
    assert Tree(t).boundary(limit) == brute_boundary(t, limit)
    last = 0
    found = pieces(t, limit, overlap)
    if not t.strip(" \t\r\n"):
        assert found == ([(0, 0, len(t))] if t and len(t) <= limit - overlap else [(0, 0, 0)])
        return
    for b, f, e in found:
        assert b <= f < e <= b + limit and f - b <= overlap
        assert not t[last:f].strip(" \t\r\n")
        last = e
    assert not t[last:].strip(" \t\r\n")


def test_headings_open_sections():
    t = "intro " * 10 + "\nArticle 2\n" + "body " * 10 + "body"
    parts = [t[f:e] for _, f, e in pieces(t, 70, 0)]
    assert parts == [("intro " * 10).strip(), "Article 2\n" + "body " * 10 + "body"]


def test_what_an_opened_section_leaves_is_not_merged():
    t = "# One\n" + "alpha beta " * 86 + "\n# Two\n" + "gamma delta " * 55
    parts = [t[f:e] for _, f, e in pieces(t, 900, 0)]
    assert len(parts) == 3 and parts[2].startswith("# Two") and "# Two" not in parts[1]


def test_nested_headings_and_items():
    sub = ["## A\n" + "aa " * 12, "## B\n" + "bb " * 12, "## C\n" + "cc " * 12]
    t = "# One\n" + "\n".join(sub) + "\n# Two\n" + "dd " * 12
    # the subsections of One are merged among themselves, never with Two
    assert [re.findall("[A-C]\n|One|Two", t[f:e]) for _, f, e in pieces(t, 100, 0)] == [["One", "A\n", "B\n"], ["C\n"], ["Two"]]
    numbered = "1 First\n\n" + "x " * 20 + "\n\n1.1 Inner\n\n" + "y " * 20 + "\n\n2 Second\n\n" + "z " * 20
    assert [re.findall(r"First|Inner|Second", numbered[f:e]) for _, f, e in pieces(numbered, 110, 0)] == [["First", "Inner"], ["Second"]]
    items = "- one " + "a " * 10 + "\n  - in " + "b " * 10 + "\n  - in " + "c " * 10 + "\n- two " + "d " * 10
    assert [t2.count("- ") for t2 in (items[f:e] for _, f, e in pieces(items, 85, 0))] == [3, 1]


def test_natural_cuts_are_preferred():
    t = "One sentence here. " * 3 + "\n\n" + "Another one there. " * 3
    assert [t[f:e].strip() for _, f, e in pieces(t, 60, 0)] == [("One sentence here. " * 3).strip(), ("Another one there. " * 3).strip()]


def test_table(spark, rows):
    data = [("none", None), ("empty", ""), ("fits", "x" * 10), ("long", "ab cd ef gh ij kl"), ("blank", " " * 30), ("word", "y" * 25), ("blanks", " " * 20 + "\n\n")]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in data], "id string, chunk string, piece int, boundary string")
    got = splitting.split_oversized(df, "id", "chunk", 10, 3)
    by = {}
    for r in got.orderBy("id", "piece").collect():
        by.setdefault(r["id"], []).append((r["piece"], r["boundary"], r["piece_text"]))
    assert by == {
        "blank": [(1, "word", "")],
        "blanks": [(1, "paragraph", "")],
        "long": [(1, "word", "ab cd"), (2, "word", "cd ef gh"), (3, "word", "gh ij kl")],
        "word": [(1, "none", "y" * 7), (2, "none", "y" * 10), (3, "none", "y" * 10), (4, "none", "y" * 7)],
    }
    assert rows(splitting.split_oversized(df.filter("false"), "id", "chunk")) == []


def test_very_long():
    t = ("Some words. " * 50 + "\n\n") * 800
    found = pieces(t)
    assert all(e - b <= 1000 for b, _, e in found) and len(found) < len(t) / 400
