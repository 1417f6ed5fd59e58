import math
import re
from collections import Counter

import pytest

from glossarch.llm import terms

DATA = [("a", "Tax tax rate"), ("b", "tax bond"), ("c", "rate rate BOND café"), ("d", None), ("e", ""), ("f", "—"), ("g", "tax bond"), ("h", "long " * 50_000 + "tax")]


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(k, t, "x", 0) for k, t in DATA], "id string, body string, term string, n int")


def test_scores(df):
    counts = {k: Counter(re.findall("[a-z0-9]+", t.lower())) for k, t in DATA if t}
    df_, n = Counter(w for c in counts.values() for w in c), sum(t is not None for _, t in DATA)
    total, cf = sum(sum(c.values()) for c in counts.values()), sum(counts.values(), Counter())
    got = {(r["key"], r["term"]): r for r in terms.distinctive_terms(df, "id", "body").collect()}
    assert set(got) == {(k, w) for k, c in counts.items() for w in c if df_[w] >= 2}
    for (k, w), r in got.items():
        o, e = counts[k][w], sum(counts[k].values()) * cf[w] / total
        assert (r["tf"], r["records"], r["n"]) == (o, df_[w], n)
        assert r["score"] == pytest.approx(o * math.log(n / df_[w]), abs=1e-6)
        assert r["residual"] == pytest.approx((o - e) / math.sqrt(e))
        assert r["adjusted"] == pytest.approx((o - e) / math.sqrt(e) / math.sqrt((1 - sum(counts[k].values()) / total) * (1 - cf[w] / total)))


def test_best_and_ties(df, rows):
    best = {r["key"]: r["term"] for r in terms.best_terms(terms.distinctive_terms(df, "id", "body")).collect()}
    assert best == {"a": "rate", "b": "bond", "c": "rate", "g": "bond", "h": "tax"}


def test_rare_terms_take_the_other_way(df, rows, monkeypatch):
    want = rows(terms.distinctive_terms(df, "id", "body").select("key", "term", "score"))
    monkeypatch.setattr(terms, "HEAVY_TERMS", 1)
    assert rows(terms.distinctive_terms(df, "id", "body").select("key", "term", "score")) == want


def test_empty(df, rows):
    assert rows(terms.best_terms(terms.distinctive_terms(df.filter("false"), "id", "body"))) == []
    alone = terms.distinctive_terms(df.filter("id = 'a'"), "id", "body", least=1)
    assert alone.filter("adjusted is not null").count() == 0 and alone.count() == 2
