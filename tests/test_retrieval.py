import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glossarch.operators import retrieval, vectors
from glossarch.plans.pipeline import Memory, hashed_vector

TEXTS = ["the cat sat", "the dog sat on the mat", "café crème", "", "cat cat dog", "the cat sat", None]


def bm25(query, history):
    docs = [re.findall("[a-z0-9]+", (h or "").lower()) for h in history]
    n, mean = len(docs), sum(map(len, docs)) / max(1, len(docs))
    out = []
    for d in docs:
        s = 0.0
        for t in set(re.findall("[a-z0-9]+", (query or "").lower())):
            if f := d.count(t):
                df = sum(t in x for x in docs)
                s += math.log(1 + (n - df + 0.5) / (df + 0.5)) * f * 2.5 / (f + 1.5 * (0.25 + 0.75 * len(d) / mean))
        out.append(s)
    return out


@pytest.fixture
def passages(spark):
    return spark.createDataFrame([("d", i + 1, t, hashed_vector(t or "").tolist()) for i, t in enumerate(TEXTS)] + [("e", 1, "alone", [])], "doc string, seq int, text string, emb array<float>")


def test_bm25_history(passages):
    got = {(r["seq"], r["hist"]): r["bm25"] for r in retrieval.history_topk(passages, 9, vector=None, dense=0.0, sparse=1.0, scale=False).filter("doc = 'd'").collect()}
    for i, t in enumerate(TEXTS):
        for j, s in enumerate(bm25(t, TEXTS[:i])):
            assert got.get((i + 1, j + 1), 0.0) == pytest.approx(s)


def test_hybrid_matches_sequential_memory(passages):
    best = retrieval.history_topk(passages, 2)
    got = {}
    for r in best.filter("doc = 'd'").orderBy("seq", "place").collect():
        got.setdefault(r["seq"], []).append(r["hist"] - 1)
    memory = Memory(hashed_vector)
    for i, t in enumerate(TEXTS):
        assert got.get(i + 1, []) == memory.best(t or "", 2, 0.6, 0.4)
        memory.add(str(i), i, t or "")
    assert best.filter("doc = 'e'").count() == 0


@pytest.mark.parametrize("block, strip, salt", [(256, 2048, 64), (4, 8, 2)])
def test_blocks_and_strips_match_sequential_memory(spark, monkeypatch, block, strip, salt):
    """A long document in small blocks, strips and salts beside short ones; texts and vectors missing."""
    for name, value in (("QUERY_BLOCK", block), ("STRIP", strip), ("BLOCKS", salt)):
        monkeypatch.setattr(retrieval, name, value)
    rng = np.random.default_rng(1)
    words = ["tax", "rate", "bond", "rule", "the", "of", "x1", "law"]
    rows = [(d, i, None if i % 17 == 5 else " ".join(rng.choice(words, rng.integers(0, 9)))) for d, n in (("long", 70), ("a", 9), ("b", 1)) for i in range(n)]
    df = spark.createDataFrame([(d, i, t, hashed_vector(t or "").tolist()) for d, i, t in rows], "doc string, seq int, text string, emb array<float>")
    for k, gap in ((2, 0), (3, 2)):
        got = {}
        for r in retrieval.history_topk(df, k, gap=gap).orderBy("doc", "seq", "place").collect():
            got.setdefault((r["doc"], r["seq"]), []).append(r["hist"])
        for d in ("long", "a", "b"):
            memory = Memory(hashed_vector)
            for _, i, t in (r for r in rows if r[0] == d):
                want = [j for j in memory.best(t or "", i, 0.6, 0.4) if i - j > gap][:k]
                assert got.get((d, i), []) == want, (d, i)
                memory.add(str(i), i, t or "")


def test_prefix_df(passages):
    rows = retrieval.prefix_df(retrieval.term_frequency(passages, ["doc", "seq"], "text")).filter("term = 'cat'").orderBy("seq").collect()
    assert [(r["seq"], r["df"]) for r in rows] == [(1, 0), (5, 1), (6, 2)]


def test_local_after_topk_without_refill(spark, rows):
    best = spark.createDataFrame([("q", 3, 2), ("q", 3, 1)], "id string, pos int, hist_pos int")
    assert rows(retrieval.without_local(best)) == [("q", 3, 1)]


def corpus(spark, n=40):
    rng = np.random.default_rng(0)
    words = ["tax", "rate", "bond", "rule", "café", "x1"]
    rows = [(f"c{i:02}", " ".join(rng.choice(words, rng.integers(0, 9))), rng.normal(size=64).tolist() if i % 7 else [0.0] * (64 if i % 2 else 3)) for i in range(n)]
    return rows, spark.createDataFrame(rows + [("cn", None, None)], "id string, text string, vector array<double>")


def test_system_search(spark):
    rows, df = corpus(spark)
    rows = rows + [("cn", None, None)]
    search = retrieval.SystemSearch(df, df.filter("id like '%1'"), block=2)
    unit = [np.array(v) / (np.linalg.norm(v) + 1e-12) if v and len(v) == 64 else np.zeros(64) for _, _, v in rows]

    def scaled(x):
        x = np.array(x)
        return (x - x.min()) / (x.max() - x.min()) if x.max() > x.min() else np.zeros(len(x))

    got = {}
    for r in search.best(3).orderBy("query", "place").collect():
        got.setdefault(r["query"], []).append(r["candidate"])
    limits = {r["query"]: r for r in search.limits().collect()}
    for i, (name, text, _) in enumerate(rows):
        if name.endswith("1"):
            dense, sparse = [float(unit[i] @ u) for u in unit], bm25(text, [t for _, t, _ in rows])
            score = 0.6 * scaled(dense) + 0.4 * scaled(sparse)
            want = sorted(range(len(rows)), key=lambda j: (-round(score[j], 9), rows[j][0]))[:3]
            assert got[name] == [rows[j][0] for j in want]
            assert limits[name]["bm25_max"] == pytest.approx(max(sparse)) and limits[name]["dense_min"] == pytest.approx(min(dense))
    assert retrieval.SystemSearch(df.filter("false"), df).best(3).count() == 0
    assert retrieval.SystemSearch(df, df.filter("false")).best(3).count() == 0


def test_dense_topk(spark):
    rows, df = corpus(spark)
    got = {}
    for r in vectors.dense_topk(df, "id", "vector", df.limit(10), 4, block=3).orderBy("query", "place").collect():
        got.setdefault(r["query"], []).append(r["neighbour"])
    good = [(n, np.array(v) / np.linalg.norm(v)) for n, _, v in rows if len(v) == 64 and any(v)]
    for n, v in good:
        if n in got:
            assert got[n] == [m for m, _ in sorted(((m, round(float(v @ w), 9)) for m, w in good if m != n), key=lambda x: (-x[1], x[0]))[:4]]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("ab c", max_size=12), min_size=1, max_size=8))
def test_bm25_is_never_negative(texts):
    memory = Memory(hashed_vector)
    for i, t in enumerate(texts):
        best = memory.best(t, 3, 0.0, 1.0)
        assert len(best) == min(3, i) and all(x >= 0 for x in bm25(t, texts[:i]))
        memory.add(str(i), i, t)


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 2.0]), ([0.0, 0.0], [1.0]), (None, [1.0])], "a array<float>, b array<float>")
    got = df.select(vectors.l2_normalise(df.a), vectors.dot(df.a, df.b)).collect()
    assert got[0][0] == pytest.approx([0.6, 0.8]) and got[0][1] == 11.0
    assert got[1][0] == [0.0, 0.0] and got[1][1] is None and got[2][0] is None
    text = "the cat the café"
    one = spark.createDataFrame([(text,)], "t string")
    v = one.select(vectors.hash_embedding(one.t)).first()[0]
    assert v == pytest.approx(hashed_vector(text).tolist())
