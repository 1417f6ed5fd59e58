from collections import namedtuple

import numpy as np
import pytest

from glossarch.operators import retrieval
from glossarch.plans.pipeline import Memory, _around


def _table(spark, n):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(12)] + ["the"] * 12
    rows = [(f"c{i:03}", " ".join(rng.choice(words, rng.integers(0, 12))), np.abs(rng.normal(size=64)).tolist() if i % 9 else None) for i in range(n)]
    rows += [(f"d{i}", rows[i][1], rows[i][2]) for i in range(8)]  # copies
    return rows, spark.createDataFrame(rows, "id string, text string, vector array<double>")


def test_search_copies_neither_side(spark):
    # each query block once met each strip in a group of its own, copies of both sides in between: disk was quadratic
    _, df = _table(spark, 60)
    plan = retrieval.SystemSearch(df, df, block=2, strip=4).best(1)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "explode" not in plan.lower() and "CoGroup" not in plan


@pytest.mark.parametrize("cells", [128, 3])
def test_parts_left_out_hold_none_of_the_best(spark, monkeypatch, cells):
    monkeypatch.setattr(retrieval, "CELLS", cells)
    rows, df = _table(spark, 60)
    n, texts = len(rows), [t.split() for _, t, _ in rows]
    unit = np.array([np.array(v) / (np.linalg.norm(v) + 1e-12) if v else np.zeros(64) for _, _, v in rows])
    mean, d, s = np.mean([len(t) for t in texts]), unit @ unit.T, np.zeros((n, n))
    for q in range(n):
        for t in set(texts[q]):
            df_t = sum(t in x for x in texts)
            for c in range(n):
                tf = texts[c].count(t)
                s[q, c] += np.log(1 + (n - df_t + 0.5) / (df_t + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(texts[c]) / mean))
    search = retrieval.SystemSearch(df, df, block=16, strip=4)
    scaled = lambda x: (x - x.min(1, keepdims=True)) / np.where(np.ptp(x, axis=1) > 0, np.ptp(x, axis=1), np.inf)[:, None]
    for k, weights, scale in ((1, (0.6, 0.4), True), (3, (0.6, 0.4), True), (2, (0.0, 1.0), False), (2, (0.5, -0.3), True), (70, (1.0, 0.0), True)):
        score = np.round(sum(w * (scaled(x) if scale else x) for w, x in zip(weights, (d, s))), 9)
        got = {}
        for r in search.best(k, *weights, scale=scale).orderBy("query", "place").collect():
            got.setdefault(r["query"], []).append((r["candidate"], r["score"]))
        for q in range(n):
            want = sorted(range(n), key=lambda c: (-score[q, c], rows[c][0]))[:k]
            assert [c for c, _ in got[rows[q][0]]] == [rows[c][0] for c in want], (k, weights, rows[q][0])
            assert [x for _, x in got[rows[q][0]]] == pytest.approx([score[q, c] for c in want], abs=1e-8)


def test_neighbours_in_a_stream():
    Row = namedtuple("Row", "doc pos")
    rows = [Row(doc, i) for doc, n in (("a", 5), ("b", 1), (None, 2), ("c", 3)) for i in range(n)]
    for before in range(3):
        for after in range(3):
            got = list(_around(iter(rows), before, after))
            assert [r for r, _, _ in got] == rows
            for r, b, a in got:
                assert [x.pos for x in b] == [p for p in range(r.pos - before, r.pos) if p >= 0] and all(x.doc == r.doc for x in (*b, *a))
                assert [x.pos for x in a] == [x.pos for x in rows if x.doc == r.doc and r.pos < x.pos <= r.pos + after]


def test_memory_grows_past_its_room():
    memory = Memory(lambda text: np.eye(3)[len(text) % 3])
    for i in range(200):
        memory.add(str(i), i, f"word{i} the")
    assert memory.best("word150", 1, 0.0, 1.0) == [150] and memory.best("the", 3, 0.0, 1.0) == [0, 1, 2] and memory.best("none", 2, 0.0, 1.0) == [0, 1]
