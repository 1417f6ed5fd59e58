import numpy as np
import pytest

from glossarch.llm import spans
from glossarch.llm.spans import compact_windows


def test_every_subsequence_belongs_to_one_window():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(0, 60))
        h, owner, w = rng.integers(0, 12, n).astype(np.uint64), np.sort(rng.integers(0, 4, n)), int(rng.integers(1, 9))
        windows = list(zip(*(x.tolist() for x in compact_windows(h, owner, w))))
        for i in range(n):
            for j in range(i + w - 1, n):
                if owner[i] == owner[j]:
                    assert [c for l, c, r in windows if l <= i <= c <= j <= r] == [i + int(np.argmin(h[i : j + 1]))]
        for l, c, r in windows:  # and none can be wider
            assert r - l + 1 >= w and owner[l] == owner[r] and int(np.argmin(h[l : r + 1])) == c - l
            assert l == 0 or owner[l - 1] != owner[c] or h[l - 1] <= h[c]
            assert r == n - 1 or owner[r + 1] != owner[c] or h[r + 1] < h[c]


def test_cartesian_tree_of_sorted_hashes():
    h = np.arange(5000).astype(np.uint64)
    l, r = spans.cartesian(h, np.zeros(5000, int))
    assert (l == np.arange(5000)).all() and (r == 4999).all()
    l, r = spans.cartesian(h[::-1].copy(), np.zeros(5000, int))
    assert (l == 0).all() and (r == np.arange(5000)).all()


def grams(t, n):
    w = [x for x in (t or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if x]
    return [tuple(w[i : i + n]) for i in range(len(w) - n + 1)], len(w)


def brute(data, n):
    g = {r: (d, set(grams(t, n)[0])) for r, d, t in data}
    pairs = sorted((a, b) for a in g for b in g if a < b and g[a][0] != g[b][0] and g[a][1] & g[b][1])
    covered = {}
    for r, d, t in data:
        own, size = grams(t, n)
        places = set()
        for i, x in enumerate(own):
            if any(x in s and e != d for o, (e, s) in g.items() if o != r):
                places |= set(range(i, i + n))
        if places:
            covered[r] = (size, len(places))
    return pairs, covered


@pytest.fixture
def data():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    base = [list(rng.choice(words, 120)) for _ in range(4)]
    out = []
    for i in range(50):
        t = list(rng.choice(words, int(rng.integers(0, 40))))
        src = base[i % 4]
        a, n = int(rng.integers(0, 90)), int(rng.integers(1, 30))
        out.append((f"r{i:02}", f"d{i % 7}", "  \n".join(t[:10] + src[a : a + n] + t[10:])))
    copy = " ".join(base[0])
    return out + [("n1", "d1", None), ("n2", "d2", ""), ("c1", "d8", copy), ("c2", "d9", copy), ("c3", "d9", copy.replace(" ", "\t")), ("nd", None, copy), ("loop", "d3", "x y " * 4000), ("loop2", "d4", "x y " * 30)]


@pytest.mark.parametrize("least", [5, 8, 25])
def test_against_all_pairs(spark, rows, data, least):
    df = spark.createDataFrame([(r, d, t, "z", 1) for r, d, t in data], "rid string, doc string, text string, run string, words int")
    shared = spans.shared_runs(df, least)
    pairs, covered = brute(data, least)
    got = sorted(tuple(sorted(p)) for p in rows(spans.sharing_pairs(shared)))
    assert got == pairs
    found = {r["rid"]: (r["words"], r["shared_words"]) for r in spans.stretches(shared, least).collect()}
    assert found == covered


def test_empty(spark, rows):
    df = spark.createDataFrame([], "rid string, doc string, text string")
    shared = spans.shared_runs(df)
    assert rows(spans.sharing_pairs(shared)) == [] == rows(spans.stretches(shared))


def test_one_run_for_a_stretch(spark):
    """Of a long stretch that several records share as a whole only its first run is met in pairs."""
    long = " ".join(f"s{i}" for i in range(400))
    df = spark.createDataFrame([(f"r{i}", f"d{i}", f"a{i} b{i} " + long + f" c{i}") for i in range(6)] + [("part", "dp", "x y " + long[100:])], "rid string, doc string, text string")
    shared = spans.shared_runs(df)
    assert shared.count() > 6 * 370
    assert shared.filter("first").select("run").distinct().count() == 2
    assert spans.sharing_pairs(shared).count() == 21


def test_passages_that_are_nearly_the_same(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(5000)]

    def noise(n):
        return list(rng.choice(words, n))

    plants, rows_ = {}, []
    for i in range(30):
        passage = noise(80)
        edited = list(passage)
        for at in rng.choice(80, 1, replace=False):
            edited[at] = "changed"
        a, b = int(rng.integers(0, 60)), int(rng.integers(0, 60))
        rows_ += [(f"a{i:02}", f"da{i}", " ".join(noise(a) + passage + noise(30))), (f"b{i:02}", f"db{i}", " ".join(noise(b) + edited + noise(20)))]
        plants[i] = a, b
    rows_ += [("n", "d", None), ("e", "d", ""), ("s", "d", "few words"), ("same1", "dd", rows_[0][2]), ("far", "df", " ".join(noise(200)))]
    df = spark.createDataFrame([(*r, 1) for r in rows_], "rid string, doc string, text string, a int")
    found = spans.alike_passages(df).collect()
    assert all(r["similarity"] >= 0.8 and r["last_a"] - r["first_a"] >= 24 for r in found)
    met = {}
    for r in found:
        for x, y in ((("a"), ("b")), (("b"), ("a"))):
            if r[x][0] == "a" and r[y][0] == "b" and r[x][1:] == r[y][1:]:
                met.setdefault(int(r[x][1:]), []).append((r[f"first_{x}"], r[f"last_{x}"], r[f"first_{y}"]))
    assert len(met) >= 29
    for i, each in met.items():
        a, b = plants[i]
        # each lies on the planted passage in both records, but for a few words around it
        assert all(max(first, a) - min(last, a + 79) < -20 and abs((first - a) - (other - b)) <= 20 for first, last, other in each)
    assert sum(any(last - first >= 50 for first, last, _ in each) for each in met.values()) >= 15  # across the edit
    assert any({r["a"], r["b"]} == {"a00", "same1"} for r in found) and not any("far" in (r["a"], r["b"]) for r in found)
    assert spans.alike_passages(df.filter("false")).collect() == []
