from fractions import Fraction

import numpy as np
import pytest

from glossarch.llm import partenum
from glossarch.llm.partenum import signatures
from glossarch.plans.scratch import written


def grams(t, n=3):
    w = (t or "").lower().replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ")
    w = [x for x in w if x]
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def brute(data, least=0.6, n=3):
    sets = {k: g for k, t in data if (g := grams(t, n))}
    return sorted((a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) * 10 >= round(least * 10) * len(sets[a] | sets[b]))


def texts(seed=0, n=120):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        size = int(rng.integers(1, 150)) if i % 3 else int(rng.integers(1, 12))
        base = list(rng.choice(words, size))
        out.append(base)
        if i % 2:
            for _ in range(3):
                edit = list(base)
                for _ in range(int(rng.integers(0, max(2, size // 8)))):
                    at = int(rng.integers(0, len(edit)))
                    edit[at : at + 1] = [] if rng.random() < 0.3 and len(edit) > 1 else [str(rng.choice(words))]
                out.append(edit)
    return [(f"k{i:04}", " ".join(t)) for i, t in enumerate(out)]


@pytest.mark.parametrize("least", [Fraction(6, 10), Fraction(8, 10)])
def test_against_all_pairs(spark, rows, least):
    data = texts() + [("e1", ""), ("e2", None), ("s1", "two words"), ("c1", "A b\tc d"), ("c2", "a  B\nC d"), ("l1", "x y z " * 20_000), ("l2", "x y z " * 20_000 + "q")]
    df = spark.createDataFrame([(k, t, 1, 2) for k, t in data], "id string, body string, kind int, class int")
    sets = written(partenum.sets_of(df, 0, "id", "body"), "t")
    similar = partenum.similar_classes(sets, least)
    assert rows(partenum.record_pairs(sets, similar)) == brute(data, float(least))


def test_kinds_do_not_meet_and_groups(spark, rows):
    a = spark.createDataFrame([("a1", "p q r s t"), ("a2", "p q r s t"), ("a3", "p q r s t u"), ("a4", "q r s t u v"), ("a5", "other words are here")], "id string, body string")
    b = a.withColumn("id", partenum.F.concat(partenum.F.lit("b"), "id"))
    sets = written(partenum.sets_of(a, 0, "id", "body").unionByName(partenum.sets_of(b, 1, "id", "body")), "t")
    similar = partenum.similar_classes(sets, Fraction(6, 10))
    one = brute([tuple(r) for r in a.collect()])
    assert rows(partenum.record_pairs(sets, similar)) == sorted(one + [("b" + x, "b" + y) for x, y in one])
    got = {r["key"]: (r["class_id"], r["links"], r["group_id"]) for r in partenum.groups(sets, similar).collect()}
    assert got["a1"] == got["a2"] == ("a1", 1, "a1") and got["a3"] == ("a3", 2, "a1") and got["a4"] == ("a4", 1, "a1") and got["a5"] == ("a5", 0, "a5")
    assert got["ba4"] == ("ba4", 1, "ba1")


def test_empty(spark, rows):
    df = spark.createDataFrame([], "id string, body string")
    sets = written(partenum.sets_of(df, 0, "id", "body"), "t")
    similar = partenum.similar_classes(sets, Fraction(6, 10))
    assert rows(partenum.record_pairs(sets, similar)) == [] == rows(partenum.groups(sets, similar))
    with pytest.raises(ValueError):
        partenum.similar_classes(sets, Fraction(1, 3))


def test_no_similar_pair_is_without_a_common_signature():
    rng = np.random.default_rng(1)
    for least in (Fraction(1, 2), Fraction(6, 10), Fraction(8, 10)):
        for _ in range(400):
            a = int(rng.choice([1, 2, 3, 9, 10, 12, 39, 40, 41, 66, 100, 159, 160, 300]))
            one = set(rng.integers(0, 2**62, a).tolist())
            two = set(list(one)[int(rng.integers(0, a * (1 - float(least)) + 1)) :]) | set(rng.integers(0, 2**62, int(rng.integers(0, a * (1 / float(least) - 1) + 1))).tolist())
            if not two or len(one & two) < least * len(one | two):
                continue
            h = np.array(sorted(one) + sorted(two), np.uint64)
            size = np.array([len(one), len(two)])
            counts = rng.integers(2, 9, 1 << 9).astype(np.uint8)
            seen, rare = counts[(h % np.uint64(len(counts))).astype(np.int64)], int(rng.choice([0, 3, 5, 9]))
            s, w = signatures(h, np.repeat([0, 1], size), size, seen, least, rare)
            assert set(s[w == 0].tolist()) & set(s[w == 1].tolist())
            # if common elements alone are shared, the single ones of the first places meet, too
            if all(seen[i] > rare for i in np.flatnonzero(np.isin(h, list(one & two)))):
                s, w = signatures(h, np.repeat([0, 1], size), size, seen, least, rare, alone=True)
                assert set(s[w == 0].tolist()) & set(s[w == 1].tolist())


@pytest.mark.parametrize("hot,side", [(4, 2048), (2, 8)])
def test_hot_signatures_chunks_and_buckets(spark, rows, monkeypatch, hot, side):
    """A third of the texts has a long passage in common; signatures are hot, chunks, buckets and blocks small."""
    for name, value in (("HOT", hot), ("SIDE", side), ("CHUNK", 500), ("BUCKET", 700), ("RARE", 3)):
        monkeypatch.setattr(partenum, name, value)
    rng = np.random.default_rng(5)
    passage = " ".join(f"p{i}" for i in range(60))
    data = texts(3, 60) + [(f"h{i:03}", passage + " " + " ".join(f"x{n}" for n in rng.integers(0, 50, int(rng.integers(1, 60))))) for i in range(60)]
    df = spark.createDataFrame(data, "id string, body string")
    sets = written(partenum.sets_of(df, 0, "id", "body"), "t")
    assert rows(partenum.record_pairs(sets, partenum.similar_classes(sets, Fraction(6, 10)))) == brute(data)


def test_connected_long_chain(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "class_a bigint, class_b bigint")
    top = {r["class"]: r["top"] for r in partenum.connected(pairs).collect()}
    assert top == {i: 0 for i in range(61)} | {100: 100, 101: 100}
