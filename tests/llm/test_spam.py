import numpy as np
import pytest

from glossarch.llm import spam

PROSE = "The council shall examine each report in the light of the annual review, and the board may ask for more evidence before it decides on the matter. "
PAGES = {
    "keywords": "cheap loans online cheap loans near me best cheap loans download " * 12,
    "links": "\n".join(f"https://site{i}.example/page/{i} some offer" for i in range(40)),
    "tags": "Tags: " + ", ".join(f"alpha{i} beta{i}" for i in range(80)),
    "hash": " ".join(f"#Tag{i}Word" for i in range(80)),
    "products": " ".join(f"Item {i} wool shirt EUR {i}.50 in stock" for i in range(40)),
}
FINE = {
    "prose": "".join(f"In the year {1900 + i} the office number {i} sent word{i} to agency{i} about matter{i}, which the court then weighed. " for i in range(20)),
    "contents": "\n".join(f"Article {i} On the matter of subject{i} ..... {i * 3}" for i in range(40)),
    "numbers": "\n".join(f"{1990 + i}  {i}.3  {i * 7},1" for i in range(60)),
    "few": PROSE + "Keywords: tax, rate, bond, fund. " + PROSE + PROSE,
    "attendees": "Present: " + ", ".join(f"the delegate of Name{i} Board{i}" for i in range(30)),
    "code": "def f(x):\n\treturn {'k': [x**2, None]}  # the first value of the table that was given by the user\n" * 6,
    "link": PROSE + "see https://a.example/b " + PROSE,
    "short": "a, b, c",
    "empty": "",
    "blank": " \n\t",
}


def test_kinds(spark):
    data = [(k, t, "EN") for k, t in {**PAGES, **FINE}.items()] + [("null", None, None), ("copy", PAGES["tags"], None), ("half", PAGES["tags"] + " " + PROSE * 30, "en"), ("long", PROSE * 5000, "en")]
    df = spark.createDataFrame([(k, t, g, 0.0) for k, t, g in data], "doc_id string, text string, lang string, part double")
    got = {r["key"] for r in spam.spam_pages(df, "doc_id", "text", "lang", spam.Thresholds()).collect()}
    assert got == set(PAGES) | {"copy"}
    assert spam.spam_pages(df.filter("false"), "doc_id", "text", "lang", spam.Thresholds()).count() == 0


def test_calibration(spark):
    pages = [(i, PAGES["keywords"] + f"x{i}", "en-GB", "spam") for i in range(5)] + [(100 + i, FINE["prose"], "en", "ok") for i in range(5)]
    pages += [(200, PAGES["tags"], "fr", "spam"), (201, PROSE, None, "ok"), (202, PROSE, "en", None), (203, None, "en", "ok"), (204, PROSE, "en", "other")]
    df = spark.createDataFrame([p[:3] for p in pages], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(p[0], p[3]) for p in pages] * 2, "doc_id bigint, label string")
    rule = spam.calibrated(df, "doc_id", "text", "lang", labels)
    # nothing is wrong by the general thresholds, so they stay
    assert set(rule.by_language) == {"en", "fr"} and rule.general == rule.by_language["en"] == rule.by_language["fr"] == spam.SIGNALS
    none = spam.calibrated(df, "doc_id", "text", "lang", labels.filter("false"))
    assert none.by_language == {} and none.general == spam.SIGNALS


def test_fit_is_drawn_to_all_languages():
    n = len(spam.GRID)
    low, high = np.array([[0] + [9] * (n - 1)]), np.array([[40] * (n - 1) + [0]])
    assert spam._fitted(high * 10, high * 10, 500).tolist() == [spam.GRID[-1]]
    # many rows of its own outweigh the others, a few do not
    assert spam._fitted(low * 10, high, 100).tolist() == [spam.GRID[0]] and spam._fitted(np.minimum(low, 1), high, 40).tolist() == [spam.GRID[-1]]
    assert spam._fitted(np.zeros((1, n)), np.zeros((1, n)), 0).tolist() == [1.0]


@pytest.mark.parametrize("sf, part", [("sf0.1", "doc_id % 2"), ("sf0.1", "crc32(coalesce(source, '')) % 2"), ("sf0.1", "crc32(coalesce(publisher, '')) % 2")])
def test_held_out_accuracy(spark, sf, part):
    import os

    d = f"/root/testdata/{sf}"
    if not os.path.exists(d):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{d}/documents.parquet").selectExpr("doc_id", "text", "lang", f"{part} AS part")
    labels = spark.read.parquet(f"{d}/doc_labels.parquet").filter("label is not null").join(docs.select("doc_id", "part"), "doc_id")
    held = labels.filter("part = 1")
    rule = spam.calibrated(docs, "doc_id", "text", "lang", labels.filter("part = 0"))
    found = spam.spam_pages(docs.join(held.select("doc_id"), "doc_id"), "doc_id", "text", "lang", rule)
    got = {r["key"] for r in found.collect()}
    want = {r["doc_id"] for r in held.filter("label = 'spam'").collect()}
    assert want and len(got & want) >= 0.95 * len(want) and len(got & want) >= 0.95 * len(got)


def found_of(spark, texts):
    df = spark.createDataFrame([(k, t, "en") for k, t in texts.items()], "doc_id string, text string, lang string")
    return {r["key"] for r in spam.spam_pages(df, "doc_id", "text", "lang", spam.Thresholds()).collect()}


def test_lists_pasted_many_times(spark):
    lists = {f"{n} by {c}": "\n".join([" ".join(f"brand{i}" for i in range(n))] * c) for n in (8, 13, 16, 24, 40, 64, 100, 200) for c in (5, 40)}
    lists["places"] = " ".join(["hotels in paris london flights rome madrid lisbon offers vienna prague deals berlin munich"] * 40)
    fine = {
        "code": "for (i = 0; i < n; i++) { total += row[i].value; } if (total > limit) { log.warn(total); return null; } cache.put(key, total);\n" * 12,
        "form": "Name: ______ Street: ______ Town: ______ Postcode: ______ Telephone: ______ Signature: ______ Date: ______ Witness: ______\n" * 12,
        "greek": "Η επιτροπή εξετάζει κάθε έκθεση υπό το φως της ετήσιας επισκόπησης. Το συμβούλιο μπορεί να ζητήσει στοιχεία.\n" * 12,
        "prose": (PROSE + "\n") * 40,
        "table": "\n".join(f"north {i} south {i * 3} east {i * 7} west {i * 9} total {i * 20}" for i in range(40)),
        "twice": "\n".join([" ".join(f"member{i}" for i in range(40))] * 2),
    }
    assert found_of(spark, lists | fine) == set(lists)


def test_one_word_lines_and_link_texts(spark):
    names = [f"{a}{b}" for a in "abcdefghij" for b in ("loan", "card", "bank", "debt", "fund", "rate")]
    bad = {
        "one word": " ".join(f"insurance m{i}" for i in range(300)),
        "one in three": " ".join(f"insurance m{i} k{i}" for i in range(200)),
        "lines": "\n".join(names[i * 7**k % 59] for k in range(6) for i in range(60)),
        "html": " ".join(f'<a href="/p/{i}">Buy new{i} wool{i} coat{i} with free{i} post{i} and gift{i} box{i} for all{i} the family{i} today{i}</a>' for i in range(30)),
        "markdown": " ".join(f"[Buy new{i} wool{i} coat{i} with free{i} post{i} and gift{i} box{i} for all{i} the family{i} today{i} or later{i}](p{i}.html)" for i in range(30)),
    }
    fine = {
        "attendees": "\n".join(f"Mr Name{i}" for i in range(200)),
        "articles": "\n".join(f"Article {i} Subject{i} matter{i} scope{i}" for i in range(100)),
        "defined": "\n".join(f"term{i}: the meaning of thing{i} under rule{i}" for i in range(100)),
        "some links": " ".join(f'{PROSE} <a href="/p/{i}">see note {i}</a>' for i in range(20)),
        "lines of code": "\n".join(f"x{i} = f(y{i})\n}}\nelse {{" for i in range(60)),
        "prose on one word": "The insurance of a member covers the loss of the member, and the insurance ends with the year in which the insurance was made.",
    }
    assert found_of(spark, bad | fine) == set(bad)


def test_pages_met_in_review(spark):
    rng = np.random.default_rng(0)
    goods = "camera lens tripod battery charger flash filter case strap memory card printer".split()
    first, last = "Anna John Peter Maria Hans Luis Marie Paul Eva Karl Lena Hugo".split(), "Smith Brown Weber Novak Garcia Martin Rossi Klein Costa Fischer".split()
    terms = "contract clause party notice agency licence permit register tariff levy duty fee".split()
    kinds = ["Initial application", "Renewal of licence", "Late notification", "Inspection visit", "Amendment"]
    bad = {
        "advertising line": "\n".join(["Buy the best cheap holiday insurance now with our great discount offer for all your family trips today"] * 200),
        "keyword line": "\n".join(["cheap flights hotel deals insurance loans credit cards mortgage travel booking discount vouchers"] * 100),
        "draws": " ".join(rng.choice(goods, 600)),
        "brands": "\n".join(f"Brand{rng.integers(20)} X{rng.integers(40)}00" for _ in range(400)),
    }
    fine = {
        "attendees": "Attendees: " + ", ".join(f"{rng.choice(first)} {rng.choice(last)}" for _ in range(48)),
        "definitions": "\n".join(f"{rng.choice(terms)} {i}: {rng.choice(terms)}, {rng.choice(terms)}" for i in range(60)),
        "synonyms": "\n".join(f"term{i}: synonym{i}, other{i}, further{i}" for i in range(60)),
        "fees": "Annex II Fees\n" + "\n".join(f"{rng.choice(kinds)} class {i} EUR {100 + i * 15}" for i in range(39)),
        "references": "\n".join(f"{rng.choice(last)}, A., {rng.choice(last)}, N. Annual report on water regulation {1990 + i % 30}, {i}" for i in range(40)),
    }
    assert found_of(spark, bad | fine) == set(bad)
