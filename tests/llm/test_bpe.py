import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glossarch.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.vocabulary()), reason="no vocabulary files")


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(os.path.join(bpe.VOCABULARIES, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=500, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0　​ab'stéZ9½²漢字-_.<|>🙂"), st.characters(exclude_categories=["Cs", "Cn"])), max_size=40))
def test_as_the_library(library, text):
    e = bpe.encoder(bpe.vocabulary())
    ids = e.encode(text)
    assert ids == library(text) and e.decode(ids) == text and e.count(text) == len(ids)


def test_special_and_long(library):
    e = bpe.encoder(bpe.vocabulary())
    for text in ("<|endoftext|>", "it's don't WE'LL", "a" * 5000, "ab" * 30_000, " " * 3000 + "x", "\n" * 999):
        assert e.encode(text) == library(text)


def test_memory_is_bounded():
    e = bpe.Encoder(bpe.vocabulary(), room=3)
    assert e.decode(e.encode("one two three four five six")) == "one two three four five six" and len(e.known) <= 3


def test_tables(spark):
    df = spark.createDataFrame([(1, "a b", "s", "x"), (2, None, None, "x"), (3, "", "s", "x"), (1, "a b", "s", "x")], "doc_id bigint, text string, source string, ids string")
    got = sorted((r["key"], r["ids"]) for r in bpe.encoded(df, "doc_id", "text").collect())
    assert got == [(1, [64, 275]), (1, [64, 275]), (2, []), (3, [])]
    counts = sorted((r["doc_id"], r["tokens"]) for r in bpe.token_counts(df, "text", None, "doc_id", "source").collect())
    assert counts == [(1, 2), (1, 2), (2, 0), (3, 0)]
    assert bpe.encoded(df.filter("false"), "doc_id", "text").count() == 0
