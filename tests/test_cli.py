import json
import sqlite3

import pytest

from glossarch.__main__ import main


def test_all_steps(spark, tmp_path):
    (tmp_path / "a.txt").write_text("The board met.  It kept the\nrule. " * 30)
    main(["clean", str(tmp_path / "a.txt")], spark)
    assert "  " not in (tmp_path / "a_cleaned.txt").read_text()
    chunks, _ = main(["chunk", str(tmp_path / "a_cleaned.txt")], spark)
    assert chunks.endswith("/a_chunks.json") and json.load(open(chunks))[0]["id"] == "a_1"
    done, _ = main(["contextualize", chunks, "--mode", "prefix", "--corpus", str(tmp_path)], spark)
    first = json.load(open(done))[0]
    assert first["chunk"] in first["contextualized_chunk"] and first["context_prefix"]
    claims, _ = main(["claims", done], spark)
    triples, database = main(["triples", claims], spark)
    assert triples.endswith("/a_triples.jsonl")
    rows = sqlite3.connect(database).execute("SELECT claim_id, subject, length(claim_emb) FROM claims").fetchall()
    assert rows and all(r[2] == 256 for r in rows)
    # the same step again replaces rows, none are added
    main(["triples", claims], spark)
    assert len(sqlite3.connect(database).execute("SELECT 1 FROM claims").fetchall()) == len(rows)


def test_missing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        main(["chunk", str(tmp_path / "none.txt")], spark)
    (tmp_path / "x.md").write_text("x")
    with pytest.raises(ValueError):
        main(["chunk", str(tmp_path / "x.md")], spark)
    with pytest.raises(SystemExit):
        main(["chunk", str(tmp_path), "--mode", "other"], spark)


def test_word_cost_is_a_parameter(spark, tmp_path):
    (tmp_path / "b.txt").write_text("The board met and kept the rule. " * 40)
    many, _ = main(["chunk", str(tmp_path / "b.txt"), "--word-cost", "builtins:len"], spark)
    long = json.load(open(many))
    few, _ = main(["chunk", str(tmp_path / "b.txt")], spark)
    assert len(long) > len(json.load(open(few)))  # a letter costs a token, so more chunks are needed
