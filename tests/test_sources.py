import json
import sqlite3

import pytest

from glossarch.sources import files, sqlite


def test_texts(spark, tmp_path, rows):
    (tmp_path / "b_cleaned.txt").write_bytes(b"x\r\ny\rz")
    (tmp_path / "a.TXT").write_bytes(b"bad \xff byte")
    (tmp_path / "c.md").write_text("no")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "d.txt").write_text("no")
    assert [p.rsplit("/", 1)[1] for p in files.text_inputs(str(tmp_path))] == ["a.TXT", "b_cleaned.txt"]
    assert rows(files.read_texts(spark, str(tmp_path)).select("doc", "text")) == [("a", "bad  byte"), ("b", "x\ny\nz")]
    with pytest.raises(Exception):
        files.read_texts(spark, str(tmp_path), strict=True).collect()
    with pytest.raises(ValueError):
        files.text_inputs(str(tmp_path / "c.md"))
    assert files.output_path("/x/gdpr_chunks.json", "_claims.jsonl") == "/x/gdpr_claims.jsonl"
    out = files.write_texts(files.read_texts(spark, str(tmp_path)), str(tmp_path / "out"))
    assert out.count() == 2 and (tmp_path / "out" / "b_cleaned.txt").read_text() == "x\ny\nz"


def test_json(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text(json.dumps([{"doc": "d", "id": "d_1", "chunk": "é", "more": 1}, {"doc": "d", "id": "d_2"}]))
    got = files.read_json_array(spark, str(tmp_path / "a.json"))
    assert rows(got) == [("d", "d_1", "é"), ("d", "d_2", None)]
    assert files.write_json_array(got.orderBy("id"), str(tmp_path / "out.json")) == 2
    assert json.loads((tmp_path / "out.json").read_text())[0] == {"doc": "d", "id": "d_1", "chunk": "é"}
    assert files.write_json_array(got.filter("false"), str(tmp_path / "none.json")) == 0 and json.loads((tmp_path / "none.json").read_text()) == []
    (tmp_path / "o.json").write_text("{}")
    with pytest.raises(Exception, match="not a JSON array"):
        files.read_json_array(spark, str(tmp_path / "o.json")).collect()


def test_json_lines(spark, tmp_path, rows):
    lines = ['{"claim_id": "a", "claim_text": "A"}', "", "{broken", '{"claim_id": "", "claim_text": "x"}', '{"claim_id": "b", "claim_text": null}', '{"claim_id": "c", "claim_text": "C", "doc": "d"}']
    (tmp_path / "in.jsonl").write_text("\n".join(lines))
    got = files.read_json_lines(spark, str(tmp_path / "in.jsonl"))
    assert rows(got.select("claim_id", "claim_text", "doc")) == [("a", "A", None), ("c", "C", "d")]
    files.write_json_lines(got, str(tmp_path / "out"))
    assert files.read_json_lines(spark, str(tmp_path / "out")).count() == 2


def test_sqlite(spark, tmp_path, rows):
    path = str(tmp_path / "a.sqlite")
    df = spark.createDataFrame([("d", "d_1", "x", "p", "p x", [0.5, -1.0]), ("d", "d_2", "y", None, "", None)], sqlite.SqliteFolder({}).schema())
    sqlite.upsert(df, path, "contextualized_chunks", "id", ("doc",))
    sqlite.upsert(df.filter("id = 'd_1'").withColumn("chunk_ctx", df.chunk_raw), path, "contextualized_chunks", "id")
    db = sqlite3.connect(path)
    assert db.execute("SELECT id, chunk_ctx, emb_ctx FROM contextualized_chunks ORDER BY id").fetchall() == [("d_1", "x", sqlite.to_blob([0.5, -1.0])), ("d_2", "", None)]
    assert db.execute("SELECT count(*) FROM sqlite_master WHERE type = 'index' AND name LIKE 'idx%'").fetchone() == (1,)
    db.close()
    sqlite3.connect(str(tmp_path / "b.sqlite")).close()
    (tmp_path / "c.sqlite").write_text("not a database" * 100)
    assert rows(sqlite.system_corpus(spark, str(tmp_path))) == [("d_1", "x", [0.5, -1.0])]
    assert rows(sqlite.system_corpus(spark, str(tmp_path / "missing"))) == []
    assert sqlite.from_blob(None) is None is sqlite.to_blob(None)
