"""Command line: ``python -m glossarch clean|chunk|contextualize|claims|triples PATH``.

Each step reads the files of the step before and writes a JSON file and a SQLite database beside its input. Without ``--server`` the
offline stand-ins are used instead of a language model. On a cluster use the functions of ``glossarch.plans.pipeline`` on tables.
"""

from __future__ import annotations

import argparse
import importlib
import json
import os
import sys
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarch.functions import models
from glossarch.operators.cleaning import clean
from glossarch.plans import config as configuration
from glossarch.plans import pipeline
from glossarch.plans.metrics import Metrics
from glossarch.sources import files, sqlite


def _model(args, on_failure: str | None = "", attempts: int = 3):
    if not args.server:
        return None
    return models.generate(models.ChatServer(args.server, args.model, attempts=attempts, on_failure=on_failure))


def _claims_model(args):
    """Claims are asked for once; a failed call leaves its chunk out."""
    return _model(args, None, 1)


def run_clean(spark: SparkSession, path: str, args, settings) -> list[str]:
    rows = files.read_texts(spark, path, strict=True).withColumn("text", clean(F.col("text")))
    folder = path if os.path.isdir(path) else os.path.dirname(path) or "."
    return [r["path"] for r in files.write_texts(rows, folder).collect()]


def _save(df: DataFrame, columns: list[str], json_path: str, database: str, table: str, key: str, stored: dict[str, str], lines: bool = False) -> list[str]:
    df = df.cache()
    if lines:
        files.write_json_lines(df.select(*columns), json_path)
    else:
        files.write_json_array(df.select(*columns).orderBy(key), json_path)
    sqlite.upsert(df.select(*(F.col(c).alias(n) for n, c in stored.items())), database, table, key, ("doc",) if "doc" in stored else ())
    df.unpersist()
    return [json_path, database]


def _named(name: str):
    """The function ``module:function``."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _tools(args) -> dict:
    """Embedding of a column of texts and cost of a word, where the command line names them."""
    tools = {}
    if args.embed:
        of = _named(args.embed)
        tools["embed"] = models.embed(lambda texts: [list(v) for v in of(texts)])
    return tools


def run_chunk(spark: SparkSession, path: str, args, settings) -> list[str]:
    files.text_inputs(path)
    cost = {"cost": _named(args.word_cost)} if args.word_cost else {}
    rows = pipeline.chunk(files.read_texts(spark, path), settings, **_tools(args), **cost, metrics=args.metrics)
    out = [files.output_path(path, e) for e in ("_chunks.json", "_raw.sqlite")]
    return _save(rows, ["doc", "id", "chunk"], *out, "raw_chunks", "id", {"doc": "doc", "id": "id", "chunk": "chunk", "emb": "emb"})


def run_contextualize(spark: SparkSession, path: str, args, settings) -> list[str]:
    chunks = files.read_json_array(spark, path)
    corpus = sqlite.system_corpus(spark, args.corpus) if args.corpus and sqlite.databases(args.corpus) else None
    rows = pipeline.contextualize(chunks, corpus, settings, _model(args), _model(args), **_tools(args), metrics=args.metrics)
    out = [files.output_path(path, e) for e in ("_contextualized.json", "_contextualized.sqlite")]
    columns = [f.name for f in files.CONTEXTUALIZED.fields if settings.mode == "prefix" or f.name != "context_prefix"]
    stored = {"doc": "doc", "id": "id", "chunk_raw": "chunk", "context_prefix": "context_prefix", "chunk_ctx": "contextualized_chunk", "emb_ctx": "emb_ctx"}
    return _save(rows, columns, *out, "contextualized_chunks", "id", stored)


def run_claims(spark: SparkSession, path: str, args, settings) -> list[str]:
    rows = pipeline.extract_claims(files.read_json_array(spark, path, files.CONTEXTUALIZED), settings, _claims_model(args), **_tools(args), metrics=args.metrics)
    out = [files.output_path(path, e) for e in ("_claims.jsonl", "_claims.sqlite")]
    columns = [f.name for f in files.CLAIM.fields]
    return _save(rows, columns, *out, "claims", "claim_id", {c: c for c in columns} | {"emb": "claim_emb"}, lines=True)


def run_triples(spark: SparkSession, path: str, args, settings) -> list[str]:
    rows = pipeline.extract_triples(files.read_json_lines(spark, path), _model(args), **_tools(args), metrics=args.metrics)
    out = [files.output_path(path, e) for e in ("_triples.jsonl", "_triples.sqlite")]
    columns = [f.name for f in files.TRIPLE.fields]
    vectors = ["subject_emb", "predicate_emb", "object_emb", "claim_emb"]
    return _save(rows, columns, *out, "claims", "claim_id", {c: c for c in columns + vectors}, lines=True)


STEPS = {"clean": run_clean, "chunk": run_chunk, "contextualize": run_contextualize, "claims": run_claims, "triples": run_triples}


def main(argv: list[str], spark: SparkSession | None = None) -> list[str]:
    parser = argparse.ArgumentParser(prog="glossarch", description=__doc__)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("path")
    parser.add_argument("--mode", choices=configuration.MODES, default="rewrite")
    parser.add_argument("--config", help="YAML file of parameters")
    parser.add_argument("--corpus", help="folder of SQLite databases to search as well")
    parser.add_argument("--embed", help="embedding model, as module:function from a list of texts to vectors")
    parser.add_argument("--word-cost", help="tokens of a word, as module:function")
    parser.add_argument("--server", help="URL of a chat server")
    parser.add_argument("--model", default="mistral:7b")
    args = parser.parse_args(argv)
    if not os.path.exists(args.path):
        raise FileNotFoundError(args.path)
    settings = replace(configuration.load(args.config) if args.config else configuration.Config(), mode=args.mode)
    spark = spark or SparkSession.builder.getOrCreate()
    args.metrics, began = Metrics(), time.time()
    written = STEPS[args.step](spark, os.path.abspath(args.path), args, settings)
    print("\n".join(written))
    print(json.dumps(args.metrics.values() | {"seconds": round(time.time() - began, 1)}), file=sys.stderr)
    return written


if __name__ == "__main__":
    main(sys.argv[1:])
