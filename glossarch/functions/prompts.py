"""Prompts as column expressions; sections without content are left out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossarch.operators.context import KINDS

TITLES = {
    "local_before": "Text just before the passage",
    "local_after": "Text just after the passage",
    "doc": "Earlier passages of this document",
    "system": "Passages of other documents",
}
TASKS = {
    "prefix": "Write a note of one to three sentences that tells where the passage stands in its document and what it refers to. Use only the material given.",
    "rewrite": "Write the passage anew so that it can be read alone: resolve references with the material given, keep every fact, add none.",
}
RELEVANCE = "For each candidate say whether it helps to understand the passage. Answer with one line per candidate: its id, a tab, then yes or no."
CLAIMS = "List the separate factual claims of the text as a JSON array of objects with the keys claim_text and source_quote; the quote is copied from the text."
TRIPLE = "State the claim as one JSON object with the keys subject, predicate and object."


def section(title: str, body: Column) -> Column:
    body = F.coalesce(body, F.lit(""))
    return F.when(F.length(body) > 0, F.concat(F.lit(f"## {title}\n"), body, F.lit("\n\n"))).otherwise(F.lit(""))


def contextualize(mode: str, passage: Column, buckets: dict[str, Column]) -> Column:
    parts = [section(TITLES[k], buckets[k]) for k in KINDS if k in buckets]
    return F.concat(*parts, section("Passage", passage), F.lit(TASKS[mode]))


def relevance(passage: Column, items: Column) -> Column:
    """``items`` is an array of structs with ``id`` and ``text``."""
    lines = F.array_join(F.transform(items, lambda e: F.concat(e["id"], F.lit("\t"), e["text"])), "\n")
    return F.concat(section("Passage", passage), section("Candidates", lines), F.lit(RELEVANCE))


def claims(mode: str, passage: Column, context: Column) -> Column:
    """In prefix mode the passage with its context, in rewrite mode the contextualized text alone."""
    if mode == "prefix":
        return F.concat(section("Context", context), section("Passage", passage), F.lit(CLAIMS))
    return F.concat(section("Text", context), F.lit(CLAIMS))


def triple(claim: Column) -> Column:
    return F.concat(section("Claim", claim), F.lit(TRIPLE))
