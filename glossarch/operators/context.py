"""Putting the context of a passage together: neighbours, prioritised candidates, relevance, ordered joining of texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: kinds of candidates in the order in which the first occurrence of an id wins
KINDS = ["local_before", "local_after", "doc", "system"]
# What parts texts of neighbours and of other candidates, and the note for an empty reply.
PARAGRAPH, RULE = "\n\n", "\n\n---\n\n"
NO_CONTEXT = "(No additional context found.)"


#: numbers of passages that are sorted together: no document is sorted as a whole
BLOCK = 4096


def ordered(passages: DataFrame, suffix: Column) -> DataFrame:
    """Adds ``pos``, the place of a passage in its document, by the number in its id, then the id.

    Numbers are cut into blocks of ``BLOCK``; the place is the one in the block after the passages of the blocks before.
    """
    rows = passages.withColumn("__n", suffix).withColumn("__b", F.coalesce(F.floor(F.col("__n") / BLOCK), F.lit(-1)))
    sizes = rows.groupBy("doc", "__b").agg(F.count(F.lit(1)).alias("__size"))
    before = F.coalesce(F.sum("__size").over(Window.partitionBy("doc").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("doc").alias("__doc"), F.col("__b").alias("__at"), before.alias("__before"))
    rows = rows.withColumn("__place", F.row_number().over(Window.partitionBy("doc", "__b").orderBy("__n", "id")))
    rows = rows.join(sizes, F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("__b") == F.col("__at")))
    return rows.withColumn("pos", (F.col("__place") + F.col("__before")).cast("int")).select(*passages.columns, "pos")


def neighbours(passages: DataFrame, before: int = 1, after: int = 1, text: str = "text") -> DataFrame:
    """Adds ``before`` and ``after``, arrays of ``(pos, id, text)`` of the passages around, nearest last and first, cut at the edges.

    Places are cut into blocks of ``BLOCK``; passages near an edge are in both blocks, so that windows stay within one.
    """
    if max(before, after) >= BLOCK:
        raise ValueError(f"fewer than {BLOCK} neighbours can be asked for")
    block = F.floor(F.col("pos") / BLOCK)
    all_of = F.array_distinct(F.array(F.floor((F.col("pos") - after) / BLOCK), block, F.floor((F.col("pos") + before) / BLOCK)))
    order = Window.partitionBy("doc", "__b").orderBy("pos")
    entry = F.struct("pos", "id", F.col(text).alias("text"))

    def span(lo: int, hi: int, n: int) -> Column:
        empty = F.lit(None).cast("array<struct<pos:int,id:string,text:string>>")
        found = F.collect_list(entry).over(order.rowsBetween(lo, hi)) if n else empty
        return F.coalesce(found, F.array().cast("array<struct<pos:int,id:string,text:string>>"))

    rows = passages.withColumn("__b", F.explode(all_of))
    return rows.withColumn("before", span(-before, -1, before)).withColumn("after", span(1, after, after)).filter(F.col("__b") == block).drop("__b")


def local_candidates(around: DataFrame) -> DataFrame:
    """``query, kind, prio, rank, id, text`` of the neighbours of every passage (output of ``neighbours``)."""
    parts = []
    for prio, (column, kind) in enumerate((("before", KINDS[0]), ("after", KINDS[1]))):
        rows = around.select(F.col("id").alias("query"), F.posexplode(column).alias("rank", "e"))
        parts.append(rows.select("query", F.lit(kind).alias("kind"), F.lit(prio).alias("prio"), "rank", F.col("e.id").alias("id"), F.col("e.text").alias("text")))
    return parts[0].unionByName(parts[1])


def candidates(parts: dict[str, DataFrame]) -> DataFrame:
    """The union of candidates by kind (each ``query, rank, id, text``) with the priority of the kind."""
    rows = [df.select("query", F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("prio"), "rank", "id", "text") for kind, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)


def first_by_id(union: DataFrame) -> DataFrame:
    """One row per query and id: the one of the strongest kind, then of the best rank."""
    order = Window.partitionBy("query", "id").orderBy("prio", "rank")
    return union.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"^\s*$")


def judgeable(deduped: DataFrame) -> DataFrame:
    """Candidates a relevance judge is asked about: document and corpus ones with text."""
    return deduped.filter(F.col("kind").isin("doc", "system") & ~blank(F.col("text")))


def relevant(deduped: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Local candidates, and those of document and corpus that ``verdicts`` (``query, id``) holds. No verdict at all drops them."""
    local = deduped.filter(~F.col("kind").isin("doc", "system"))
    judged = judgeable(deduped).join(verdicts.select("query", "id").distinct(), ["query", "id"], "left_semi")
    return local.unionByName(judged.select(*local.columns))


def buckets(chosen: DataFrame) -> DataFrame:
    """``query`` and one text per kind: its candidates in order, local ones parted by a blank line, others by a rule. A kind without candidates is ''."""
    out = []
    for kind in KINDS:
        texts = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("prio", "rank", F.coalesce("text", F.lit("")).alias("text")))))
        out.append(F.array_join(F.transform(texts, lambda e: e["text"]), PARAGRAPH if kind.startswith("local") else RULE).alias(kind))
    return chosen.groupBy("query").agg(*out)


def id_lists(chosen: DataFrame) -> DataFrame:
    """``query`` and the ids of its neighbours, document and corpus candidates, in order."""
    def ids(*kinds: str) -> Column:
        picked = F.array_sort(F.collect_list(F.when(F.col("kind").isin(*kinds), F.struct("prio", "rank", "id"))))
        return F.transform(picked, lambda e: e["id"])

    return chosen.groupBy("query").agg(ids(*KINDS[:2]).alias("local_neighbor_ids"), ids("doc").alias("doc_retrieved_ids"), ids("system").alias("system_retrieved_ids"))


def combined(mode: str, reply: Column, passage: Column) -> tuple[Column, Column]:
    """``(context_prefix, contextualized)`` from a generator's reply; an empty reply falls back to a note or to the passage."""
    said = F.nullif(F.trim(F.coalesce(reply, F.lit(""))), F.lit(""))
    if mode == "prefix":
        prefix = F.coalesce(said, F.lit(NO_CONTEXT))
        return prefix, F.concat(prefix, F.lit(" "), F.coalesce(passage, F.lit("")))
    if mode == "rewrite":
        whole = F.coalesce(said, passage, F.lit(""))
        return whole, whole
    raise ValueError(f"mode must be 'prefix' or 'rewrite', not {mode!r}")
