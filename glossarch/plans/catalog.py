"""Queries over the test tables, by operator, with the SQL they are compared with.

``QUERIES`` maps names to (spark, folder) -> DataFrame, ``ORACLE`` to SQL. Passages are the current rows of ``raw_chunks`` in the
order of their documents, the external corpus those of ``contextualized_chunks``. Searches of the corpus take the passages whose number
is divisible by 20 as queries, against all rows; the two contextualize queries take every passage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarch.functions import models, prompts
from glossarch.operators import chunking, cleaning, context, parsing, retrieval, vectors
from glossarch.operators.upsert import current_rows
from glossarch.plans import catalog_sql as sql
from glossarch.plans import pipeline
from glossarch.plans.scratch import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLE[f.__name__] = oracle
        return f

    return register


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# -- documents ---------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, doc, path, CAST(coalesce(length(text), 0) AS BIGINT) AS chars FROM documents")
def scan_documents(spark, d):
    return _table(spark, d, "documents").select("doc_id", "doc", "path", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("chars"))


@query(f"SELECT doc_id, CAST(len({sql.tokens('text')}) AS BIGINT) AS tokens, CAST(len({sql.words('text')}) AS BIGINT) AS words FROM documents WHERE text IS NOT NULL")
def doc_length_stats(spark, d):
    rows = _table(spark, d, "documents").filter("text is not null")
    return rows.select("doc_id", F.size(retrieval.tokens(F.col("text"))).cast("bigint").alias("tokens"), F.size(chunking.words(F.col("text"))).cast("bigint").alias("words"))


def _clean(name: str, expr: str, *steps: str) -> None:
    def run(spark, d):
        return _table(spark, d, "documents").select("doc_id", cleaning.steps(F.col("text"), *steps).alias("text"))

    run.__name__ = name
    query(f"SELECT doc_id, {expr} AS text FROM documents")(run)


_clean("clean_quotes", sql.quotes("text"), "quotes")
_clean("clean_newlines", sql.newlines("text"), "newlines")
_clean("clean_markers", sql.markers("text"), "markers")
_clean("clean_join_lines", sql.join_lines("text"), "join_lines")
_clean("clean_spacing", sql.spacing("text"), "spacing")
_clean("clean_all", sql.clean("text"), *cleaning.STEPS)


@query(f"SELECT doc_id, array_to_string({sql.tokens('text')}, ' ') AS tokens FROM documents WHERE text IS NOT NULL")
def tokenize(spark, d):
    rows = _table(spark, d, "documents").filter("text is not null")
    return rows.select("doc_id", F.array_join(retrieval.tokens(F.col("text")), " ").alias("tokens"))


_TF = f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({sql.tokens('text')}) AS term FROM documents) GROUP BY ALL"


@query(_TF)
def term_frequency(spark, d):
    return retrieval.term_frequency(_table(spark, d, "documents"), ["doc_id"], "text")


@query(f"SELECT term, count(*) AS df FROM ({_TF}) GROUP BY ALL")
def document_frequency(spark, d):
    return retrieval.document_frequency(term_frequency(spark, d))


@query(f"SELECT count(*) AS n, round(avg(l), 6) AS avg_len, CAST(max(l) AS BIGINT) AS max_len FROM (SELECT len({sql.tokens(chr(39).join(['coalesce(text, ', '', ')']))}) AS l FROM documents)")
def corpus_stats(spark, d):
    return retrieval.corpus_stats(_table(spark, d, "documents"), "text")


def _words(spark, d):
    return _table(spark, d, "documents").filter("text is not null").select(F.explode(chunking.words(F.col("text"))).alias("word")).distinct()


@query(f"WITH {sql.WORD_LIST} SELECT word, CAST({sql.cost('word')} AS INTEGER) AS cost FROM words")
def word_cost(spark, d):
    return _words(spark, d).select("word", chunking.word_cost(F.col("word")).alias("cost"))


@query(f"WITH {sql.WORD_LIST} SELECT word FROM words WHERE regexp_matches(word, '[A-Za-z0-9]')")
def wordy_filter(spark, d):
    return _words(spark, d).filter(chunking.wordy(F.col("word")))


@query(f"WITH {sql.WORD_LIST} SELECT word, {sql.start_valid('word')} AS valid FROM words")
def start_validity(spark, d):
    return _words(spark, d).select("word", chunking.start_valid(F.col("word")).alias("valid"))


def _chunked(spark, d):
    rows = _table(spark, d, "documents").select("doc", cleaning.clean(F.col("text")).alias("text"))
    return chunking.chunked(rows, "doc", "text")


@query(f"WITH {sql.SPANS} SELECT s.doc, seq, first, last, CAST(f.s[last + 2] - f.s[first + 1] AS INTEGER) AS cost FROM spans s JOIN f USING (doc)")
def chunk_spans(spark, d):
    return _chunked(spark, d).select("doc", "seq", "first", "last", "cost")


@query(f"WITH {sql.SPANS} SELECT s.doc, s.doc || '_' || seq AS id, array_to_string(f.w[first + 1:last + 1], ' ') AS chunk FROM spans s JOIN f USING (doc)")
def chunk_ids(spark, d):
    return _chunked(spark, d).select("doc", "id", "chunk")


@query(f"WITH {sql.SPANS} SELECT doc, seq, CAST(greatest(0, lag(last) OVER (PARTITION BY doc ORDER BY seq) + 1 - first) AS INTEGER) AS shared FROM spans")
def chunk_overlap(spark, d):
    from pyspark.sql import Window

    before = F.lag("last").over(Window.partitionBy("doc").orderBy("seq"))
    return _chunked(spark, d).select("doc", "seq", F.greatest(F.lit(0), before + 1 - F.col("first")).alias("first_shared"), before.alias("b")).select("doc", "seq", F.when(F.col("b").isNotNull(), F.col("first_shared")).otherwise(F.lit(0)).alias("shared"))


@query(
    f"""WITH t AS (SELECT doc_id, unnest({sql.tokens('text')}) AS t FROM documents),
b AS (SELECT doc_id, CAST(('0x' || substr(md5(t), 1, 4)) AS INTEGER) % 64 AS bucket, count(*) AS c FROM t GROUP BY ALL)
SELECT doc_id, CAST(bucket AS INTEGER) AS bucket, round((c / (sqrt(sum(c * c) OVER (PARTITION BY doc_id)) + 1e-12))::FLOAT::DOUBLE, 5) AS weight FROM b"""
)
def hash_embed(spark, d):
    rows = _table(spark, d, "documents").filter("text is not null")
    rows = rows.select("doc_id", F.posexplode(vectors.hash_embedding(F.col("text"))).alias("bucket", "w"))
    return rows.filter("w > 0").select("doc_id", "bucket", F.round(F.col("w").cast("double"), 5).alias("weight"))


# -- vectors ---------------------------------------------------------------------------------------------------------


@query(f"SELECT vec_id, label, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm, round(({sql.unit('embedding')})[1], 6) AS first FROM embeddings")
def l2_normalise(spark, d):
    e = F.col("embedding")
    return _table(spark, d, "embeddings").select("vec_id", "label", F.round(vectors.norm(e), 6).alias("norm"), F.round(F.get(vectors.l2_normalise(e), F.lit(0)), 6).alias("first"))


@query(f"WITH u AS (SELECT vec_id, {sql.unit('embedding')} AS v FROM embeddings) SELECT a.vec_id, round(list_dot_product(a.v, b.v), 6) AS dot FROM u a JOIN u b ON b.vec_id = a.vec_id + 1")
def dot_product(spark, d):
    u = _table(spark, d, "embeddings").select("vec_id", vectors.l2_normalise(F.col("embedding")).alias("v"))
    other = u.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w"))
    return u.join(other, "vec_id").select("vec_id", F.round(vectors.dot(F.col("v"), F.col("w")), 6).alias("dot"))


@query(
    f"""WITH u AS (SELECT vec_id, {sql.unit('embedding')} AS v FROM embeddings), s AS (SELECT a.vec_id AS query, b.vec_id AS neighbour, round(list_dot_product(a.v, b.v), 9) AS score FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
SELECT query, neighbour, round(score, 6) AS score, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, neighbour) AS place FROM s) WHERE place <= 5"""
)
def dense_topk(spark, d):
    e = _table(spark, d, "embeddings")
    best = vectors.dense_topk(e, "vec_id", "embedding", e.filter("vec_id % 20 = 0"), 5)
    return best.select("query", "neighbour", F.round("score", 6).alias("score"), "place")


# -- passages and history --------------------------------------------------------------------------------------------


def _passages(spark: SparkSession, d: str) -> DataFrame:
    rows = current_rows(_table(spark, d, "raw_chunks").select("doc", "id", "chunk", "emb", "run"), "id")
    unit = F.when(F.size("emb") == 64, vectors.l2_normalise(F.col("emb")))
    rows = rows.select("doc", "id", F.coalesce("chunk", F.lit("")).alias("text"), unit.alias("emb"), chunking.id_suffix(F.col("id")).alias("suffix"))
    return context.ordered(rows, F.col("suffix"))


@query(f"WITH {sql.PASSAGES} SELECT doc, id, suffix, pos FROM p")
def id_suffix_sort(spark, d):
    return _passages(spark, d).select("doc", "id", "suffix", "pos")


@query(
    f"""WITH {sql.PASSAGES} SELECT id, lag(id) OVER w AS before_id, lag(text) OVER w AS before_text, lead(id) OVER w AS after_id, lead(text) OVER w AS after_text FROM p WINDOW w AS (PARTITION BY doc ORDER BY pos)"""
)
def local_neighbours(spark, d):
    rows = context.neighbours(_passages(spark, d))
    b, a = F.get("before", F.lit(0)), F.get("after", F.lit(0))
    return rows.select("id", b["id"].alias("before_id"), b["text"].alias("before_text"), a["id"].alias("after_id"), a["text"].alias("after_text"))


@query(f"WITH {sql.PASSAGES} SELECT id, concat_ws(' ', lag(id) OVER w, lead(id) OVER w) AS ids FROM p WINDOW w AS (PARTITION BY doc ORDER BY pos)")
def neighbour_ids(spark, d):
    rows = context.neighbours(_passages(spark, d))
    return rows.select("id", F.array_join(F.transform(F.concat("before", "after"), lambda e: e["id"]), " ").alias("ids"))


@query(f"WITH {sql.HISTORY} SELECT doc, pos, term, CAST(row_number() OVER (PARTITION BY doc, term ORDER BY pos) - 1 AS BIGINT) AS df FROM tf")
def prefix_df(spark, d):
    rows = _passages(spark, d).withColumn("seq", F.col("pos"))
    return retrieval.prefix_df(retrieval.term_frequency(rows, ["doc", "seq"], "text")).withColumnRenamed("seq", "pos")


@query(
    f"""WITH {sql.HISTORY} SELECT doc, pos, hist, round(bm25, 6) AS bm25, place FROM
(SELECT *, CAST(row_number() OVER (PARTITION BY doc, pos ORDER BY round(bm25, 9) DESC, hist) AS INTEGER) AS place FROM bm) WHERE place <= 10"""
)
def bm25_history(spark, d):
    rows = _passages(spark, d).withColumn("seq", F.col("pos"))
    best = retrieval.history_topk(rows, 10, vector=None, dense=0.0, sparse=1.0, scale=False).filter("bm25 > 0")
    return best.select("doc", F.col("seq").cast("int").alias("pos"), F.col("hist").cast("int").alias("hist"), F.round("bm25", 6).alias("bm25"), "place")


def _history(spark, d):
    rows = _passages(spark, d).withColumn("seq", F.col("pos"))
    rows = written(rows, "passages")
    best = retrieval.history_topk(rows, 2)
    return rows, best.withColumns({c: F.col(c).cast("int") for c in ("seq", "hist")})


@query(f"WITH {sql.HISTORY} SELECT doc, pos, hist, round(score, 6) AS score, place FROM top")
def hybrid_history_topk(spark, d):
    return _history(spark, d)[1].select("doc", F.col("seq").alias("pos"), "hist", F.round("score", 6).alias("score"), "place")


@query(f"WITH {sql.HISTORY} SELECT doc, pos, hist, place FROM kept")
def history_dedup_local(spark, d):
    best = _history(spark, d)[1].select("doc", F.col("seq").alias("pos"), F.col("hist").alias("hist_pos"), "place")
    return retrieval.without_local(best).select("doc", "pos", F.col("hist_pos").alias("hist"), "place")


# -- external corpus -------------------------------------------------------------------------------------------------


def _corpus(spark, d):
    rows = current_rows(_table(spark, d, "contextualized_chunks").select("id", "chunk_ctx", "emb_ctx", "run"), "id").filter("chunk_ctx <> ''")
    return rows.select("id", F.col("chunk_ctx").alias("text"), F.col("emb_ctx").alias("vector"))


def _search(spark, d):
    asked = _passages(spark, d).filter("suffix % 20 = 0").select("id", "text", F.col("emb").alias("vector"))
    return retrieval.SystemSearch(_corpus(spark, d), asked)


@query(
    f"""WITH {sql.PASSAGES}, {sql.SYSTEM} SELECT query, candidate, round(bm25, 6) AS bm25, CAST(place AS INTEGER) AS place FROM
(SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(bm25, 9) DESC, candidate) AS place FROM spairs) WHERE place <= 5"""
)
def bm25_system(spark, d):
    return _search(spark, d).best(5, 0.0, 1.0, scale=False).select("query", "candidate", F.round("score", 6).alias("bm25"), "place")


@query(f"WITH {sql.PASSAGES}, {sql.SYSTEM} SELECT query, round(min(dense), 6) AS dense_min, round(max(dense), 6) AS dense_max, round(min(bm25), 6) AS bm25_min, round(max(bm25), 6) AS bm25_max FROM spairs GROUP BY query")
def minmax_system(spark, d):
    found = _search(spark, d).limits()
    return found.select("query", *(F.round(c, 6).alias(c) for c in found.columns[1:]))


@query(f"WITH {sql.PASSAGES}, {sql.SYSTEM} SELECT query, candidate, round(score, 6) AS score, place FROM stop")
def hybrid_system_topk(spark, d):
    return _search(spark, d).best(3).select("query", "candidate", F.round("score", 6).alias("score"), "place")


# -- context ---------------------------------------------------------------------------------------------------------


def _union(spark, d):
    rows, best = _history(spark, d)
    rows, best = rows.drop("seq"), written(best, "best")
    local = context.local_candidates(context.neighbours(rows))
    kept = best.filter("seq - hist > 1")
    ids = rows.select("doc", F.col("pos").alias("seq"), F.col("id").alias("query"))
    hist = rows.select("doc", F.col("pos").alias("hist"), "id", "text")
    doc = kept.join(ids, ["doc", "seq"]).join(hist, ["doc", "hist"]).select("query", F.col("place").alias("rank"), "id", "text")
    asked = rows.filter("suffix % 20 = 0").select("id", "text", F.col("emb").alias("vector"))
    corpus = _corpus(spark, d)
    top = retrieval.SystemSearch(corpus, asked).best(1).withColumnRenamed("candidate", "id")
    system = top.join(corpus.select("id", "text"), "id").select("query", F.col("place").alias("rank"), "id", "text")
    parts = {"local_before": local.filter("kind = 'local_before'"), "local_after": local.filter("kind = 'local_after'"), "doc": doc, "system": system}
    return rows, context.candidates(parts)


@query(f"WITH {sql.UNION} SELECT query, kind, CAST(prio AS INTEGER) AS prio, CAST(rank AS INTEGER) AS rank, id FROM u")
def candidate_union(spark, d):
    return _union(spark, d)[1].select("query", "kind", "prio", "rank", "id")


@query(f"WITH {sql.UNION} SELECT query, kind, CAST(prio AS INTEGER) AS prio, CAST(rank AS INTEGER) AS rank, id FROM f")
def candidate_dedup(spark, d):
    return context.first_by_id(_union(spark, d)[1]).select("query", "kind", "prio", "rank", "id")


def _relevant(spark, d):
    rows, union = _union(spark, d)
    found = written(context.first_by_id(union), "candidates")
    texts = rows.select(F.col("id").alias("query"), F.col("text").alias("passage"))
    both = F.array_intersect(retrieval.tokens(F.col("passage")), retrieval.tokens(F.col("text")))
    verdicts = context.judgeable(found).join(texts, "query").filter(F.size(both) >= 12).select("query", "id")
    return rows, context.relevant(found, verdicts)


@query(f"WITH {sql.UNION} SELECT query, kind, id FROM r")
def relevance_filter(spark, d):
    return _relevant(spark, d)[1].select("query", "kind", "id")


@query(f"WITH {sql.UNION}, {sql.BUCKETS} SELECT query, local_before, local_after, doc, system FROM bk")
def context_buckets(spark, d):
    return context.buckets(_relevant(spark, d)[1])


@query(f"WITH {sql.UNION} SELECT query, id FROM f WHERE prio >= 2 AND length(id) % 3 = 0")
def parse_relevance(spark, d):
    found = context.first_by_id(_union(spark, d)[1]).filter("prio >= 2")
    said = F.when(F.length("id") % 3 == 0, F.lit("\tYES")).when(F.length("id") % 3 == 1, F.lit(" no")).otherwise(F.lit(" maybe yes."))
    replies = found.groupBy("query").agg(F.array_join(F.collect_list(F.concat("id", said)), "\n").alias("reply"))
    return parsing.relevance_verdicts(replies)


def _section(title: str, e: str) -> str:
    return f"CASE WHEN length({e}) > 0 THEN '## {title}' || chr(10) || {e} || chr(10) || chr(10) ELSE '' END"


def _prompt(mode: str) -> str:
    parts = [_section(prompts.TITLES[k], f"bk.{k}") for k in context.KINDS] + [_section("Passage", "p.text")]
    whole = " || ".join(f"coalesce({x}, '')" for x in parts)
    return f"WITH {sql.UNION}, {sql.BUCKETS} SELECT p.id, {whole} || '{prompts.TASKS[mode]}' AS prompt FROM p LEFT JOIN bk ON bk.query = p.id"


def _rendered(spark, d, mode):
    rows, kept = _relevant(spark, d)
    full = rows.select("id", "text").join(context.buckets(kept).withColumnRenamed("query", "id"), "id", "left")
    return full.select("id", prompts.contextualize(mode, F.col("text"), {k: F.col(k) for k in context.KINDS}).alias("prompt"))


@query(_prompt("prefix"))
def render_prompt_prefix(spark, d):
    return _rendered(spark, d, "prefix")


@query(_prompt("rewrite"))
def render_prompt_rewrite(spark, d):
    return _rendered(spark, d, "rewrite")


@query(
    f"""WITH {sql.UNION}, i AS (SELECT query, string_agg(id || chr(9) || text, chr(10) ORDER BY prio, rank, id) AS items FROM f WHERE prio >= 2 AND NOT regexp_matches(text, '^[ \\t\\n\\f\\r\\x0b]*$') GROUP BY query)
SELECT i.query, {_section('Passage', 'p.text')} || {_section('Candidates', 'items')} || '{prompts.RELEVANCE}' AS prompt FROM i JOIN p ON p.id = i.query"""
)
def render_relevance(spark, d):
    rows, union = _union(spark, d)
    found = context.judgeable(context.first_by_id(union))
    items = found.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("prio", "rank", "id", "text"))).alias("items"))
    full = items.join(rows.select(F.col("id").alias("query"), "text"), "query")
    return full.select("query", prompts.relevance(F.col("text"), F.col("items")).alias("prompt"))


_CONTEXTS = sql.latest("contextualized_chunks", "id")


@query(f"SELECT id, coalesce(nullif(trim(context_prefix), ''), '{context.NO_CONTEXT}') AS prefix, coalesce(nullif(trim(context_prefix), ''), '{context.NO_CONTEXT}') || ' ' || coalesce(chunk_raw, '') AS whole FROM {_CONTEXTS}")
def combine_prefix(spark, d):
    rows = current_rows(_table(spark, d, "contextualized_chunks").select("id", "chunk_raw", "context_prefix", "run"), "id")
    prefix, whole = context.combined("prefix", F.col("context_prefix"), F.col("chunk_raw"))
    return rows.select("id", prefix.alias("prefix"), whole.alias("whole"))


@query(f"SELECT id, coalesce(nullif(trim(chunk_ctx), ''), chunk_raw, '') AS prefix, coalesce(nullif(trim(chunk_ctx), ''), chunk_raw, '') AS whole FROM {_CONTEXTS}")
def combine_rewrite(spark, d):
    rows = current_rows(_table(spark, d, "contextualized_chunks").select("id", "chunk_raw", "chunk_ctx", "run"), "id")
    prefix, whole = context.combined("rewrite", F.col("chunk_ctx"), F.col("chunk_raw"))
    return rows.select("id", prefix.alias("prefix"), whole.alias("whole"))


# -- claims and triples -----------------------------------------------------------------------------------------------


def _strip(column: str) -> str:
    return sql.sub(f"coalesce({column}, '')", rf"^{sql.S}+|{sql.S}+\z", "")


_CLAIMS = sql.latest("claims", "claim_id")


@query(
    f"""WITH n AS (SELECT chunk_id, row_number() OVER (PARTITION BY chunk_id ORDER BY claim_id) AS n, {_strip('claim_text')} AS claim_text, {_strip('source_quote')} AS source_quote FROM {_CLAIMS})
SELECT chunk_id, chunk_id || '#' || n AS claim_id, claim_text, source_quote FROM n WHERE claim_text <> ''"""
)
def parse_claims(spark, d):
    rows = current_rows(_table(spark, d, "claims").select("doc", "chunk_id", "claim_id", "claim_text", "source_quote", "run"), "claim_id")
    items = F.array_sort(F.collect_list(F.struct("claim_id", "claim_text", "source_quote")))
    replies = rows.groupBy("doc", "chunk_id").agg(F.concat(F.lit("Here they are: "), F.to_json(items), F.lit("\nDone.")).alias("reply"))
    return parsing.claims(replies).select("chunk_id", "claim_id", "claim_text", "source_quote")


_TRIPLES = "(SELECT DISTINCT claim_id, claim_text, subject, predicate, object FROM triples)"


@query(f"SELECT claim_id, {', '.join(_strip(c) + f' AS {c}' for c in ('subject', 'predicate', 'object'))} FROM {_TRIPLES}")
def parse_triples(spark, d):
    rows = _table(spark, d, "triples").select("claim_id", "claim_text", "subject", "predicate", "object").distinct()
    reply = F.concat(F.lit("Sure: "), F.to_json(F.struct("subject", "predicate", "object")), F.lit(" (one triple)"))
    return parsing.triples(rows.select("claim_id", "claim_text", reply.alias("reply"))).drop("claim_text")


@query("SELECT DISTINCT subject AS src, predicate AS rel, object AS dst, claim_id FROM triples WHERE subject <> '' AND predicate <> '' AND object <> ''")
def triple_edges(spark, d):
    return pipeline.edges(_table(spark, d, "triples")).distinct()


@query(f"SELECT id, run, md5(coalesce(chunk, '')) AS digest FROM {sql.latest('raw_chunks', 'id')}")
def upsert_last_wins(spark, d):
    rows = current_rows(_table(spark, d, "raw_chunks").select("id", "run", "chunk"), "id")
    return rows.select("id", "run", F.md5(F.coalesce("chunk", F.lit(""))).alias("digest"))


# -- the whole pipeline with offline models; sequential or long, so without SQL -----------------------------------------


def _documents(spark, d):
    return _table(spark, d, "documents").select("doc", "text")


@query()
def chunk_embed(spark, d):
    return pipeline.chunk(_documents(spark, d))


def _small_chunks(spark, d):
    return current_rows(_table(spark, d, "raw_chunks").select("doc", "id", "chunk", "run"), "id").drop("run")


@query()
def contextualize_stub(spark, d):
    return pipeline.contextualize(_small_chunks(spark, d), _corpus(spark, d), judge=models.stub_relevance)


@query()
def contextualize_sequential(spark, d):
    def first(passage, before, after, history, system):
        return (history or system or before[-1:] or [""])[0][:80]

    return pipeline.contextualize_in_order(_small_chunks(spark, d), first, corpus=_corpus(spark, d), judge=models.overlap_judge)


def _contextualized(spark, d):
    rows = current_rows(_table(spark, d, "contextualized_chunks").select("doc", "id", "chunk_raw", "context_prefix", "chunk_ctx", "run"), "id")
    return rows.withColumnsRenamed({"chunk_raw": "chunk", "chunk_ctx": "contextualized_chunk"})


@query()
def claims_stub(spark, d):
    return pipeline.extract_claims(_contextualized(spark, d))


@query()
def triples_stub(spark, d):
    return pipeline.extract_triples(pipeline.extract_claims(_contextualized(spark, d)))
