"""SQL (DuckDB dialect) that the queries of the catalog are compared with, written apart from their Spark code."""

from __future__ import annotations

# White space, from the definition of the language and not from the engine's list.
_SPACES = "".join(rf"\x{{{ord(c):x}}}" for c in map(chr, range(0x3001)) if c.isspace())
S, NOT_S = f"[{_SPACES}]", f"[^{_SPACES}]"
# Typographic quotes, dashes and the no-break space by code point, and what they are written as.
_ASCII = [(8216, 39), (8217, 39), (8220, 34), (8221, 34), (8211, 45), (8212, 45), (160, 32)]


def sub(expr: str, pattern: str, to: str) -> str:
    return f"regexp_replace({expr}, '{pattern}', '{to}', 'g')"


def quotes(e: str) -> str:
    for odd, plain in _ASCII:
        e = f"replace({e}, chr({odd}), chr({plain}))"
    return e


def newlines(e: str) -> str:
    return sub(sub(e, r"\r\n?", "\n"), rf"\n{S}*\n{S}*\n+", "\n\n")


def markers(e: str) -> str:
    e = sub(e, rf"\((\p{{Nd}}+|[a-z])\){S}*\n+{S}*", r"(\1) ")
    e = sub(e, rf"\){S}*\n+{S}*\(", ")\n(")
    return sub(e, rf"\(([a-z])\){S}*\n{S}*", r"(\1) ")


def join_lines(e: str) -> str:
    """RE2 has no lookbehind: the neighbours are part of the match, so neighbouring matches take a second pass."""
    e = sub(e, rf"^\n({NOT_S})", r" \1")
    for _ in range(2):
        e = sub(e, rf"([^.!?;:])\n({NOT_S})", r"\1 \2")
    return e


def spacing(e: str) -> str:
    e = sub(e, r"(?m)^[ \t]+(\([a-z0-9]+\))", r"\1")
    e = sub(sub(e, " {2,}", " "), r"[ \t]*\n[ \t]*", "\n")
    return sub(sub(e, rf"{S}+([,.;:])", r"\1"), rf"^{S}+|{S}+\z", "")


def clean(e: str) -> str:
    return spacing(join_lines(markers(newlines(quotes(e)))))


def tokens(e: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({e}), '[^a-z0-9]+'), lambda t: t <> '')"


def words(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, '{S}+'), lambda w: w <> '')"


def cost(w: str) -> str:
    # a run of letters and digits is one piece, any other character is one, too
    return f"(len(regexp_extract_all({w}, '[0-9a-zA-Z]+')) + length(regexp_replace({w}, '[0-9a-zA-Z]', '', 'g')))"


def start_valid(w: str) -> str:
    bare = rf"regexp_replace({w}, '^[^\p{{L}}\p{{N}}_]+', '')"
    return rf"(regexp_matches({bare}, '^\p{{Nd}}+[a-zA-Z]?\)?\.?$') OR regexp_matches({bare}, '^\p{{L}}'))"


def unit(v: str) -> str:
    return f"list_transform({v}::DOUBLE[], lambda x: x / (sqrt(list_dot_product({v}::DOUBLE[], {v}::DOUBLE[])) + 1e-12))"


def dot(a: str, b: str) -> str:
    return f"(CASE WHEN len({a}) = len({b}) AND len({a}) > 0 THEN list_dot_product({a}, {b}) END)"


WORD_LIST = f"words AS (SELECT DISTINCT unnest({words('text')}) AS word FROM documents WHERE text IS NOT NULL)"

# -- passages: current rows of raw_chunks in the order of their documents ----------------------------------------


def latest(table: str, key: str) -> str:
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY run DESC NULLS LAST) AS rn FROM {table} WHERE {key} IS NOT NULL) WHERE rn = 1)"


SUFFIX = "coalesce(try_cast(regexp_extract(id, '_([0-9]+)$', 1) AS BIGINT), 1000000000)"
PASSAGES = f"""p AS (SELECT doc, id, {SUFFIX} AS suffix, coalesce(chunk, '') AS text, CASE WHEN len(emb) = 64 THEN {unit('emb')} END AS v,
  CAST(row_number() OVER (PARTITION BY doc ORDER BY {SUFFIX}, id) AS INTEGER) AS pos FROM {latest('raw_chunks', 'id')})"""

BM25 = "ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / mean))"

HISTORY = f"""{PASSAGES},
tok AS (SELECT doc, pos, {tokens('text')} AS t FROM p),
tf AS (SELECT doc, pos, term, count(*) AS tf FROM (SELECT doc, pos, unnest(t) AS term FROM tok) GROUP BY ALL),
st AS (SELECT doc, pos, len(t) AS len, count(*) OVER w AS n, avg(len(t)) OVER w AS mean FROM tok WINDOW w AS (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
met AS (SELECT q.doc, q.pos, h.pos AS hist, q.term, h.tf, count(*) OVER (PARTITION BY q.doc, q.pos, q.term) AS df FROM tf q JOIN tf h ON q.doc = h.doc AND q.term = h.term AND h.pos < q.pos),
bm AS (SELECT m.doc, m.pos, m.hist, sum({BM25}) AS bm25 FROM met m JOIN (SELECT doc, pos, n, mean FROM st) s ON m.doc = s.doc AND m.pos = s.pos
  JOIN (SELECT doc, pos AS hist, len FROM st) l ON m.doc = l.doc AND m.hist = l.hist GROUP BY ALL),
pairs AS (SELECT q.doc, q.id, q.pos, h.pos AS hist, h.id AS hist_id, coalesce({dot('q.v', 'h.v')}, 0) AS dense, coalesce(b.bm25, 0) AS bm25
  FROM p q JOIN p h ON q.doc = h.doc AND h.pos < q.pos LEFT JOIN bm b ON b.doc = q.doc AND b.pos = q.pos AND b.hist = h.pos),
lim AS (SELECT *, min(dense) OVER w AS d0, max(dense) OVER w AS d1, min(bm25) OVER w AS b0, max(bm25) OVER w AS b1 FROM pairs WINDOW w AS (PARTITION BY doc, pos)),
sc AS (SELECT doc, id, pos, hist, hist_id, 0.6 * CASE WHEN d1 > d0 THEN (dense - d0) / (d1 - d0) ELSE 0 END + 0.4 * CASE WHEN b1 > b0 THEN (bm25 - b0) / (b1 - b0) ELSE 0 END AS score FROM lim),
top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY doc, pos ORDER BY round(score, 9) DESC, hist) AS INTEGER) AS place FROM sc) WHERE place <= 2),
kept AS (SELECT * FROM top WHERE pos - hist > 1)"""

SYSTEM = f"""corpus AS (SELECT id, chunk_ctx AS text, CASE WHEN len(emb_ctx) = 64 THEN {unit('emb_ctx')} END AS v FROM {latest('contextualized_chunks', 'id')} WHERE chunk_ctx <> ''),
ctok AS (SELECT id, {tokens('text')} AS t FROM corpus),
cstat AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM ctok),
ctf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(t) AS term FROM ctok) GROUP BY ALL),
cdf AS (SELECT term, count(*) AS df FROM ctf GROUP BY ALL),
asked AS (SELECT id AS query, text, v FROM p WHERE suffix % 20 = 0),
qt AS (SELECT DISTINCT query, unnest({tokens('text')}) AS term FROM asked),
sb AS (SELECT query, c.id AS candidate, sum({BM25}) AS bm25 FROM qt JOIN ctf c USING (term) JOIN cdf USING (term) JOIN (SELECT id, len(t) AS len FROM ctok) l ON l.id = c.id, cstat GROUP BY ALL),
spairs AS (SELECT a.query, c.id AS candidate, coalesce({dot('a.v', 'c.v')}, 0) AS dense, coalesce(sb.bm25, 0) AS bm25 FROM asked a CROSS JOIN corpus c LEFT JOIN sb ON sb.query = a.query AND sb.candidate = c.id),
slim AS (SELECT *, min(dense) OVER w AS d0, max(dense) OVER w AS d1, min(bm25) OVER w AS b0, max(bm25) OVER w AS b1 FROM spairs WINDOW w AS (PARTITION BY query)),
ssc AS (SELECT query, candidate, dense, bm25, 0.6 * CASE WHEN d1 > d0 THEN (dense - d0) / (d1 - d0) ELSE 0 END + 0.4 * CASE WHEN b1 > b0 THEN (bm25 - b0) / (b1 - b0) ELSE 0 END AS score FROM slim),
stop AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, candidate) AS INTEGER) AS place FROM ssc) WHERE place <= 3)"""

LOCAL = """loc AS (SELECT q.id AS query, 'local_before' AS kind, 0 AS prio, 0 AS rank, h.id, h.text FROM p q JOIN p h ON q.doc = h.doc AND h.pos = q.pos - 1
  UNION ALL SELECT q.id, 'local_after', 1, 0, h.id, h.text FROM p q JOIN p h ON q.doc = h.doc AND h.pos = q.pos + 1)"""

UNION = f"""{HISTORY},
{SYSTEM},
{LOCAL},
u AS (SELECT * FROM loc UNION ALL SELECT k.id, 'doc', 2, k.place, k.hist_id, h.text FROM kept k JOIN p h ON h.id = k.hist_id
  UNION ALL SELECT s.query, 'system', 3, s.place, s.candidate, c.text FROM stop s JOIN corpus c ON c.id = s.candidate WHERE s.place <= 1),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query, id ORDER BY prio, rank) AS n FROM u) WHERE n = 1),
r AS (SELECT f.* FROM f JOIN p q ON q.id = f.query WHERE prio < 2 OR len(list_intersect({tokens('q.text')}, {tokens('f.text')})) >= 12)"""

BUCKETS = """bk AS (SELECT query, coalesce(string_agg(text, chr(10) || chr(10) ORDER BY rank) FILTER (kind = 'local_before'), '') AS local_before,
  coalesce(string_agg(text, chr(10) || chr(10) ORDER BY rank) FILTER (kind = 'local_after'), '') AS local_after,
  coalesce(string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) FILTER (kind = 'doc'), '') AS doc,
  coalesce(string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) FILTER (kind = 'system'), '') AS system FROM r GROUP BY query)"""

SPANS = f"""RECURSIVE d AS (SELECT doc, {words(clean('text'))} AS w FROM documents WHERE text IS NOT NULL),
pos AS (SELECT doc, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
cum AS (SELECT doc, i, word, sum({cost('word')}) OVER (PARTITION BY doc ORDER BY i) AS s FROM pos),
f AS MATERIALIZED (SELECT doc, list(word ORDER BY i) AS w, list_concat([0::HUGEINT], list(s ORDER BY i)) AS s, list(regexp_matches(word, '[A-Za-z0-9]') ORDER BY i) AS y, list({start_valid('word')} ORDER BY i) AS o FROM cum GROUP BY doc),
step AS (
  SELECT doc, 0::BIGINT AS at, -1::BIGINT AS reached, 0::BIGINT AS first, 0::BIGINT AS past, false AS emitted FROM f
  UNION ALL
  SELECT doc, CASE WHEN ok AND back > first AND back < past THEN back ELSE past END, CASE WHEN ok THEN past ELSE reached END, first, past, ok FROM (
    SELECT *, o[first + 1] AND past > reached AS ok, len(list_filter(s, lambda v: v <= s[past + 1] - 20)) - 1 AS back FROM (
      SELECT *, greatest(first + 1, len(list_filter(s, lambda v: v <= s[first + 1] + 100)) - 1) AS past FROM (
        SELECT f.*, step.reached, step.at + list_position(f.y[step.at + 1:], true) - 1 AS first FROM step JOIN f USING (doc)
        WHERE coalesce(list_position(f.y[step.at + 1:], true), 0) > 0
      )))),
spans AS (SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY first) AS INTEGER) AS seq, CAST(first AS INTEGER) AS first, CAST(past - 1 AS INTEGER) AS last FROM step WHERE emitted)"""
