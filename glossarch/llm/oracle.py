"""SQL (DuckDB dialect) for the queries of this subpackage that SQL can answer over whole tables."""

from __future__ import annotations


def _current(table: str, key: str) -> str:
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY run DESC NULLS LAST) AS rn FROM {table} WHERE {key} IS NOT NULL) WHERE rn = 1)"


def _nearest(field: str, table: str, key: str) -> str:
    return f"""SELECT '{field}' AS field, probe_key, neighbour_key FROM (
  SELECT q.k AS probe_key, c.k AS neighbour_key, row_number() OVER (PARTITION BY q.k ORDER BY list_cosine_similarity(q.v, c.v) DESC, c.k) AS place
  FROM (SELECT {key} AS k, {field}::DOUBLE[] AS v FROM {_current(table, key)} WHERE len({field}) = 64 AND list_dot_product({field}::DOUBLE[], {field}::DOUBLE[]) > 0) c
  JOIN (SELECT {key} AS k, {field}::DOUBLE[] AS v FROM {_current(table, key)} WHERE len({field}) = 64 AND list_dot_product({field}::DOUBLE[], {field}::DOUBLE[]) > 0 AND {key} IN (SELECT key FROM knn_probes WHERE field = '{field}')) q ON q.k <> c.k
) WHERE place <= 5"""


def _longest(pattern: str, text: str = "chunk") -> str:
    return f"list_max(list_transform(regexp_split_to_array({text}, '{pattern}'), lambda s: length(s)))"


_BLANKS = r"[ \t\r\n]"
_LINE = rf"[ \t\r]*\n{_BLANKS}*"
_MARK = "\x01"

P3 = f"""SELECT id, CASE WHEN {_longest(rf'[ \t\r]*\n[ \t\r]*\n{_BLANKS}*')} <= 1000 THEN 'paragraph' WHEN {_longest(_LINE)} <= 1000 THEN 'line'
  WHEN {_longest(rf'{_LINE}|{_MARK}', rf"regexp_replace(chunk, '([.!?]){_BLANKS}+', '\1{_MARK}', 'g')")} <= 1000 THEN 'sentence'
  WHEN {_longest(rf'{_BLANKS}+')} <= 1000 THEN 'word' ELSE 'none' END AS boundary FROM {_current('raw_chunks', 'id')} WHERE length(chunk) > 1000"""


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_BLANKS}+'), lambda w: w <> '')"


def _similar(table: str, key: str, text: str) -> str:
    return f"""w AS (SELECT {key} AS k, {_words(f'lower({text})')} AS w FROM {_current(table, key)} WHERE {text} IS NOT NULL),
s AS (SELECT DISTINCT k, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS e FROM w),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
o AS (SELECT a.k AS ka, b.k AS kb, count(*) AS o FROM s a JOIN s b ON a.e = b.e AND a.k < b.k GROUP BY ALL)
SELECT ka AS rec_a, kb AS rec_b FROM o JOIN n x ON x.k = ka JOIN n y ON y.k = kb WHERE 10 * o >= 6 * (x.n + y.n - o)"""


def _groups(kind: str, table: str, key: str, text: str) -> str:
    pairs = _similar(table, key, text).replace("\nSELECT ka AS rec_a", ",\np AS (SELECT ka AS rec_a")
    return f"""RECURSIVE {pairs}),
c AS (SELECT k, min(k) OVER (PARTITION BY sig) AS class_id FROM (SELECT k, string_agg(e, chr(1) ORDER BY e) AS sig FROM s GROUP BY k)),
l AS (SELECT DISTINCT a.class_id AS x, b.class_id AS y FROM p JOIN c a ON a.k = rec_a JOIN c b ON b.k = rec_b WHERE a.class_id <> b.class_id),
b AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT DISTINCT class_id AS x, class_id AS top FROM c UNION SELECT b.y, r.top FROM r JOIN b USING (x))
SELECT '{kind}' AS kind, k AS key, class_id, (SELECT count(*) FROM b WHERE b.x = class_id) AS links, (SELECT min(top) FROM r WHERE r.x = class_id) AS group_id FROM c"""


def _best_term(field: str, table: str) -> str:
    return f"""t AS (SELECT id, unnest(regexp_extract_all(lower({field}), '[a-z0-9]+')) AS term FROM {_current(table, 'id')}),
tf AS (SELECT id, term, count(*) AS tf FROM t GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) > 1),
n AS (SELECT count({field})::DOUBLE AS n FROM {_current(table, 'id')})
SELECT '{field}' AS field, id, arg_min(term, (-score, term)) AS term FROM (SELECT id, term, round(tf * ln(n / df), 6) AS score FROM tf JOIN df USING (term), n) GROUP BY id"""


_PASSAGES = f"""r AS (SELECT 'c' || id AS rid, doc, chunk AS text FROM {_current('raw_chunks', 'id')} UNION ALL SELECT 'q' || claim_id, doc, source_quote FROM {_current('claims', 'claim_id')}),
w AS (SELECT rid, coalesce(doc, chr(0)) AS doc, {_words('text')} AS w FROM r WHERE text IS NOT NULL),
g AS (SELECT rid, doc, len(w) AS words, i, array_to_string(w[i:i + 24], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 23)) AS i FROM w))"""

# Written apart from the operator: the letters, hyphens and widthless characters of the test tables, by code point or by example.
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_NARROW = "".join(map(chr, range(0x21, 0x7F))).replace("'", "''")
_SHAPES = ("АВЕКМНОРСТХЅІЈаеорсухѕіјһԁёЁїЇѐЀӓӒӧӦӱӰΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρµ‐‑", "ABEKMHOPCTXSIJaeopcyxsijhdëËïÏèÈäÄöÖÿŸABEZHIKMNOPTYXovpμ--")
_LIGATURES = [("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "ſt"), ("ﬆ", "st")]
_WIDTHLESS = r"[\x00-\x08\x0E-\x1B\x7F-\x84\x86-\x9F\x{AD}\x{34F}\x{61C}\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}\x{E0001}-\x{E01EF}]"
_SPACES = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _form(text: str) -> str:
    out = f"regexp_replace({text}, '{_WIDTHLESS}', '', 'g')"
    for one, many in _LIGATURES:
        out = f"replace({out}, '{one}', '{many}')"
    # letters of the same shape, ready-made or with combining accents, which are then joined to the new letter
    out = f"nfc_normalize(translate(nfc_normalize(translate({out}, '{_WIDE}', '{_NARROW}')), '{_SHAPES[0]}', '{_SHAPES[1]}'))"
    return f"trim(regexp_replace({out}, '{_SPACES}', ' ', 'g'))"


P1 = f"""WITH f AS (SELECT id, chunk, {_form('chunk')} AS form FROM {_current('raw_chunks', 'id')} WHERE chunk <> '')
SELECT a.id AS id_a, b.id AS id_b FROM f a JOIN f b ON a.form = b.form AND a.chunk <> b.chunk AND a.id < b.id"""

P6_STRETCHES = f"""WITH {_PASSAGES},
h AS (SELECT g FROM g GROUP BY g HAVING count(DISTINCT doc) > 1),
s AS (SELECT DISTINCT rid, words, i - 1 AS first FROM g JOIN h USING (g)),
o AS (SELECT rid, words, first, CASE WHEN first <= lag(first) OVER (PARTITION BY rid ORDER BY first) + 25 THEN 0 ELSE 1 END AS new FROM s),
n AS (SELECT rid, words, first, sum(new) OVER (PARTITION BY rid ORDER BY first) AS part FROM o),
p AS (SELECT rid, words, min(first) AS first, max(first) + 24 AS last FROM n GROUP BY rid, words, part)
SELECT CASE WHEN rid[1] = 'c' THEN 'chunk' ELSE 'source_quote' END AS field, substr(rid, 2) AS key, CAST(words AS BIGINT) AS words, string_agg(first || '-' || last, ' ' ORDER BY first) AS stretches,
  CAST(sum(last - first + 1) AS BIGINT) AS shared_words, round(sum(last - first + 1) / words, 6) AS share FROM p GROUP BY rid, words"""


def _residuals(field: str, table: str) -> str:
    return f"""t AS (SELECT id, unnest(regexp_extract_all(lower({field}), '[a-z0-9]+')) AS term FROM {_current(table, 'id')}),
tf AS (SELECT id, term, count(*) AS tf FROM t GROUP BY ALL),
r AS (SELECT id, sum(tf) AS r FROM tf GROUP BY id),
c AS (SELECT term, count(*) AS records, sum(tf) AS c FROM tf GROUP BY term HAVING count(*) > 1),
n AS (SELECT sum(tf)::DOUBLE AS n FROM tf)
SELECT '{field}' AS field, id, term, CAST(tf AS BIGINT) AS tf, CAST(records AS BIGINT) AS records, round((tf - r * c / n) / sqrt(r * c / n), 6) AS residual,
  round((tf - r * c / n) / sqrt(r * c / n) / sqrt((1 - r / n) * (1 - c / n)), 6) AS adjusted FROM tf JOIN r USING (id) JOIN c USING (term), n"""


ORACLE = {
    "p1_found": P1,
    "p1_one_form": f"SELECT id, {_form('chunk')} AS form FROM {_current('raw_chunks', 'id')}",
    "p2_found": " UNION ALL ".join(_nearest(*x) for x in (("emb", "raw_chunks", "id"), ("emb_ctx", "contextualized_chunks", "id"), ("claim_emb", "claims", "claim_id"))),
    "p3_found": P3,
    "p4_found": f"SELECT * FROM (WITH {_similar('raw_chunks', 'id', 'chunk')}) UNION ALL SELECT * FROM (WITH {_similar('claims', 'claim_id', 'claim_text')})",
    "p4_groups": f"SELECT * FROM (WITH {_groups('chunk', 'raw_chunks', 'id', 'chunk')}) UNION ALL SELECT * FROM (WITH {_groups('claim_text', 'claims', 'claim_id', 'claim_text')})",
    "p5_found": f"SELECT * FROM (WITH {_best_term('chunk', 'raw_chunks')}) UNION ALL SELECT * FROM (WITH {_best_term('chunk_ctx', 'contextualized_chunks')})",
    "p5_residuals": f"SELECT * FROM (WITH {_residuals('chunk', 'raw_chunks')}) UNION ALL SELECT * FROM (WITH {_residuals('chunk_ctx', 'contextualized_chunks')})",
    "p6_stretches": P6_STRETCHES,
    "p6_found": f"WITH {_PASSAGES} SELECT DISTINCT least(substr(a.rid, 2), substr(b.rid, 2)) AS rec_a, greatest(substr(a.rid, 2), substr(b.rid, 2)) AS rec_b FROM g a JOIN g b ON a.g = b.g AND a.doc < b.doc",
}
