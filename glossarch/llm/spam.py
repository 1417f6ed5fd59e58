"""Problem 9: pages of repeated keywords, lists of links, or tags.

Each word of a text is judged by the window of words around it: share of words in phrases that repeat (n-grams), of links and characters of
their text, hash tags, prices and separators, of the most frequent content word, of words that come again and again, of lines that occur many times, and of function words, which lists of tags lack. A text is such a page if more than half of its
characters are in words so judged. The threshold of every signal is fitted per language on labelled rows, drawn towards that of all languages by ``WEIGHT`` rows.

Work is done on whole batches: words become rows of a table of properties (each distinct word is looked at once per
worker), windows are differences of running sums, repetition comes from one sort of the word pairs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Articles, pronouns, prepositions, conjunctions and auxiliary verbs of the languages of the corpus.
FUNCTION_WORDS = {
    "en": "the a an this that these those it its he she they we you our their which who whose of and to in for by with as on at from into than or but if no not any such until under between is was are be been has have had may shall will can must",
    "de": "der die das dem den des ein eine einer eines einem und oder aber von zu zur zum in im mit für auf aus bei nach über unter durch ohne innerhalb ist sind war wird werden hat haben kann soll nicht als so wie dass sich jeden jede vor",
    "fr": "le la les un une des de du et ou mais à au aux en dans par pour sur sous avec sans chez entre qui que dont est sont était a ont ne pas se ce cette son sa ses leur nous vous il elle avant chaque",
    "es": "el la los las un una unos y o pero de del al en por para con sin sobre entre que cuyo es son fue ha han no se su sus lo este esta todo antes",
}
# Marks of currencies before or after an amount.
CURRENCIES = ("EUR", "USD", "GBP", "CHF", "€", "$", "£")

#: words of the windows for shares and for repetition, and how often a phrase repeats within the latter
NEAR, WIDE, TIMES = 24, 64, 3
#: a passage of code, of a form or of prose that comes again word for word over more words than this is no keyword
VERBATIM = 12
#: how often a phrase or a line occurs in the whole text to repeat at any distance, where the text around it is a bare list, and a single word
OFTEN, AGAIN = 5, 8
#: labelled rows the thresholds are fitted on at most
LABELS = 20_000

_LINK = re.compile(r"https?://|www\.|[\w-]\.[a-z]{2,10}/|href=", re.IGNORECASE)
_SEPARATOR = re.compile(r"[/|>»•·;,\-–~*]+")
#: what readers see of a link, in HTML and Markdown
_ANCHOR = re.compile(r"<a\s[^>]*>(.*?)</a\s*>|\[([^\]\[]*)\]\(\s*[^\s)]+[^)]*\)", re.IGNORECASE | re.DOTALL)
_MARK = re.compile(r"[(){}\[\]<>=_\\]|[.!?:。！？।]['\"»”)]*$")
_EDGES = ".,;:!?()[]\"'»«|/#"


#: what is fitted: signals with the thresholds that hold without labels
SIGNALS = {"repeated": 0.58, "links": 0.12, "hash_tags": 0.3, "prices": 0.08, "separators": 0.3, "top_word": 0.3, "recurring": 0.8, "lines": 0.5, "link_text": 0.5}
#: multiples of these that are tried, and the rows by which all languages together count in the fit of one
GRID, WEIGHT = [0.8, 0.9, 1.0, 1.1, 1.2], 50


@dataclass(frozen=True)
class Thresholds:
    """Thresholds by signal, and where labels say otherwise by language and signal; the rest is not fitted."""

    general: dict[str, float] = field(default_factory=lambda: dict(SIGNALS))
    by_language: dict[str, dict[str, float]] = field(default_factory=dict)
    part: float = 0.5
    #: most function words beside separators and beside prices, most marks and numbers, capitals and colons beside separators, and least separators beside prices
    function_words: float = 0.08
    with_prices: float = 0.3
    marks: float = 0.2
    capitals: float = 0.75
    colons: float = 0.1
    initials: float = 0.08
    priced_separators: float = 0.04
    content: float = 0.5
    #: of a bare list, the most function words (in a line that comes again and again), and the most sentence ends, brackets and numbers together
    list_function_words: float = 0.2
    line_function_words: float = 0.35
    list_marks: float = 0.1
    #: least length of one content word that makes a page
    word_length: int = 4

    def of(self, signal: str, languages: list[str | None]) -> np.ndarray:
        return np.array([self.by_language.get(x or "", {}).get(signal, self.general[signal]) for x in languages])


LINK, TAG, PRICE, FUNCTION, SEPARATOR, MARK, CAPITAL, COLON, INITIAL = (1 << i for i in range(9))
#: bits of a word's code below its length, and the greatest length
BITS, LONGEST = 9, (1 << 23) - 1


class _Words(dict):
    """A word's bare form as a number (a hash, 0 if nothing is left of it), its length and properties, in one integer."""

    def __init__(self, room: int = 500_000):
        super().__init__()
        self.room = room
        self.function = {w for words in FUNCTION_WORDS.values() for w in words.split()}

    def __missing__(self, word: str) -> int:
        bare = word.strip(_EDGES).lower()
        marks = LINK * bool(_LINK.search(word)) | FUNCTION * (bare in self.function)
        marks |= TAG * (word[0] == "#" and len(word) > 2 and word[1].isalpha())
        marks |= PRICE * (word.startswith(CURRENCIES) and not word[-1].isalpha() or word in CURRENCIES or word.endswith(("€", "$", "£")))
        number = not any(map(str.isalpha, word)) and any(map(str.isdigit, word))
        marks |= SEPARATOR * bool(word[-1] in ",;/|>" or _SEPARATOR.fullmatch(word))
        marks |= CAPITAL * bare[:1].isalpha() * word.strip(_EDGES)[:1].isupper()
        marks |= MARK * bool(_MARK.search(word) or number) | COLON * (word[-1] == ":") | INITIAL * (1 < len(word) < 4 and word[0].isupper() and word[1] == ".")
        name = (xxhash.xxh3_64_intdigest(bare.encode("utf-8", "surrogatepass")) & 0x7FFFFFFF) | 1 if bare else 0
        code = name << 32 | min(len(word), LONGEST) << BITS | marks
        if len(self) < self.room:
            self[word] = code
        return code


def _window(total: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return (total[last] - total[first]) / np.maximum(last - first, 1)


def _sums(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0.0], np.cumsum(flags, dtype=np.float64)])


def _repeated_lines(text: str) -> np.ndarray | None:
    """Of every word, whether its line occurs OFTEN times in the text; None if no line does."""
    lines = text.splitlines()
    if len(lines) < OFTEN:
        return None
    plain = [" ".join(line.lower().split()) for line in lines]
    count = Counter(plain)
    if max((n for line, n in count.items() if line), default=0) < OFTEN:
        return None
    words = [len(line.split()) for line in plain]
    return np.repeat([count[line] >= OFTEN for line in plain], words)


def _link_texts(text: str) -> np.ndarray | None:
    """Of every word, the part of its characters in the text of links; None if there are no such links."""
    if "](" not in text and "</a" not in text and "</A" not in text:
        return None
    inside = np.zeros(len(text) + 1)
    for m in _ANCHOR.finditer(text):
        inside[slice(*m.span(1 if m[1] is not None else 2))] = 1
    total = _sums(inside)
    at = np.array([m.span() for m in re.finditer(r"\S+", text)]).reshape(-1, 2)
    return (total[at[:, 1]] - total[at[:, 0]]) / (at[:, 1] - at[:, 0])


class Words:
    """Every word of a batch of texts: ``owner`` (its text), ``chars``, and what is around it."""

    def __init__(self, texts: list[str | None], look: _Words):
        codes: list[int] = []
        counts = np.zeros(len(texts), np.int64)
        again_lines: dict[int, np.ndarray] = {}
        anchors: dict[int, np.ndarray] = {}
        for i, text in enumerate(texts):
            if text:
                words = text.split()
                if (marked := _repeated_lines(text)) is not None:
                    again_lines[len(codes)] = marked
                if (marked := _link_texts(text)) is not None:
                    anchors[len(codes)] = marked
                codes.extend(map(look.__getitem__, words))
                counts[i] = len(words)
        code = np.array(codes, np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)
        ends = np.cumsum(counts)
        start, end = np.repeat(ends - counts, counts), np.repeat(ends, counts)
        at = np.arange(len(code))
        name, chars = code >> 32, (code >> BITS & LONGEST) + 1
        flag = {k: (code & k) > 0 for k in (LINK, TAG, PRICE, FUNCTION, SEPARATOR, MARK, CAPITAL, COLON, INITIAL)}
        self.owner, self.chars, self.long, self.n = owner, chars, end - start >= NEAR // 2, len(texts)

        def span(width: int) -> tuple[np.ndarray, np.ndarray]:
            first = np.maximum(start, np.minimum(at - width // 2, end - width))
            return first, np.minimum(first + width, end)

        def marked_by(by: dict[int, np.ndarray]) -> np.ndarray:
            out = np.zeros(len(code))
            for first, values in by.items():
                out[first : first + len(values)] = values
            return out

        near, wide = span(NEAR), span(WIDE)
        t = Thresholds()  # of what is not fitted
        f = flag[FUNCTION]
        self.share = share = {k: _window(_sums(v), *near) for k, v in flag.items()}
        # keywords in a row: hardly a function word, sentence end, bracket or number, unlike code, forms and prose
        little, plain = _window(_sums(f), *wide), _window(_sums(flag[MARK]), *wide) <= t.list_marks
        self.bare = bare = (little <= t.list_function_words) & plain
        self.line_like = (little <= t.line_function_words) & plain

        # one content word between ever different ones: occurrences, and the share of it in the window around each
        w = np.flatnonzero((name > 0) & ~f & ~flag[MARK] & (chars - 1 >= t.word_length) & self.long)
        w = w[np.lexsort((w, name[w], owner[w]))]
        group = np.cumsum(np.r_[0, (np.diff(owner[w]) != 0) | (np.diff(name[w]) != 0)]) if len(w) else w
        place = group * (len(code) + 1) + w
        met = np.searchsorted(place, place - w + wide[1][w]) - np.searchsorted(place, place - w + wide[0][w])
        self.top = w, group, met / np.maximum(wide[1][w] - wide[0][w], 1)
        # words that come again and again, unlike names and terms
        again = np.zeros(len(code), bool)
        again[w] = (np.bincount(group)[group] >= AGAIN) if len(w) else False
        self.recurring = _window(_sums(again), *wide)

        self.lines = _window(_sums(marked_by(again_lines)), *wide) if again_lines else np.zeros(len(code))
        size = _sums(chars)
        shown = _sums(marked_by(anchors) * chars) if anchors else np.zeros(len(code) + 1)
        self.shown = (shown[near[1]] - shown[near[0]]) / np.maximum(size[near[1]] - size[near[0]], 1)

        # pairs of neighbouring words, not both function words, that occur TIMES times within WIDE words, or OFTEN times in a bare list
        n = len(code)
        pairs = np.flatnonzero((owner[1:] == owner[:-1]) & (name[1:] > 0) & (name[:-1] > 0)) if n > 1 else np.empty(0, np.int64)
        p = pairs[np.lexsort((pairs, name[pairs + 1], name[pairs], owner[pairs]))]

        def same(step: int) -> np.ndarray:
            q, r = p[:-step], p[step:]
            return (owner[q] == owner[r]) & (name[q] == name[r]) & (name[q + 1] == name[r + 1])

        dense, far, apart = np.zeros(len(p), bool), np.zeros(len(p), bool), np.zeros(n + 1, np.int64)
        if len(p) >= TIMES:
            close = same(TIMES - 1) & (p[TIMES - 1 :] - p[: -(TIMES - 1)] <= WIDE)
            for k in range(TIMES):
                dense[k : len(p) - TIMES + 1 + k] |= close
            # a passage of more than VERBATIM words that comes again as a whole is not a keyword, unless it is a bare list
            apart[p[1:]] = np.where(same(1), p[1:] - p[:-1], 0)
        if len(p) >= OFTEN:
            many = same(OFTEN - 1)
            for k in range(OFTEN):
                far[k : len(p) - OFTEN + 1 + k] |= many
        edges = np.flatnonzero(np.diff(apart, prepend=-1))
        length = np.repeat(np.diff(edges, append=n + 1), np.diff(edges, append=n + 1))
        whole = ((length >= VERBATIM) & (apart > VERBATIM))[:n]
        again = np.zeros(n, bool)
        d = p[dense & ~(f[p] & f[p + 1])] if len(p) else p
        again[d] = again[d + 1] = True
        # both the passage and what it repeats
        exempt = np.zeros(n, bool)
        for i in (0, 1):
            back = np.flatnonzero(whole) + i
            exempt[back[back < n]] = True
            back = np.flatnonzero(whole) - apart[:n][whole] + i
            exempt[back[back >= 0]] = True
        again &= ~exempt | bare
        d = p[far & bare[p] & ~(f[p] & f[p + 1])] if len(p) else p
        again[d] = again[d + 1] = True
        repeated = _window(_sums(again), *wide) + 2 * _window(_sums(flag[LINK]), *wide)
        # lists of people or duties repeat their function words and one noun; keywords repeat most content words
        content = _window(_sums(~f), *wide)
        many = _window(_sums(again & ~f), *wide) >= t.content * content
        # entries of a list of references have initials
        self.repeated = np.where((many | (share[LINK] > 0)) & self.long & (share[INITIAL] <= t.initials), repeated, 0.0)

    def judged(self, signal: str, limits: np.ndarray, rest: Thresholds) -> np.ndarray:
        """Of every word, whether ``signal`` makes it spam. ``limits`` has the threshold of each text."""
        share, limit = self.share, limits[self.owner] if len(self.owner) else np.zeros(0)
        if signal == "repeated":
            return self.repeated >= limit
        if signal == "links":
            return share[LINK] >= limit
        if signal == "hash_tags":
            return share[TAG] >= limit
        if signal == "prices":  # products one after the other, not a table of fees
            return (share[PRICE] >= limit) & (share[FUNCTION] <= rest.with_prices) & (share[SEPARATOR] >= rest.priced_separators)
        if signal == "separators":  # tags, not references, names or terms with synonyms
            tags = (share[MARK] <= rest.marks) & (share[CAPITAL] <= rest.capitals) & (share[COLON] <= rest.colons)
            return (share[SEPARATOR] >= limit) & (share[FUNCTION] <= rest.function_words) & tags
        if signal == "recurring":
            return (self.recurring >= limit) & self.bare & self.long
        if signal == "lines":
            return (self.lines >= limit) & self.line_like & self.long
        if signal == "link_text":
            return (self.shown >= limit) & self.long
        # from one occurrence of the word to the next, where it has its share of the window
        w, group, met = self.top
        top = self.bare[w] & (met >= limit[w])
        a, b = w[:-1], w[1:]
        next_to = (group[1:] == group[:-1]) & top[1:] & top[:-1]
        reach = np.zeros(len(self.owner) + 1, np.int64)
        np.add.at(reach, a[next_to], 1)
        np.add.at(reach, b[next_to] + 1, -1)
        return np.cumsum(reach)[: len(self.owner)] > 0

    def part(self, spam: np.ndarray) -> np.ndarray:
        """The part of the characters of each text that ``spam`` holds."""
        total = np.maximum(np.bincount(self.owner, self.chars, minlength=self.n), 1)
        return np.bincount(self.owner, self.chars * spam, minlength=self.n) / total


def parts(words: Words, languages: list[str | None], rule: Thresholds, grid: bool = False) -> np.ndarray:
    """The judged part of each text; with ``grid``, a row for each text with that for each multiple of each signal's threshold."""
    each = {s: words.judged(s, rule.of(s, languages), rule) for s in SIGNALS}
    count = np.sum(list(each.values()), axis=0)
    if not grid:
        return words.part(count > 0)
    out = []
    for s, mask in each.items():
        others = count - mask > 0
        out += [words.part(others | words.judged(s, g * rule.of(s, languages), rule)) for g in GRID]
    return np.stack(out, 1)


def _language(c: Column) -> Column:
    return F.lower(F.substring(F.trim(c), 1, 2))


def spam_parts(df: DataFrame, key: str, text: str, language: str, grid: bool = False, thresholds: Thresholds | None = None) -> DataFrame:
    """``key, language, part`` - the part of characters judged spam - or, with ``grid``, ``parts``, one for each signal and multiple of its threshold.

    Null and empty texts and texts without words have part 0. ``language`` is cut to its lower-cased first two letters. No exchange.
    """
    rule = thresholds or Thresholds()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _Words()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                b = batch.slice(lo, 1024)
                found = parts(Words(b.column("text").to_pylist(), look), b.column("language").to_pylist(), rule, grid)
                out = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64())) if grid else pa.array(found)
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("language"), out], ["key", "language", "part"])

    rows = df.select(F.col(key).alias("key"), _language(F.col(language)).alias("language"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, language string, part {'array<double>' if grid else 'double'}")


def _fitted(wrong: np.ndarray, pooled: np.ndarray, rows: int) -> np.ndarray:
    """The multiple to take for each signal (rows): least errors, those of all languages counting as ``WEIGHT`` rows. Of equally good ones the nearest to 1."""
    cost = wrong + WEIGHT * pooled / max(rows, 1)
    order = np.argsort(np.abs(np.array(GRID) - 1), kind="stable")
    return np.array(GRID)[order[np.argmin(np.round(cost[:, order], 9), axis=1)]]


def calibrated(df: DataFrame, key: str, text: str, language: str, labels: DataFrame, label: str = "label") -> Thresholds:
    """Thresholds of all signals by language, from at most ``LABELS`` labelled rows (those of smallest hash).

    Each language is fitted on its own rows and, as ``WEIGHT`` more, those of all languages: with few labels it takes the thresholds of all languages,
    with many its own, without any labels the general ones stay. Labels other than spam and ok are ignored.
    """
    known = labels.filter(F.col(label).isin("spam", "ok")).select(F.col(key), F.col(label).alias("__label")).dropDuplicates([key])
    known = F.broadcast(known.orderBy(F.xxhash64(key), key).limit(LABELS))  # a key and one of two words in each row
    rows = df.select(key, text, language).join(known, key)
    found = spam_parts(rows, key, text, language, grid=True).join(known.withColumnRenamed(key, "key"), "key")
    size = len(SIGNALS) * len(GRID)
    wrong = [F.count(F.when((F.col("part")[i] > Thresholds.part) != (F.col("__label") == "spam"), 1)).alias(f"w{i}") for i in range(size)]
    # a row for each language
    errors = {r["language"]: (r["n"], np.array([r[f"w{i}"] for i in range(size)], float).reshape(-1, len(GRID))) for r in found.groupBy("language").agg(F.count(F.lit(1)).alias("n"), *wrong).collect()}
    total = sum(n for n, _ in errors.values())
    pooled = sum((w for _, w in errors.values()), np.zeros((len(SIGNALS), len(GRID))))
    defaults = np.array(list(SIGNALS.values()))

    def named(values: np.ndarray) -> dict[str, float]:
        return dict(zip(SIGNALS, values.tolist()))

    by_language = {x: named(defaults * _fitted(w, pooled, total)) for x, (_, w) in errors.items() if x}
    return Thresholds(named(defaults * _fitted(pooled, pooled, total)), by_language)


def spam_pages(df: DataFrame, key: str, text: str, language: str, thresholds: Thresholds) -> DataFrame:
    """``key, part`` of the texts more than half of whose characters are judged spam. Copies count each; null and empty texts never do."""
    return spam_parts(df, key, text, language, thresholds=thresholds).filter(F.col("part") > thresholds.part).select("key", "part")
