"""Problem 1: one form for texts that look the same.

A precomputed table says what characters and grapheme clusters are written as: all single characters, and all bases with a mark that Unicode can compose. It is checked
for conflicts when it is built. A compiled longest-match pattern walks the text once and replaces what the table changes; clusters of more marks, of which
there is no end, are written by the rules the table is built by, and remembered. Nothing visible is merged: case, accents,
digits, raised digits, dash lengths and punctuation stay as they are. Letters in a style of their own (bold, script, double-struck) are visibly different, too.
"""

from __future__ import annotations

import re
import unicodedata as U
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossarch.plans.scratch import written

# Letters of other alphabets (first word of a pair) that have the shape of another letter (second).
SAME_SHAPE = {
    "cyrillic": ("АВЕКМНОРСТХЅІЈҮԚԜӀѴ", "ABEKMHOPCTXSIJYQWIV"),
    "cyrillic small": ("аеорсухѕіјһԁԛԝӏѵ", "aeopcyxsijhdqwlv"),
    "greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "ABEZHIKMNOPTYXCJ"),
    "greek small": ("οϲϳνρ", "ocjvp"),
    "armenian": ("ՕՏԼ", "OSL"),
    "armenian small": ("օոսհյց", "onuhjg"),
    "cherokee": ("ᎠᎢᎪᎫᎬᎳᎷᎻᏀᏃᏒᏔᏙᏚᏞᏟᏢᏦᏴ", "DTAJEWMHGZRWVSLCPKB"),
    "coptic": ("ⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲬ", "BHIKMNOPCTX"),
    "coptic small": ("ⲟⲣⲥ", "opc"),
    "lisu": ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    "small capitals with the shape of a small letter": ("ᴄᴏᴠᴡᴢꜱ", "covwzs"),
    "micro sign": ("µ", "μ"),
}
# Code points of a short hyphen besides the ASCII one.
HYPHENS = "‐‑－"
# Format characters that do have a width.
WIDE_FORMATS = [*range(0x600, 0x606), 0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD]
# Characters without width outside the category of format characters.
MORE_WIDTHLESS = [0x34F, 0x17B4, 0x17B5, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]
# Half-width voiced sound marks, letters by category.
HALF_WIDTH_MARKS = "\uff9e\uff9f"
# Line breaks and separators outside the category of space separators.
BREAKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85  "


def _kind(c: str) -> str:
    o, cat = ord(c), U.category(c)
    if cat == "Zs" or c in BREAKS:
        return "blank"
    if (cat in ("Cf", "Cc") and o not in WIDE_FORMATS) or o in MORE_WIDTHLESS:
        return "widthless"
    return "mark" if cat[0] == "M" or c in HALF_WIDTH_MARKS else ""


def _single(c: str, shapes: dict[str, str]) -> str:
    """What one character, already decomposed, is written as."""
    if c in shapes:
        return shapes[c]
    tag, _, rest = U.decomposition(c).partition(" ")
    if tag in ("<wide>", "<narrow>") or (tag == "<compat>" and _ligature(c, rest)):
        return "".join(_single(chr(int(x, 16)), shapes) for x in rest.split())
    return c


def _ligature(c: str, parts: str) -> bool:
    letters = [chr(int(x, 16)) for x in parts.split()]
    here = ord(c) < 0x600 or 0xFB00 <= ord(c) < 0xFB50
    # ligatures of letters, and Roman numerals of one or more letters
    return (here and len(letters) > 1 or U.category(c) == "Nl") and all(U.category(x)[0] == "L" for x in letters)


def _set(chars: list[str]) -> str:
    """The inside of a character class, neighbours joined to ranges."""
    out, codes = [], sorted(map(ord, chars))
    while codes:
        n = next((i for i in range(1, len(codes)) if codes[i] != codes[0] + i), len(codes))
        out.append(f"\\U{codes[0]:08x}-\\U{codes[n - 1]:08x}")
        codes = codes[n:]
    return "".join(out)


class Transducer(dict):
    """Maps a matched stretch to its one form; clusters that are not in the table are remembered when met (up to ``room`` entries)."""

    def __init__(self, same_shape: dict[str, tuple[str, str]] = SAME_SHAPE, room: int = 200_000):
        super().__init__()
        self.room = room
        self.shapes = {h: "-" for h in HYPHENS}
        for name, (those, these) in same_shape.items():
            if len(those) != len(these):
                raise ValueError(f"{name}: the two lists differ in length")
            for a, b in zip(those, these):
                if self.shapes.setdefault(a, b) != b:
                    raise ValueError(f"{a!r} is mapped to {self.shapes[a]!r} and {b!r}")
        for a, b in self.shapes.items():
            if b in self.shapes or _kind(a) or _kind(b):
                raise ValueError(f"{a!r} -> {b!r} leads to another rule")
        space: dict[str, list[str]] = {"blank": [], "widthless": [], "mark": [], "changed": []}
        for c in map(chr, range(0x110000)):
            if (cat := U.category(c)) in ("Cn", "Co", "Cs"):  # not assigned, private, surrogates
                continue
            if kind := _kind(c):
                space[kind].append(c)
            elif cat == "Lo" and "가" <= c <= "힣" or not (U.decomposition(c) or c in self.shapes):
                continue
            else:
                parts = U.normalize("NFD", c)
                form = self.cluster(c)
                if self.cluster(form) != form:
                    raise ValueError(f"U+{ord(c):04X} is not stable: {form!r}")
                if form != c:
                    space["changed"].append(c)
                    self[c] = form
                if len(parts) == 2 and _kind(parts[1]) == "mark":  # a base with one mark, ready-made or not
                    if self.setdefault(parts, form) != form:
                        raise ValueError(f"{parts!r} is written as {self[parts]!r} and {form!r}")
        blank, none, mark, changed = (_set(v) for v in space.values())
        odd = _set([c for c in space["blank"] if c != " "])
        #: a text in which this finds nothing is in its form already
        self.trigger = re.compile(f"[{odd}{none}{mark}{changed}ᄀ-ᇿ]|  |^ | $")
        self.room += len(self)
        self.pattern = re.compile(
            # syllables and parts of syllables, to be joined
            f"[가-힣ᄀ-ᇿ][{mark}{none}ᄀ-ᇿ]+"
            # a base with marks, widthless characters between them or not
            f"|[^{blank}{none}{mark}](?=[{mark}{none}])[{none}]*[{mark}][{mark}{none}]*"
            # blanks and widthless characters, unless it is one plain space
            f"| [{blank}{none}]+|[{odd}{none}][{blank}{none}]*"
            # everything else the table changes
            f"|[{changed}]|[{mark}][{mark}{none}]*"
        )
        self.blanks = set(space["blank"])
        self.widthless = set(space["widthless"])

    def cluster(self, s: str) -> str:
        bare = U.normalize("NFD", "".join(c for c in s if _kind(c) != "widthless"))
        return U.normalize("NFC", "".join(_single(c, self.shapes) for c in bare))

    def __missing__(self, s: str) -> str:
        if s[0] in self.blanks or s[0] in self.widthless:
            form = " " if any(c in self.blanks for c in s) else ""
        else:
            form = self.cluster(s)
        if len(self) < self.room and len(s) < 40:
            self[s] = form
        return form

    def __call__(self, text: str) -> str:
        if not self.trigger.search(text):
            return text
        return self.pattern.sub(lambda m: self[m.group()], text).strip(" ")


@lru_cache(maxsize=1)
def transducer() -> Transducer:
    return Transducer()


@F.pandas_udf(T.StringType())
def one_form(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Column function: the one form of a text. Null stays null, a text of blanks and widthless characters becomes empty."""
    write = transducer()
    for batch in texts:
        yield pd.Series([None if t is None else write(t) for t in batch], dtype=object)


def canonical(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, form, variant, written`` for every row: the one form, a 128-bit name of it, and a hash of the text as stored."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("__t"))
    rows = rows.select("key", "__t", one_form("__t").alias("form"))
    return rows.select("key", "form", F.xxhash64("form").alias("f1"), F.xxhash64(F.lit(7), "form").alias("f2"), F.xxhash64("__t").alias("written"), (F.col("__t") == "").alias("empty"))


def same_look_groups(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, class_id, variants``: one row per record whose text looks like a differently stored text of another record.

    Records of one class look the same; ``variants`` is the number of different stored texts in it. Null and
    empty texts are in no class. Records that are plain copies of one another alone form no class.
    """
    rows = canonical(df, key, text).filter("form is not null and not empty").select("key", "f1", "f2", "written")
    rows = written(rows, "forms")  # the texts are walked once
    # distinct stored texts first: a large group of copies is one row per task before the exchange
    kinds = rows.groupBy("f1", "f2", "written").agg(F.count(F.lit(1)).alias("n"))
    several = kinds.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("variants")).filter("variants > 1")
    named = F.concat(F.lower(F.hex("f1")), F.lit("-"), F.lower(F.hex("f2"))).alias("class_id")
    return rows.join(several, ["f1", "f2"]).select("key", named, "variants", "written")


def same_look_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """``id_a, id_b``: pairs of keys whose texts are stored differently but look the same; each once, smaller key first.

    Different stored texts of a class meet first, once each, and then their records, so that the copies of one text are never compared with each other.
    """
    rows = written(same_look_groups(df, key, text), "same")
    kinds = rows.select("class_id", "written").distinct()
    met = kinds.withColumnRenamed("written", "wa").join(kinds.withColumnRenamed("written", "wb"), "class_id").filter("wa < wb")
    a = rows.select(F.col("key").alias("ka"), "class_id", F.col("written").alias("wa"))
    b = rows.select(F.col("key").alias("kb"), "class_id", F.col("written").alias("wb"))
    both = met.join(a, ["class_id", "wa"]).join(b, ["class_id", "wb"])
    return both.select(F.least("ka", "kb").alias("id_a"), F.greatest("ka", "kb").alias("id_b"))
