"""Text normalisation: quotes, line ends, list markers, lines broken inside a sentence, spacing.

Each step is a column expression; their order matters and is that of ``STEPS``. White space is the same explicit set in
every step, so that the result does not depend on a regex dialect.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: white space as a character set, valid inside brackets of a Java or RE2 pattern.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
S, NOT_S = f"[{SPACE}]", f"[^{SPACE}]"

# Characters written as an ASCII one.
PLAIN = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "\xa0": " "}

# The patterns in their order, by step, and what takes their place.
PATTERNS = {
    "newlines": [(r"\r\n?", "\n"), (rf"\n{S}*\n{S}*\n+", "\n\n")],
    "markers": [(rf"\((\p{{Nd}}+|[a-z])\){S}*\n+{S}*", "($1) "), (rf"\){S}*\n+{S}*\(", ")\n(")],
    "join_lines": [(rf"(?<![.!?;:])\n(?={NOT_S})", " ")],
    "spacing": [(r"(?md)^[ \t]+(\([a-z0-9]+\))", "$1"), (" {2,}", " "), (r"[ \t]*\n[ \t]*", "\n"), (rf"{S}+([,.;:])", "$1"), (rf"^{S}+|{S}+\z", "")],
}

#: the steps in their order
STEPS = ("quotes", *PATTERNS)


def plain_punctuation(c: Column) -> Column:
    """Curly quotes, long dashes and no-break spaces become their ASCII kin."""
    return F.translate(c, "".join(PLAIN), "".join(PLAIN.values()))


def steps(c: Column, *names: str) -> Column:
    """Some of the steps: ``quotes``, ``newlines`` (ends of lines, runs of blank lines), ``markers`` (list markers join their text),
    ``join_lines`` (line breaks inside a sentence), ``spacing``."""
    for name in names:
        if name == "quotes":
            c = plain_punctuation(c)
        for pattern, to in PATTERNS.get(name, ()):
            c = F.regexp_replace(c, pattern, to)
    return c


def clean(c: Column) -> Column:
    """The whole normaliser. Null stays null."""
    return steps(c, *STEPS)
