"""String helpers that keep the reference's exact text semantics.

All of them are built-in column expressions, so they stay in codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim() drops every character at or below U+0020 on both
# ends; F.trim() only drops spaces.
_JAVA_TRIM_CHARS = "".join(chr(i) for i in range(0x21))

# Line terminators as a line reader sees them.
LINE_BREAK = r"\r\n|\r|\n"


def java_trim(c: Column) -> Column:
    """Trim all characters <= U+0020 from both ends (String.trim)."""
    return F.btrim(c, F.lit(_JAVA_TRIM_CHARS))


def extract_tag(c: Column, tag: str) -> Column:
    """All ``<tag>…</tag>`` bodies, each trimmed, joined by one space, trimmed.

    Case-insensitive, dot matches newline, lazy body of at least one
    character; an empty element therefore runs on to the next close tag.
    """
    pattern = rf"(?is)<{tag}>(.+?)</{tag}>"
    bodies = F.regexp_extract_all(c, F.lit(pattern), 1)
    return java_trim(F.array_join(F.transform(bodies, java_trim), " "))


def extract_labelled(c: Column, start: str, label: str, end: str) -> Column:
    """Text between ``start`` + optional blanks + ``label`` and ``end``.

    Every match is kept, concatenated with no separator, then trimmed;
    used for topic fields such as ``<num> Number: 051 <dom>``.
    """
    pattern = rf"(?is){start}\s*{label}(.+?){end}"
    return java_trim(F.array_join(F.regexp_extract_all(c, F.lit(pattern), 1), ""))


def split_lines(c: Column) -> Column:
    """Lines of a block, as a line reader returns them (no final empty line)."""
    body = F.regexp_replace(c, r"(?:\r\n|\r|\n)\z", "")
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_BREAK))


def is_blank(c: Column) -> Column:
    return F.length(java_trim(c)) == 0

