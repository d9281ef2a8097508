"""Text clean-up, token estimates and reply fences."""

from __future__ import annotations

import ast
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes, in regex notation (fixed values).
# White space for a JavaScript ``trim`` and ``\s``.
JS_SPACE = r"\t\n\x0b\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
# Line ends besides ``\n`` that Python's ``splitlines`` knows.
LINE_ENDS = r"\r\x0b\f\x1c\x1d\x1e\u0085\u2028\u2029"
# Blanks that Python's ``strip`` removes inside a line.
LINE_BLANKS = r"\t\x1f \u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"


def _members(character_class: str) -> str:
    """The characters of a class, ranges written out."""
    plain = ast.literal_eval(f'"{character_class}"')
    return re.sub("(.)-(.)", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), plain)


_JS_SPACE_CHARS = _members(JS_SPACE)
_LINE_BLANK_CHARS = _members(LINE_BLANKS)


def js_trim(text: Column) -> Column:
    """Trims by character set, which looks at the ends of the text only."""
    return F.trim(text, F.lit(_JS_SPACE_CHARS))


def clean_text(raw: Column) -> Column:
    """Collapse blanks inside lines, trim every line, keep at most one blank line in a row.

    Plain replacements and per-line trims, with regular expressions only on a fixed leading character: several times
    faster than character classes tried at every position.
    """
    text = F.replace(raw, F.lit("\r\n"), F.lit("\n"))
    for line_end in _members(LINE_ENDS):
        text = F.replace(text, F.lit(line_end), F.lit("\n"))
    text = F.regexp_replace(F.replace(text, F.lit("\t"), F.lit(" ")), " {2,}", " ")
    lines = F.transform(F.split(text, "\n"), lambda line: F.trim(line, F.lit(_LINE_BLANK_CHARS)))
    return F.trim(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"), F.lit("\n"))


def truncate(text: Column, n: int | None) -> Column:
    """The first ``n`` characters; None keeps all."""
    return text if n is None else F.substring(text, 1, n)


def token_estimate(text: Column) -> Column:
    """About four characters per token."""
    return F.round(F.length(text) / 4).cast("bigint")


def token_estimate_collapsed(text: Column) -> Column:
    """The same after collapsing white space; fractional until the caller casts it."""
    return F.length(F.regexp_replace(text, r"\s+", " ")) / F.lit(4)


def strip_fences(reply: Column, ignore_case: bool = True) -> Column:
    """Remove Markdown code fences around a JSON reply."""
    if ignore_case:
        opened = F.regexp_replace(reply, "(?i)```json\n?", "")
    else:
        opened = F.replace(reply, F.lit("```json"), F.lit(""))
    return js_trim(F.replace(opened, F.lit("```"), F.lit("")))


def completion_text(response: Column) -> Column:
    """The reply inside a completion service's JSON response; null when the path is absent."""
    return F.get_json_object(response, "$.choices[0].messages")


def labelled_row(columns: list[str]) -> Column:
    """``name: value`` pairs joined by a bar; blank and missing values are left out."""
    cells = [
        F.when(js_trim(F.col(f"`{c}`").cast("string")) != "", F.concat(F.lit(f"{c}: "), F.col(f"`{c}`").cast("string")))
        for c in columns
    ]
    return F.concat_ws(" | ", *cells)


def labelled_header(columns: list[str]) -> Column:
    return F.lit("Columns: " + ", ".join(columns))
