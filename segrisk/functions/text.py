"""Punctuation folding and line classification of brief texts.

Built from plain replacements and anchored patterns: a replacement that finds
nothing is one byte scan, and splitting at a single character needs no regular
expression, so whole texts pass at scan speed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from segrisk.functions.values import WHITESPACE, strip_right

# --- fixed values -----------------------------------------------------------

# Bullet, en dash, em dash, four quotes, ellipsis, hard space.
PUNCTUATION = {
    "•": "-",
    "–": "-",
    "—": "-",
    "‘": "'",
    "’": "'",
    "“": '"',
    "”": '"',
    "…": "...",
    "\u00a0": " ",
}

# Everything that ends a line besides "\n"; the pair comes first.
OTHER_LINE_ENDS = [
    "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029",
]
BULLETS = "-•*"

# ----------------------------------------------------------------------------

_BLANK = f"[{WHITESPACE}]"
_INK = f"[^{WHITESPACE}]"


def _replace_all(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def fold_punctuation(text: Column) -> Column:
    return _replace_all(text, PUNCTUATION.items())


def clean_markup(text: Column) -> Column:
    """Fold punctuation, reduce an isolated ``--`` to ``-`` and drop ``__``; bold stays."""
    single = F.regexp_replace(fold_punctuation(text), r"(?<!-)--(?!-)", "-")
    return F.replace(single, F.lit("__"), F.lit(""))


def single_line_ends(text: Column) -> Column:
    """Every line end written as a single line feed."""
    return _replace_all(text, [(end, "\n") for end in OTHER_LINE_ENDS])


def split_lines(text: Column) -> Column:
    """Lines of a text with single line ends; a final one does not open another line."""
    body = F.when(text.endswith("\n"), F.left(text, F.length(text) - 1)).otherwise(text)
    return F.when(text != "", F.split(body, "\n", -1))


def is_title(line: Column) -> Column:
    return line.rlike(f"^# {_BLANK}*{_INK}")


def line_kind(line: Column) -> Column:
    """A marker counts only with text behind it, as blanks at the end are ignored."""
    return (
        F.when(~line.rlike(f"^{_BLANK}*{_INK}"), "blank")
        .when(is_title(line), "title")
        .when(line.rlike(f"^## {_BLANK}*{_INK}"), "heading")
        .when(line.rlike(f"^{_BLANK}*[{BULLETS}] {_BLANK}*{_INK}"), "bullet")
        .otherwise("paragraph")
    )


def line_payload(line: Column, kind: Column) -> Column:
    """The line without its marker and without blanks at the end."""
    # One literal pattern per branch, so that each is compiled once.
    inner = (
        F.when(kind == "heading", F.regexp_replace(line, f"^## {_BLANK}*", ""))
        .when(kind == "bullet", F.regexp_replace(line, f"^{_BLANK}*[{BULLETS}] {_BLANK}*", ""))
        .otherwise(line)
    )
    return strip_right(inner)
