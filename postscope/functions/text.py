"""Text and list predicates used by the profiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postscope.functions.days import parse_ts, utc_day

# Fixed values.
ELLIPSIS = "\u2026"
ZWJ = "\u200D"
# Java and RE2 both read this class; Python's \w on text (letters, digits, _).
MENTION_IN_TEXT = "@([\\p{L}\\p{N}_]+)"
# Whitespace removed by Python's str.strip(), as a class both Java and RE2 read.
WHITESPACE = (
    "[\\x{09}-\\x{0D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
ENDS_WITH_ELLIPSIS = "\\x{2026}" + WHITESPACE + "*\\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Trim every whitespace character at both ends (tabs and newlines too)."""
    return F.regexp_replace(_c(c), "^" + WHITESPACE + "+|" + WHITESPACE + "+\\z", "")


def ends_with_ellipsis(c="content") -> Column:
    """P10: the text, stripped of trailing whitespace, ends with an ellipsis.
    One anchored search; the text is not copied."""
    return F.coalesce(_c(c).rlike(ENDS_WITH_ELLIPSIS), F.lit(False))


def is_retweet_text(c="content") -> Column:
    return F.coalesce(F.startswith(_c(c), F.lit("RT @")), F.lit(False))


def outside_year(c="date", year: int = 2021) -> Column:
    """True when the year differs or the date does not parse."""
    return F.coalesce(F.year(utc_day(parse_ts(c))) != F.lit(year), F.lit(True))


def mentions_in_text(c="content") -> Column:
    """Distinct ``@name`` handles written in the text (case kept)."""
    return F.array_distinct(F.regexp_extract_all(_c(c), F.lit(MENTION_IN_TEXT), 1))


def meta_mention_set(c="mentionedUsers") -> Column:
    """Distinct non-empty names of the mention list (empty array for null)."""
    names = F.coalesce(_c(c).getField("username"), F.array().cast("array<string>"))
    return F.array_distinct(F.filter(names, lambda x: x.isNotNull() & (x != "")))


def any_null_in_list(c="mentionedUsers") -> Column:
    return F.exists(_c(c), lambda m: m.getField("username").isNull())


def is_complex_token(c) -> Column:
    """More than one codepoint, or contains a zero-width joiner."""
    c = _c(c)
    return (F.char_length(c) > 1) | F.contains(c, F.lit(ZWJ))
