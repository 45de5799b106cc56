"""Table-generating extractors.

Each extractor projects the one column it needs before ``explode`` so the
generator never carries the rest of the row, and every pattern runs
JVM-side inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postscope.functions import emoji as E
from postscope.functions.handles import lower_handle, normalize_handle
from postscope.functions.text import MENTION_IN_TEXT


def explode_list(df: DataFrame, column: str, out: str, *keep: str) -> DataFrame:
    """One row per element; null and empty lists give no row."""
    return df.select(*keep, F.explode(F.col(column)).alias(out))


def emoji_tokens(df: DataFrame, definition: str = "property", content: str = "content",
                 out: str = "emoji", *keep: str) -> DataFrame:
    """Every emoji token of ``content`` under a named definition."""
    text = F.col(content)
    found = F.regexp_extract_all(text, F.lit(E.spark_pattern(definition)), 0)
    # Pure-ASCII texts (most posts in practice) skip the extraction.
    found = F.when(text.rlike(E.HAS_NON_ASCII), found)
    toks = df.select(*keep, F.explode(found).alias(out))
    if definition == "run":
        toks = toks.where(~F.col(out).rlike(E.ONLY_ZWJ))
    return toks


def mentions_from_metadata(df: DataFrame, strict: bool = False, normalize: bool = False,
                           out: str = "username", *keep: str) -> DataFrame:
    """Lower-cased names of ``mentionedUsers``.

    Default: null and ``''`` names are dropped one by one. ``strict=True``
    (parity with the typed row reader): a post whose list holds a null name is
    skipped whole, and ``''`` is counted.
    """
    src = df
    if strict:
        src = df.where(
            F.coalesce(~F.exists("mentionedUsers", lambda m: m.getField("username").isNull()), F.lit(True))
        )
    names = src.select(*keep, F.explode(F.col("mentionedUsers").getField("username")).alias("_name"))
    if not strict:
        # Folding keeps null and '' as they are, so test the raw name and
        # fold only the names that stay (one fold per name).
        names = names.where(F.col("_name").isNotNull() & (F.col("_name") != F.lit("")))
    fold = normalize_handle if normalize else lower_handle
    return names.select(*keep, fold(F.col("_name")).alias(out))


def mentions_from_text(df: DataFrame, content: str = "content", out: str = "username", *keep: str) -> DataFrame:
    """The distinct ``@name`` handles written in each text (case kept)."""
    return df.select(
        *keep,
        F.explode(F.array_distinct(F.regexp_extract_all(F.col(content), F.lit(MENTION_IN_TEXT), 1))).alias(out),
    )
