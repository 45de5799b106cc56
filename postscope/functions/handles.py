"""User handles (F1, F2).

``lower_handle`` is the shipped rule (lower-case only). ``normalize_handle``
adds Unicode NFKC before lower-casing. Spark has no built-in NFKC, so it is a
pandas UDF (Arrow batches); only values with a non-ASCII character are sent to
it (others go as NULL), because NFKC leaves ASCII unchanged.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lower_handle(c="username") -> Column:
    return F.lower(F.col(c) if isinstance(c, str) else c)


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    # pandas str.normalize uses unicodedata, which composes (n + U+0303 -> U+00F1).
    return s.str.normalize("NFKC")


def nfkc(c) -> Column:
    """NFKC of a string column. Spark evaluates a Python UDF on every row even
    inside ``CASE WHEN``, so ASCII values (already NFKC) are sent as NULL:
    the Arrow batches stay almost empty and the result falls back to the
    original value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(_nfkc(F.when(c.rlike("[^\\x00-\\x7F]"), c)), c)


def normalize_handle(c="username") -> Column:
    """NFKC, then lower-case; null stays null."""
    return F.lower(nfkc(c))


def is_present(c) -> Column:
    """Not null and not the empty string (truthiness of a handle)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != F.lit(""))
