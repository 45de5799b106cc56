"""Day of a post.

``date`` holds ISO-8601 text with an offset, e.g. ``2021-02-12T23:59:59-05:00``.

* ``post_day_utc``: parse, convert to UTC, take the calendar day. Text that
  does not parse gives null (``try_cast``; ANSI mode would raise).
* ``post_day_prefix``: the first ten characters read as a date (the local day
  written in the text). Equal to the UTC day iff the offset is zero.

The UTC day is computed from epoch seconds, so it does not depend on
``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp layouts (offset as Z or +HH:MM, or +HHMM).
_SECONDS = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
ISO_OFFSET = _SECONDS + r"(?:Z|[+-]\d{2}:\d{2})\z"
ISO_PLAIN_OFFSET = _SECONDS + r"[+-]\d{4}\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c="date") -> Column:
    """ISO text with offset -> TIMESTAMP (an instant); null when unparsable.
    The layout is checked first, so that Spark's fast cast can be used, which
    alone would also take dates, fractions and other zone names."""
    c = _col(c)
    colon = F.concat(F.substring(c, 1, 22), F.lit(":"), F.substring(c, 23, 2))
    return F.when(c.rlike(ISO_OFFSET), c.try_cast("timestamp")).when(c.rlike(ISO_PLAIN_OFFSET), colon.try_cast("timestamp"))


def utc_day(ts: Column) -> Column:
    """Calendar day in UTC of an instant, independent of the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int"))


def post_day_utc(c="date") -> Column:
    return utc_day(parse_ts(c))


def post_day_prefix(c="date") -> Column:
    c = _col(c)
    return F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")


def day_of(c="date", mode: str = "utc") -> Column:
    if mode == "utc":
        return post_day_utc(c)
    if mode == "prefix":
        return post_day_prefix(c)
    raise ValueError(f"unknown day_mode {mode!r}; use 'utc' or 'prefix'")


def year_of(c="date") -> Column:
    """Year of the UTC day (independent of the session zone)."""
    return F.year(utc_day(parse_ts(c)))
