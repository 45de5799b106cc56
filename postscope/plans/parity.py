"""Q5 for all three questions: where the ``time`` and ``memory`` strategies
count differently, and by which rule.

Each line is read both ways (fixed schema; strictly, for the question). Every
count it adds to an output key is marked with the strategy and, where the
strategies part, with the rule that makes them (the V numbers of the README).
Counts are summed per key in one pass, so the causes of a key add up to its
difference ``memory_n - time_n`` by construction; what no rule explains would
show in ``other``.

| Cause | The post ... |
| --- | --- |
| V1 | counts for its UTC day in one, for the day written in the other (q1) |
| V2 | has a written day but no valid time (q1) |
| V3 | has no author (q1) |
| V8 | has other tokens by the other emoji definition (q2) |
| V10 | mentions ``''`` (q3) |
| V11 | has a mention without a name and is skipped whole (q3) |
| V12 | stands in a line that is no single JSON object |
| V13 | lacks a field the strict reader needs, or has one of another type |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postscope.functions import emoji as E
from postscope.functions.days import post_day_prefix, post_day_utc
from postscope.functions.handles import lower_handle
from postscope.schema import POST
from postscope.sources.posts import JSON_OPTIONS, REASON_MALFORMED, REASON_NOT_OBJECT, parse_posts_strict, scan_lines

OTHER = "other"
#: Causes and key columns of each question.
CAUSES = {"q1": ("V1", "V2", "V3", "V12", "V13"), "q2": ("V8", "V12", "V13"), "q3": ("V10", "V11", "V12", "V13")}
KEYS = {"q1": ("date", "username"), "q2": ("emoji",), "q3": ("username",)}


def _marks(values: Column, cause, time: int, names) -> Column:
    """One struct (*names, cause, time, memory) per value of an array; a value
    is a struct of the key columns, or the key itself."""

    def mark(x: Column) -> Column:
        keys = [x.getField(n).alias(n) for n in names] if len(names) > 1 else [x.alias(names[0])]
        return F.struct(*keys, (cause(x) if callable(cause) else cause).alias("cause"), F.lit(time).alias("time"), F.lit(1 - time).alias("memory"))

    return F.transform(values, mark)


def _q1(ok: Column, refused: Column) -> Column:
    """One (day, author) at most on either side."""
    utc, written = F.col("_utc"), F.col("_written")
    author, strict_author = F.col("_lenient.user.username"), F.col("user.username")
    same = F.when(utc.eqNullSafe(written), F.lit(OTHER)).when(utc.isNull(), F.lit("V2")).otherwise(F.lit("V1"))
    dropped = F.when((refused == "V13") & author.isNull(), F.lit("V3")).otherwise(refused)

    def one(there: Column, day: Column, name: Column) -> Column:
        return F.filter(F.array(F.when(there & day.isNotNull(), F.struct(day.alias("date"), name.alias("username")))), lambda x: x.isNotNull())

    return F.concat(
        _marks(one(F.lit(True), utc, author), F.when(ok, same).otherwise(dropped), 1, KEYS["q1"]),
        _marks(one(ok, written, strict_author), same, 0, KEYS["q1"]))


def _q2(ok: Column, refused: Column) -> Column:
    def tokens(text: Column, definition: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(E.spark_pattern(definition)), 0)
        return F.coalesce(F.when(text.rlike(E.HAS_NON_ASCII), found), F.array().cast("array<string>"))

    return F.concat(
        _marks(tokens(F.col("_lenient.content"), "property"), F.when(ok, F.lit("V8")).otherwise(refused), 1, KEYS["q2"]),
        _marks(tokens(F.when(ok, F.col("content")), "range"), F.lit("V8"), 0, KEYS["q2"]))


def _q3(ok: Column, refused: Column) -> Column:
    def names(mentions: Column) -> Column:
        return F.coalesce(F.transform(mentions, lambda m: lower_handle(m.getField("username"))), F.array().cast("array<string>"))

    mentioned = F.col("_lenient.mentionedUsers")
    nameless = F.coalesce(F.exists(mentioned, lambda m: m.getField("username").isNull()), F.lit(False))
    dropped = F.when((refused == "V13") & nameless, F.lit("V11")).otherwise(refused)
    counted = F.filter(names(mentioned), lambda n: n.isNotNull() & (n != ""))
    return F.concat(
        _marks(counted, F.when(ok, F.lit(OTHER)).otherwise(dropped), 1, KEYS["q3"]),
        _marks(names(F.when(ok, F.col("mentionedUsers"))), lambda n: F.when(n == "", F.lit("V10")).otherwise(F.lit(OTHER)), 0, KEYS["q3"]))


_QUESTIONS = {"q1": _q1, "q2": _q2, "q3": _q3}


def causes_of_lines(lines: DataFrame, question: str, column: str = "value") -> DataFrame:
    """``*keys, time_n, memory_n``, one column per cause and ``other``: every key
    whose count differs, or would but for causes that cancel out."""
    if question not in _QUESTIONS:
        raise ValueError(f"unknown question {question!r}")
    both = lines.select(F.col(column).alias("value"), F.from_json(column, POST, JSON_OPTIONS).alias("_lenient"))
    read = parse_posts_strict(both, question=question)
    ok, reason = F.col("reject_reason").isNull(), F.col("reject_reason")
    refused = F.when(reason.isin(REASON_MALFORMED, REASON_NOT_OBJECT), F.lit("V12")).otherwise(F.lit("V13"))
    if question == "q1":  # each day is parsed once
        read = read.withColumns({"_utc": post_day_utc("_lenient.date"), "_written": F.when(ok, post_day_prefix("date"))})
    keys = list(KEYS[question])
    rows = read.select(F.inline(_QUESTIONS[question](ok, refused)))
    # few rows per key: hot keys are combined before the shuffle
    counts = rows.groupBy(*keys, "cause").agg(F.sum("time").alias("time"), F.sum("memory").alias("memory"))
    every = (*CAUSES[question], OTHER)
    moved = {c: F.sum(F.when(F.col("cause") == c, F.col("memory") - F.col("time")).otherwise(0)).alias(c) for c in every}
    out = counts.groupBy(*keys).agg(F.sum("time").alias("time_n"), F.sum("memory").alias("memory_n"), *moved.values())
    return out.where(F.exists(F.array(*every), lambda n: n != 0))


def causes(spark: SparkSession, path, question: str) -> DataFrame:
    """The same for NDJSON files."""
    return causes_of_lines(scan_lines(spark, path), question)
