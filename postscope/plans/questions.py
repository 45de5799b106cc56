"""The questions users call (Q1-Q5), as DataFrame plans over posts.

Q1 ``top_days_top_user``: the k days with most posts (ties: later day first)
and on each the author with most posts that day (ties: smallest name),
ordered by the day's total over named authors, then day, descending.

* default (``strict=False``): a post with a valid day but no author counts
  towards choosing the days, not towards the output order; a chosen day
  whose posts are all nameless has no output row.
* ``strict=True``: a post without an author or a day is rejected, as by the
  typed row reader.

Two plan shapes give the same rows:

* ``plan="one_scan"`` (default): one aggregate per (day, author) including
  nameless posts, then per day the total, the named total and the arg-max
  in one more aggregate, then a top-k. One pass over the input, no join.
* ``plan="two_scan"``: count per day, pick the top k, then a broadcast
  semi-join (k rows, bound known) restricts the second pass to those days
  before counting (day, author) pairs. Cheaper when the input is columnar
  and has many days.

Both aggregates combine map-side, so an author or a day holding a third of
all posts reaches the shuffle as one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postscope.functions.days import day_of, parse_ts
from postscope.operators.aggregate import best_per_group, count_by, top_k
from postscope.operators.extract import emoji_tokens, mentions_from_metadata
from postscope.operators.joins import restrict_to_keys


def _day_author(posts: DataFrame, day_mode: str, strict: bool, author: str, by=()) -> DataFrame:
    """(day, author) per post. Rows with no day are kept here and dropped
    by the first aggregate (``count_by(drop_null=...)``), so each date is
    parsed once."""
    p = posts.select(
        *by,
        day_of(F.col("date"), day_mode).alias("date"),
        F.col(author).alias("author"),
    )
    if strict:
        p = p.where(F.col("author").isNotNull())
    return p


def _pairs(posts: DataFrame, day_mode: str, strict: bool, author: str, by=()) -> DataFrame:
    """Posts per (day, author), days that parse only."""
    p = _day_author(posts, day_mode, strict, author, by)
    return count_by(p, *by, "date", "author", drop_null="date")


def day_author_pairs(posts: DataFrame, day_mode: str = "utc", strict: bool = False,
                     author: str = "user.username") -> DataFrame:
    """A2: posts per (day, author) with columns ``date, author, n``."""
    return _pairs(posts, day_mode, strict, author)


def day_counts(posts: DataFrame, day_mode: str = "utc") -> DataFrame:
    """A1: posts per day (``date, n``); the day is parsed once per post."""
    p = posts.select(day_of(F.col("date"), day_mode).alias("date"))
    return count_by(p, "date", drop_null="date")


def _top_days_per_group(days: DataFrame, k: int, by) -> DataFrame:
    if not by:
        return top_k(days, k, "total", ["date"], descending_keys=True)
    w = Window.partitionBy(*by).orderBy(F.col("total").desc(), F.col("date").desc())
    return days.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def day_summaries(posts: DataFrame, day_mode: str = "utc", strict: bool = False,
                  author: str = "user.username", by=()) -> DataFrame:
    """Per day: ``total`` (all posts with a valid day), ``day_total_tweets``
    (posts with an author) and ``top_author`` (arg-max, ties smallest)."""
    return summaries_of_pairs(_pairs(posts, day_mode, strict, author, by), by)


def summaries_of_pairs(pairs: DataFrame, by=()) -> DataFrame:
    """``day_summaries`` from counts per (day, author), e.g. a stored rollup:
    ``date, author, n``."""
    by = list(by)
    named = F.col("author").isNotNull()
    key = F.when(named, F.struct((-F.col("n")).alias("neg"), F.col("author").alias("a")))
    return pairs.groupBy(*by, "date").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(named, F.col("n"))).alias("day_total_tweets"),
        F.min_by(F.col("author"), key).alias("top_author"),
    )


def top_days_top_user(posts: DataFrame, k: int = 10, day_mode: str = "utc", strict: bool = False,
                      plan: str = "one_scan", by=(), with_counts: bool = False, ordered: bool = True) -> DataFrame:
    """Q1. Columns ``date, top_user`` (plus ``day_total_tweets`` with
    ``with_counts``); ``by`` answers the question separately per group
    (e.g. per input file). ``ordered=False`` leaves out the last sort."""
    by = list(by)
    if plan == "one_scan":
        return answer_from_summaries(day_summaries(posts, day_mode, strict, by=by), k, by, with_counts, ordered)
    if plan != "two_scan":
        raise ValueError(f"unknown plan {plan!r}; use 'one_scan' or 'two_scan'")
    if by:
        raise ValueError("two_scan is for a single answer; use one_scan with by=")
    p = _day_author(posts, day_mode, strict, "user.username")
    days = count_by(p, "date", drop_null="date")
    top = top_k(days, k, "n", ["date"], descending_keys=True)
    chosen = restrict_to_keys(p.where(F.col("author").isNotNull()), top, "date", bound=k)
    pairs = count_by(chosen, "date", "author")
    out = best_per_group(pairs, "date", "author", best="top_user", total="day_total_tweets")
    out = out.orderBy(F.col("day_total_tweets").desc(), F.col("date").desc())
    return out if with_counts else out.drop("day_total_tweets")


def answer_from_summaries(days: DataFrame, k: int = 10, by=(), with_counts: bool = False, ordered: bool = True) -> DataFrame:
    """Q1's last steps on ``day_summaries``: the top k days by total (later
    day first on ties), days with a named author only, ordered by the named
    total then day."""
    by = list(by)
    top = _top_days_per_group(days, k, by)
    out = top.where(F.col("day_total_tweets").isNotNull()).select(
        *by, "date", F.col("top_author").alias("top_user"), "day_total_tweets"
    )
    if ordered:
        out = out.orderBy(*by, F.col("day_total_tweets").desc(), F.col("date").desc())
    return out if with_counts else out.drop("day_total_tweets")


def top_days_top_user_by_id(posts: DataFrame, k: int = 10, day_mode: str = "utc") -> DataFrame:
    """Q4: Q1 keyed by the immutable ``user.id``; the name shown is the
    author's latest (J4), so a renamed author is counted once.

    One pass: each (day, id) group also keeps the latest name seen in it. The
    k days and the names of the chosen ids then come from those group rows
    (a broadcast semi-join of at most k ids), not from the posts again.
    """
    ts = parse_ts(F.col("date"))
    rows = posts.select(day_of(F.col("date"), day_mode).alias("date"), F.col("user.id").alias("author"),
                        F.col("user.username").alias("username"), F.struct(ts.alias("ts"), F.col("id").alias("id")).alias("at"))
    named = F.when(F.col("username").isNotNull(), F.col("at"))
    groups = rows.groupBy("date", "author").agg(
        F.count(F.lit(1)).alias("n"), F.max(named).alias("at"), F.max_by("username", named).alias("username"))
    key = F.when(F.col("author").isNotNull(), F.struct((-F.col("n")).alias("neg"), F.col("author").alias("a")))
    days = groups.where(F.col("date").isNotNull()).groupBy("date").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("author").isNotNull(), F.col("n"))).alias("day_total_tweets"),
        F.min_by("author", key).alias("top_author"))
    top = top_k(days, k, "total", ["date"], descending_keys=True).where(F.col("day_total_tweets").isNotNull())
    chosen = restrict_to_keys(groups.withColumnRenamed("author", "user_id"), top.select(F.col("top_author").alias("user_id")), "user_id", bound=k)
    latest = chosen.where(F.col("at").isNotNull()).groupBy("user_id").agg(F.max_by("username", "at").alias("top_user"))
    return (
        top.join(latest, top["top_author"] == latest["user_id"], "left")
        .select("date", F.col("top_author").alias("top_user_id"), "top_user")
        .orderBy(F.col("date").desc())
    )


def top_emojis(posts: DataFrame, k: int = 10, definition: str = "property") -> DataFrame:
    """Q2: the k most used emoji tokens (``emoji, n``), ties by token."""
    return top_k(count_by(emoji_tokens(posts, definition), "emoji"), k, "n", ["emoji"])


def emoji_counts(posts: DataFrame, definition: str = "property") -> DataFrame:
    """A5: occurrences per emoji token."""
    return count_by(emoji_tokens(posts, definition), "emoji")


def mention_counts(posts: DataFrame, strict: bool = False) -> DataFrame:
    """Times mentioned per lower-cased name."""
    return count_by(mentions_from_metadata(posts, strict=strict), "username")


def top_mentioned(posts: DataFrame, k: int = 10, strict: bool = False) -> DataFrame:
    """Q3: the k most mentioned names (``username, n``), ties by name."""
    return top_k(mention_counts(posts, strict), k, "n", ["username"])


def mode_parity(posts: DataFrame, k: int = 10) -> DataFrame:
    """Q5: rows where the default and strict Q1 answers differ, with the
    side they appear on. Both come from one set of day summaries: the strict
    answer ranks days by their named posts."""
    days = day_summaries(posts)
    lenient = answer_from_summaries(days, k, ordered=False).withColumn("side", F.lit("default_only"))
    strict = answer_from_summaries(days.withColumn("total", F.col("day_total_tweets")).where(F.col("total").isNotNull()), k, ordered=False)
    both = lenient.unionByName(strict.withColumn("side", F.lit("strict_only")))  # 2 k rows at most
    return both.groupBy("date", "top_user").agg(F.count(F.lit(1)).alias("n"), F.min("side").alias("side")).where(F.col("n") == 1).drop("n")


def top_mentioned_approx(posts: DataFrame, k: int = 10, max_items: int = 10000) -> DataFrame:
    """Q3 in bounded memory (``approx_top_k``): exact while the distinct names
    fit in ``max_items``, approximate counts beyond that."""
    from postscope.operators.approx import approx_top_k

    return approx_top_k(mentions_from_metadata(posts), "username", k, max_items)


def top_emojis_approx(posts: DataFrame, k: int = 10, definition: str = "property",
                      max_items: int = 10000) -> DataFrame:
    """Q2 in bounded memory (``approx_top_k``)."""
    from postscope.operators.approx import approx_top_k

    return approx_top_k(emoji_tokens(posts, definition), "emoji", k, max_items)
