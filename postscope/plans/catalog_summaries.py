"""Registered queries over stored, mergeable summaries: the rollup that a
stream keeps up to date (A18), and daily sketches of distinct authors (A16),
heavy hitters and point counts (A17) and quantiles (A12).

Each query writes its table from whole driver tables first, into a folder of
its own call below the shared folder, and answers from the table alone; exact
figures next to the estimates come from the posts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from postscope.plans import summaries as S
from postscope.plans.catalog import K, events_posts, register
from postscope.plans.catalog_files import stage_lines, staging
from postscope.plans.catalog_questions import USERNAME, sql_q1
from postscope.sources import adapters as A

# The ranges of days asked for (the events lie in January 2024), their
# quantiles, and the parts in which files arrive.
RANGES = {
    "all": (dt.date(1970, 1, 1), dt.date(9999, 12, 31)),
    "first_week": (dt.date(2024, 1, 1), dt.date(2024, 1, 7)),
    "days_10_to_20": (dt.date(2024, 1, 10), dt.date(2024, 1, 20)),
    "one_day": (dt.date(2024, 1, 15), dt.date(2024, 1, 15)),
    "before": (dt.date(1970, 1, 1), dt.date(1970, 12, 31)),
}
QUANTILES = (0.5, 0.9, 0.99)
FILES_PER_BATCH = 5

_RANGES_SQL = "r AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{name}', DATE '{a}', DATE '{b}')" for name, (a, b) in RANGES.items()) + ") t(range, first, last))"
_POSTS_SQL = f"""{_RANGES_SQL},
p AS (SELECT {A.sql_utc_day()} AS date, {USERNAME} AS username, CAST(length(content) AS BIGINT) AS length FROM ({A.EVENTS_POSTS_SQL}) e),
x AS (SELECT r.range, p.* FROM r JOIN p ON p.date BETWEEN r.first AND r.last)"""


def in_ranges(days):
    """The rows of each range, with its name: at most one copy per range."""
    rows = F.array(*[F.struct(F.lit(n).alias("range"), F.lit(a).alias("first"), F.lit(b).alias("last")) for n, (a, b) in RANGES.items()])
    out = days.select("*", F.inline(rows)).where(F.col("date").between(F.col("first"), F.col("last")))
    return out.drop("first", "last")


def _stored(spark, sf, name: str, build):
    path = f"{staging(spark, name)}/days"
    S.write_by_day(build(events_posts(spark, sf)), path)
    return S.read_days(spark, path)


def _dated(spark, sf):
    from postscope.functions.days import post_day_utc

    return events_posts(spark, sf).select(
        post_day_utc("date").alias("date"), F.col("user.username").alias("username"), F.length("content").cast("long").alias("length"))


@register("distinct_users_in_range", f"""
WITH {_POSTS_SQL}
SELECT r.range, count(DISTINCT x.username) AS exact_users, true AS within FROM r LEFT JOIN x USING (range)
GROUP BY r.range HAVING count(x.date) > 0""")
def q_distinct_users_in_range(spark, sf):
    """Distinct authors of any range from one stored HLL sketch per day,
    within five standard errors of the exact count."""
    found = in_ranges(_stored(spark, sf, "sketches-users", S.daily_summaries)).groupBy("range").agg(S.distinct_users().alias("estimate"))
    exact = in_ranges(_dated(spark, sf)).groupBy("range").agg(F.count_distinct("username").alias("exact_users"))
    error = 5 * S.Settings().distinct_error
    return exact.join(found, "range").select("range", "exact_users", (F.abs(F.col("estimate") - F.col("exact_users")) <= error * F.col("exact_users")).alias("within"))


_ITEMS = S.Settings().max_items
_COUNTERS = 262144  # the counters that max_items asks for: the power of two at or above max_items / 0.75


@register("top_users_in_range", f"""
WITH {_POSTS_SQL},
c AS (SELECT range, username, count(*) AS n FROM x WHERE username IS NOT NULL GROUP BY ALL),
t AS (SELECT range, CAST(ceil(sum(n) * 3.5 / {_COUNTERS}) AS BIGINT) AS max_error FROM c GROUP BY range),
k AS (SELECT *, row_number() OVER (PARTITION BY range ORDER BY n DESC, username) AS i FROM c)
SELECT range, username, n, max_error FROM k JOIN t USING (range) WHERE i <= {K}""")
def q_top_users_in_range(spark, sf):
    """The ten most active authors of any range from one stored
    heavy-hitter state per day, with the bound on the error (exact while the
    distinct names fit)."""
    return S.top_authors(in_ranges(_stored(spark, sf, "sketches-top", S.daily_summaries)), K, ["range"]).select("range", "username", "n", "max_error")


@register("author_point_counts", f"""
WITH {_POSTS_SQL}, c AS (SELECT username, count(*) AS n FROM p WHERE date IS NOT NULL AND username IS NOT NULL GROUP BY 1)
SELECT count(*) AS n_names, CAST(sum(n) AS BIGINT) AS n_posts, true AS never_below, true AS rarely_beyond FROM c""")
def q_author_point_counts(spark, sf):
    """The count of every author looked up in the stored Count-Min rows of
    all days: never below the exact count, and beyond it by over eps of all
    posts for a share of delta of the names at most."""
    from postscope.operators.aggregate import count_by
    from postscope.operators.approx import count_min_lookup

    set_ = S.Settings()
    table = _stored(spark, sf, "sketches-counts", S.daily_count_min)
    exact = count_by(_dated(spark, sf).where(F.col("date").isNotNull() & F.col("username").isNotNull()), "username")
    found = count_min_lookup(exact, "username", table, set_.eps, set_.delta)
    total = exact.agg(F.sum("n")).scalar()
    beyond = F.count_if(F.col("estimate") > F.col("n") + F.lit(set_.eps) * total)
    return found.agg(F.count("*").alias("n_names"), F.sum("n").alias("n_posts"), (F.count_if(F.col("estimate") < F.col("n")) == 0).alias("never_below"),
                     (beyond <= set_.delta * F.count("*")).alias("rarely_beyond"))


@register("length_quantiles_in_range", f"""
WITH {_POSTS_SQL}, y AS (SELECT range, length FROM x WHERE length IS NOT NULL),
q AS (SELECT unnest([{", ".join(map(str, QUANTILES))}]) AS q)
SELECT range, CAST(q AS DOUBLE) AS q, count(*) AS n, round(CASE q {" ".join(f"WHEN {q} THEN quantile_cont(length, {q})" for q in QUANTILES)} END, 6) AS exact, true AS within
FROM y, q GROUP BY range, q""")
def q_length_quantiles_in_range(spark, sf):
    """Quantiles of the texts' lengths, exact (interpolated) from the posts
    and from one stored KLL sketch per day; the sketch's value has a rank within
    five times 1.33 % / 2.58 (its standard error) of the quantile asked for."""
    from postscope.operators.aggregate import quantile

    posts = in_ranges(_dated(spark, sf).where(F.col("length").isNotNull()))
    names = [f"_{i}" for i in range(len(QUANTILES))]
    found = in_ranges(_stored(spark, sf, "sketches-lengths", S.daily_summaries)).groupBy("range").agg(S.length_quantiles(QUANTILES).alias("est"))
    exact = posts.groupBy("range").agg(F.count("*").alias("n"), *(quantile(posts, q, "length").alias(c) for q, c in zip(QUANTILES, names)))
    asked = exact.join(found, "range").select("range", "n", F.inline(F.array(*[
        F.struct(F.lit(q).alias("q"), F.round(c, 6).alias("exact"), F.col("est")[i].alias("est")) for i, (q, c) in enumerate(zip(QUANTILES, names))])))
    # the values below the estimate and up to it, from the counts per length (a length is a small number)
    lengths = posts.groupBy("range", "length").agg(F.count("*").alias("m"))
    ranks = asked.join(lengths, "range").groupBy("range", "n", "q", "exact", "est").agg(
        F.sum(F.when(F.col("length") < F.col("est"), F.col("m")).otherwise(0)).alias("below"), F.sum(F.when(F.col("length") <= F.col("est"), F.col("m")).otherwise(0)).alias("upto"))
    error = 5 * 0.0133 / 2.58
    within = (F.col("below") <= (F.col("q") + error) * F.col("n")) & (F.col("upto") >= (F.col("q") - error) * F.col("n"))
    return ranks.select("range", "q", "n", "exact", within.alias("within"))


# --- A18: the rollup that a stream keeps up to date -------------------------


def _streamed(spark, sf, name: str) -> str:
    """The staged files counted in several micro-batches; the table's path."""
    from postscope.streaming.rollup import start_rollup

    base = stage_lines(spark, sf, name, A.STAGED_PARTS)
    start_rollup(spark, f"{base}/input", f"{base}/rollup", FILES_PER_BATCH).awaitTermination()  # available now: ends by itself
    return f"{base}/rollup"


@register("rollup_stream_top_days", sql_q1(A.EVENTS_LENIENT_SQL, A.sql_utc_day()))
def q_rollup_stream_top_days(spark, sf):
    """A18 + Q1: the answer from the streamed rollup equals that from the posts."""
    from postscope.streaming.rollup import top_days_top_user

    return top_days_top_user(spark, _streamed(spark, sf, "rollup_stream_q1"), K)


@register("rollup_stream_hours", f"""
WITH t AS (SELECT {A.sql_utc_ts()} AS ts FROM ({A.EVENTS_LENIENT_SQL}) l)
SELECT CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM t WHERE ts IS NOT NULL GROUP BY ALL""")
def q_rollup_stream_hours(spark, sf):
    """Posts per (day, hour) merged over all micro-batches."""
    from postscope.streaming.rollup import read_counts

    return read_counts(spark, _streamed(spark, sf, "rollup_stream_hours")).groupBy("date", "hour").agg(F.sum("n").alias("n"))
