"""Registered queries: Q1-Q5 and the steps they are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from postscope.functions.days import day_of
from postscope.operators import aggregate as G
from postscope.plans import questions as Q
from postscope.plans.catalog import (
    K, documents_posts, events_posts, lineitem_line_posts, lineitem_posts, orders_posts, register,
)
from postscope.sources import adapters as A

# ---------------------------------------------------------------------------
# SQL builders (DuckDB). ``posts`` is a CTE with columns id, date, "user".

USERNAME = "struct_extract(\"user\", 'username')"
USER_ID = "struct_extract(\"user\", 'id')"


def sql_prefix_day(c="date"):
    return f"try_strptime(substring({c}, 1, 10), '%Y-%m-%d')::DATE"


def sql_days(posts_sql: str, day_sql: str, author: str = USERNAME, strict: bool = False) -> str:
    """CTE text: pairs and day summaries (total, day_total_tweets, top_author)."""
    cond = " AND author IS NOT NULL" if strict else ""
    return f"""
posts AS ({posts_sql}),
d AS (SELECT {day_sql} AS date, {author} AS author FROM posts),
pairs AS (SELECT date, author, count(*) AS n FROM d WHERE date IS NOT NULL{cond} GROUP BY date, author),
days AS (
  SELECT date, CAST(sum(n) AS BIGINT) AS total,
         CAST(sum(n) FILTER (WHERE author IS NOT NULL) AS BIGINT) AS day_total_tweets,
         first(author ORDER BY n DESC, author ASC) FILTER (WHERE author IS NOT NULL) AS top_author
  FROM pairs GROUP BY date)"""


def sql_q1(posts_sql: str, day_sql: str, k: int = K, strict: bool = False) -> str:
    return f"""
WITH {sql_days(posts_sql, day_sql, strict=strict)},
top AS (SELECT * FROM days ORDER BY total DESC, date DESC LIMIT {k})
SELECT date, top_author AS top_user FROM top WHERE day_total_tweets IS NOT NULL"""


EV_DAY = A.sql_utc_day("date")

# ---------------------------------------------------------------------------
# Q1 and its steps on events-as-posts.


@register("top_days_top_user", sql_q1(A.EVENTS_POSTS_SQL, EV_DAY))
def q_top_days_top_user(spark, sf):
    """Q1, one-scan plan, default rules."""
    return Q.top_days_top_user(events_posts(spark, sf), K)


@register("top_days_top_user_two_scan", sql_q1(A.EVENTS_POSTS_SQL, EV_DAY))
def q_top_days_top_user_two_scan(spark, sf):
    """Q1, two-scan plan (broadcast semi-join of the k chosen days)."""
    return Q.top_days_top_user(events_posts(spark, sf), K, plan="two_scan")


@register("top_days_top_user_strict", sql_q1(A.EVENTS_POSTS_SQL, EV_DAY, strict=True))
def q_top_days_top_user_strict(spark, sf):
    """Q1 with the typed-reader rules (nameless posts rejected, V3)."""
    return Q.top_days_top_user(events_posts(spark, sf), K, strict=True)


@register("top_days_top_user_prefix", sql_q1(A.EVENTS_POSTS_SQL, sql_prefix_day()))
def q_top_days_top_user_prefix(spark, sf):
    """Q1 with the day read as the first ten characters."""
    return Q.top_days_top_user(events_posts(spark, sf), K, day_mode="prefix")


@register("top_days_top_user_orders", sql_q1(A.ORDERS_POSTS_SQL, A.sql_utc_day("date")))
def q_top_days_top_user_orders(spark, sf):
    """Q1 on orders by customer: thousands of days, many ties at rank k."""
    return Q.top_days_top_user(orders_posts(spark, sf), K)


@register("count_by_day", f"""
WITH posts AS ({A.EVENTS_POSTS_SQL})
SELECT {EV_DAY} AS date, count(*) AS n FROM posts WHERE {EV_DAY} IS NOT NULL GROUP BY 1""")
def q_count_by_day(spark, sf):
    """A1 + P1 + P5: posts per UTC day."""
    return Q.day_counts(events_posts(spark, sf))


@register("count_by_day_prefix", f"""
WITH posts AS ({A.EVENTS_POSTS_SQL})
SELECT {sql_prefix_day()} AS date, count(*) AS n FROM posts WHERE {sql_prefix_day()} IS NOT NULL GROUP BY 1""")
def q_count_by_day_prefix(spark, sf):
    """A1 + P2: posts per day written in the text."""
    return Q.day_counts(events_posts(spark, sf), "prefix")


@register("top_days", f"""
WITH posts AS ({A.EVENTS_POSTS_SQL}),
c AS (SELECT {EV_DAY} AS date, count(*) AS n FROM posts WHERE {EV_DAY} IS NOT NULL GROUP BY 1)
SELECT date, n FROM c ORDER BY n DESC, date DESC LIMIT {K}""")
def q_top_days(spark, sf):
    """K1 on A1: the k busiest days (ties: later day first, V5)."""
    return G.top_k(q_count_by_day(spark, sf), K, "n", ["date"], descending_keys=True)


@register("count_by_day_user", f"""
WITH {sql_days(A.EVENTS_POSTS_SQL, EV_DAY)},
top AS (SELECT date FROM days ORDER BY total DESC, date DESC LIMIT {K})
SELECT date, author AS username, n FROM pairs WHERE author IS NOT NULL AND date IN (SELECT date FROM top)""")
def q_count_by_day_user(spark, sf):
    """A2 + J1: posts per (day, author) on the k chosen days only."""
    from postscope.operators.joins import restrict_to_keys

    p = events_posts(spark, sf).select(
        day_of(F.col("date")).alias("date"), F.col("user.username").alias("username")
    )
    top = G.top_k(G.count_by(p, "date", drop_null="date"), K, "n", ["date"], descending_keys=True)
    # the semi join drops posts without a day (null never equals a key)
    return G.count_by(restrict_to_keys(p.where(F.col("username").isNotNull()), top, "date", bound=K), "date", "username")


@register("best_user_per_day", f"""
WITH {sql_days(A.EVENTS_POSTS_SQL, EV_DAY, strict=True)}
SELECT date, top_author AS top_user, day_total_tweets FROM days""")
def q_best_user_per_day(spark, sf):
    """A3 + A4 on every day: arg-max author (ties smallest) and named total."""
    pairs = Q.day_author_pairs(events_posts(spark, sf), strict=True)
    return G.best_per_group(pairs, "date", "author", best="top_user", total="day_total_tweets")


@register("top_n_users_per_day", f"""
WITH {sql_days(A.EVENTS_POSTS_SQL, EV_DAY, strict=True)}
SELECT date, author AS username, n, rank FROM (
  SELECT date, author, n, row_number() OVER (PARTITION BY date ORDER BY n DESC, author ASC) AS rank FROM pairs)
WHERE rank <= 3""")
def q_top_n_users_per_day(spark, sf):
    """The three most active authors of every day."""
    pairs = Q.day_author_pairs(events_posts(spark, sf), strict=True).withColumnRenamed("author", "username")
    return G.top_n_per_group(pairs, "date", [F.col("n").desc(), F.col("username").asc()], 3).select(
        "date", "username", "n", F.col("rank").cast("long").alias("rank")
    )


@register("top_days_top_user_by_id", f"""
WITH {sql_days(A.EVENTS_POSTS_SQL, EV_DAY, author=USER_ID)},
top AS (SELECT * FROM days ORDER BY total DESC, date DESC LIMIT {K}),
named AS (SELECT {USER_ID} AS user_id, {USERNAME} AS username, {A.sql_utc_ts("date")} AS ts, id FROM posts),
latest AS (SELECT user_id, first(username ORDER BY ts DESC NULLS LAST, id DESC) AS top_user
           FROM named WHERE user_id IS NOT NULL AND username IS NOT NULL GROUP BY user_id)
SELECT date, top_author AS top_user_id, top_user FROM top LEFT JOIN latest ON top_author = user_id
WHERE day_total_tweets IS NOT NULL""")
def q_top_days_top_user_by_id(spark, sf):
    """Q4 + J4: authors keyed by id, shown with their latest name."""
    return Q.top_days_top_user_by_id(events_posts(spark, sf), K)


# Posts with many authors missing, so that days rank differently by all and
# by named posts.
_PARITY_POSTS = f"""SELECT id, date, CASE WHEN id % 7 < 3 THEN NULL ELSE "user" END AS "user" FROM ({A.EVENTS_POSTS_SQL}) e"""
_LENIENT, _STRICT = sql_q1(_PARITY_POSTS, EV_DAY), sql_q1(_PARITY_POSTS, EV_DAY, strict=True)


@register("mode_parity", f"""
SELECT *, 'default_only' AS side FROM (({_LENIENT}) EXCEPT ALL ({_STRICT}))
UNION ALL
SELECT *, 'strict_only' AS side FROM (({_STRICT}) EXCEPT ALL ({_LENIENT}))""")
def q_mode_parity(spark, sf):
    """Q5: where the default and strict Q1 answers differ."""
    posts = events_posts(spark, sf)
    return Q.mode_parity(posts.withColumn("user", F.when(F.col("id") % 7 >= 3, F.col("user"))), K)


# ---------------------------------------------------------------------------
# Q2: emoji, one query per named definition.

from postscope.functions import emoji as EM  # noqa: E402

_POST_FILTER_SQL = {
    "run": f"WHERE NOT regexp_full_match(emoji, '{EM.ZWJ}+')",
}


def sql_emoji_counts(definition: str) -> str:
    return f"""
posts AS ({A.EVENTS_POSTS_SQL}),
t AS (SELECT unnest(regexp_extract_all(content, '{EM.pattern(definition)}', 0)) AS emoji FROM posts),
c AS (SELECT emoji, count(*) AS n FROM t {_POST_FILTER_SQL.get(definition, '')} GROUP BY emoji)"""


def _emoji_query(definition: str, top: bool):
    def q(spark, sf):
        posts = events_posts(spark, sf)
        return Q.top_emojis(posts, K, definition) if top else Q.emoji_counts(posts, definition)

    q.__doc__ = f"{'Q2 top-k' if top else 'A5 counts'} with the {definition} definition."
    return q


for _d in ("property", "range", "simple", "run", "grapheme"):
    _sql = f"WITH {sql_emoji_counts(_d)} SELECT emoji, n FROM c ORDER BY n DESC, emoji LIMIT {K}"
    register("top_emojis" if _d == "property" else f"top_emojis_{_d}", _sql)(_emoji_query(_d, True))

register("emoji_count", f"WITH {sql_emoji_counts('property')} SELECT emoji, n FROM c")(_emoji_query("property", False))
register("emoji_count_range", f"WITH {sql_emoji_counts('range')} SELECT emoji, n FROM c")(_emoji_query("range", False))
register("emoji_count_grapheme", f"WITH {sql_emoji_counts('grapheme')} SELECT emoji, n FROM c")(_emoji_query("grapheme", False))


# ---------------------------------------------------------------------------
# Q3: mentions, from lineitem-by-order posts.

_Q3_DEFAULT = f"""
WITH m AS ({A.LISTED_MENTIONS_SQL}),
c AS (SELECT lower(username) AS username, count(*) AS n FROM m
      WHERE username IS NOT NULL AND username <> '' GROUP BY 1)"""
_Q3_STRICT = f"""
WITH m AS ({A.LISTED_MENTIONS_SQL}),
bad AS (SELECT DISTINCT l_orderkey FROM m WHERE username IS NULL),
c AS (SELECT lower(username) AS username, count(*) AS n FROM m
      WHERE l_orderkey NOT IN (SELECT l_orderkey FROM bad) GROUP BY 1)"""


@register("top_mentioned", f"{_Q3_DEFAULT} SELECT username, n FROM c ORDER BY n DESC, username LIMIT {K}")
def q_top_mentioned(spark, sf):
    """Q3, default rules: null and empty names dropped one by one (element by
    element, so one post per line item gives the same answer)."""
    return Q.top_mentioned(lineitem_line_posts(spark, sf), K)


@register("top_mentioned_strict", f"{_Q3_STRICT} SELECT username, n FROM c ORDER BY n DESC, username LIMIT {K}")
def q_top_mentioned_strict(spark, sf):
    """Q3, typed-reader rules: a list with a null name skips the post, '' counts."""
    return Q.top_mentioned(lineitem_posts(spark, sf), K, strict=True)


@register("mention_count", f"{_Q3_DEFAULT} SELECT username, n FROM c")
def q_mention_count(spark, sf):
    """A6 + E7 + F1 + P6: times mentioned per lower-cased name."""
    return Q.mention_counts(lineitem_line_posts(spark, sf))


@register("explode_list", f"SELECT l_orderkey AS id, username FROM ({A.LISTED_MENTIONS_SQL})")
def q_explode_list(spark, sf):
    """E6 + P4 + P7: one row per list element (names as written)."""
    from postscope.operators.extract import explode_list

    p = lineitem_line_posts(spark, sf).select("id", F.col("mentionedUsers.username").alias("names"))
    return explode_list(p, "names", "username", "id")


@register("mentions_from_text", f"""
WITH d AS ({A.DOCUMENTS_POSTS_SQL})
SELECT id, unnest(list_distinct(regexp_extract_all(content, '{A.MENTION_IN_TEXT}', 1))) AS username FROM d""")
def q_mentions_from_text(spark, sf):
    """E8 + F9: distinct @names written in each document."""
    from postscope.operators.extract import mentions_from_text

    return mentions_from_text(documents_posts(spark, sf), "content", "username", "id")


# ---------------------------------------------------------------------------
# Tie handling at the day cut-off, the dictionary-lookup form of Q1, and the
# serialised answer.

_ORDER_DAYS = f"""
posts AS ({A.ORDERS_POSTS_SQL}),
c AS (SELECT {A.sql_utc_day()} AS date, count(*) AS n FROM posts WHERE {A.sql_utc_day()} IS NOT NULL GROUP BY 1)"""


@register("day_cutoff_ties_orders", f"""
WITH {_ORDER_DAYS},
top AS (SELECT * FROM c ORDER BY n DESC, date DESC LIMIT {K}),
cut AS (SELECT CASE WHEN count(*) >= {K} THEN min(n) END AS v FROM top)
SELECT {K} AS k, (SELECT v FROM cut) AS cutoff_value,
       (SELECT count(*) FROM c WHERE n = (SELECT v FROM cut)) AS keys_at_cutoff,
       (SELECT count(*) FROM top WHERE n = (SELECT v FROM cut)) AS keys_at_cutoff_in_top,
       (SELECT count(*) FROM c WHERE n = (SELECT v FROM cut)) > (SELECT count(*) FROM top WHERE n = (SELECT v FROM cut)) AS split_tie""")
def q_day_cutoff_ties_orders(spark, sf):
    """W2 + K5 on order days: how many days tie with the 10th (V5)."""
    p = orders_posts(spark, sf).select(day_of(F.col("date")).alias("key"))
    days = G.count_by(p, "key", drop_null="key")
    out = G.ties_at_cutoff(days, K, "n", "key")
    return out


@register("top_days_best_user_lookup", f"""
WITH {sql_days(A.EVENTS_POSTS_SQL, EV_DAY)},
top AS (SELECT date, total AS n FROM days ORDER BY total DESC, date DESC LIMIT {K}),
best AS (SELECT date, first(author ORDER BY n DESC, author) AS top_user FROM pairs WHERE author IS NOT NULL GROUP BY date)
SELECT top.date, n, top_user FROM top JOIN best ON top.date = best.date""")
def q_top_days_best_user_lookup(spark, sf):
    """The chosen days looked up in the best-author table (inner join:
    a day without a named author drops out)."""
    from postscope.operators.joins import lookup

    # Both sides start from the same (day, author) counts: one scan.
    pairs = Q.day_author_pairs(events_posts(spark, sf))
    totals = pairs.groupBy("date").agg(F.sum("n").alias("n"))
    top = G.top_k(totals, K, "n", ["date"], descending_keys=True)
    best = G.best_per_group(pairs.where(F.col("author").isNotNull()), "date", "author", best="top_user").select("date", "top_user")
    return lookup(top, best, "date")


@register("top_days_top_user_serialized", f"""
WITH q AS ({sql_q1(A.EVENTS_POSTS_SQL, EV_DAY)})
SELECT '["' || strftime(date, '%Y-%m-%d') || '","' || top_user || '"]' AS json FROM q""")
def q_top_days_top_user_serialized(spark, sf):
    """S9 + F7: the Q1 answer as JSON arrays with ISO dates."""
    from postscope.sources.posts import result_to_json

    return result_to_json(Q.top_days_top_user(events_posts(spark, sf), K))


@register("top_emojis_serialized", f"""
WITH {sql_emoji_counts('property')}
SELECT '["' || emoji || '",' || CAST(n AS VARCHAR) || ']' AS json FROM (SELECT emoji, n FROM c ORDER BY n DESC, emoji LIMIT {K})""")
def q_top_emojis_serialized(spark, sf):
    """The Q2 answer as JSON arrays; counts stay numbers."""
    from postscope.sources.posts import result_to_json

    return result_to_json(Q.top_emojis(events_posts(spark, sf), K))


@register("top_mentioned_approx", f"{_Q3_DEFAULT} SELECT username, n FROM c ORDER BY n DESC, username LIMIT {K}")
def q_top_mentioned_approx(spark, sf):
    """A17 on Q3: the most mentioned names in bounded memory."""
    return Q.top_mentioned_approx(lineitem_line_posts(spark, sf), K)


@register("top_emojis_approx", f"WITH {sql_emoji_counts('property')} SELECT emoji, n FROM c ORDER BY n DESC, emoji LIMIT {K}")
def q_top_emojis_approx(spark, sf):
    """A17 on Q2: the most used emoji in bounded memory."""
    return Q.top_emojis_approx(events_posts(spark, sf), K)
