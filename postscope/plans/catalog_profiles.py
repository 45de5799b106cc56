"""Registered queries: data-quality profiles, strict parsing, records,
samples and sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from postscope.functions.text import ENDS_WITH_ELLIPSIS, MENTION_IN_TEXT
from postscope.operators import aggregate as G
from postscope.operators import approx as X
from postscope.plans import profiles as P
from postscope.plans import questions as Q
from postscope.plans.catalog import (
    K, documents_posts, documents_records, event_lines, events_posts, lineitem_posts, load, register,
)
from postscope.plans.catalog_questions import USERNAME, USER_ID, sql_q1
from postscope.sources import adapters as A
from postscope.sources import posts as S


EVENTS_YEAR = 2024
# SQL: NFKC + lower for the names the adapter writes (ASCII or full-width
# capitals); DuckDB has no NFKC function.
_WIDE = "".join(chr(c) for c in range(0xFF21, 0xFF3B))
SQL_NORM_NAME = f"lower(translate({USERNAME}, {A.sql_str(_WIDE)}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'))"
_PER_USER_SQL = f"""
posts AS ({A.EVENTS_POSTS_SQL}),
c AS (SELECT {SQL_NORM_NAME} AS username, count(*) AS n FROM posts
      WHERE {USERNAME} IS NOT NULL AND {USERNAME} <> '' GROUP BY 1)"""


@register("posts_per_user", f"WITH {_PER_USER_SQL} SELECT username, n FROM c")
def q_posts_per_user(spark, sf):
    """A7 + F2: posts per NFKC+lower-cased author."""
    return P.posts_per_user(events_posts(spark, sf))


@register("count_of_counts", f"WITH {_PER_USER_SQL} SELECT n, count(*) AS keys FROM c GROUP BY n")
def q_count_of_counts(spark, sf):
    """How many authors share each post count."""
    return G.count_of_counts(P.posts_per_user(events_posts(spark, sf)))


@register("handle_collisions", f"""
WITH posts AS ({A.EVENTS_POSTS_SQL}),
u AS (SELECT {USERNAME} AS raw, {SQL_NORM_NAME} AS norm FROM posts WHERE {USERNAME} IS NOT NULL AND {USERNAME} <> '')
SELECT count(DISTINCT raw) AS n_raw, count(DISTINCT norm) AS n_normalized,
       count(DISTINCT raw) - count(DISTINCT norm) AS n_collisions FROM u""")
def q_handle_collisions(spark, sf):
    """D4 + A10: distinct raw vs normalised names."""
    return P.handle_collisions(events_posts(spark, sf))


@register("activity_outliers", f"""
WITH {_PER_USER_SQL},
s AS (SELECT round(quantile_cont(n, 0.99), 6) AS p99, max(n) AS max_n FROM c)
SELECT username, n, p99, max_n, max_n > 10.0 * p99 AS alert
FROM (SELECT * FROM c ORDER BY n DESC, username LIMIT 5), s""")
def q_activity_outliers(spark, sf):
    """D5 + A12 + A13: top 5 authors, p99, max and the outlier alert."""
    return P.activity_outliers(events_posts(spark, sf))


@register("cutoff_ties", f"""
WITH {_PER_USER_SQL},
top AS (SELECT * FROM c ORDER BY n DESC, username LIMIT {K}),
cut AS (SELECT CASE WHEN count(*) >= {K} THEN min(n) END AS v FROM top),
r AS (SELECT (SELECT v FROM cut) AS cutoff_value,
             (SELECT count(*) FROM c WHERE n = (SELECT v FROM cut)) AS keys_at_cutoff,
             (SELECT count(*) FROM top WHERE n = (SELECT v FROM cut)) AS keys_at_cutoff_in_top)
SELECT {K} AS k, cutoff_value, keys_at_cutoff, keys_at_cutoff_in_top,
       keys_at_cutoff > keys_at_cutoff_in_top AS split_tie FROM r""")
def q_cutoff_ties(spark, sf):
    """D6 + K5 + W2: value at rank k and the keys tied on it."""
    return P.cutoff_ties(events_posts(spark, sf), K)


@register("quantile_posts_per_user", f"""
WITH {_PER_USER_SQL}
SELECT round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.99), 6) AS p99,
       min(n) AS min_n, max(n) AS max_n FROM c""")
def q_quantile_posts_per_user(spark, sf):
    """A12 + A13: exact quantiles (linear interpolation), min and max."""
    c = P.posts_per_user(events_posts(spark, sf))
    return c.agg(
        F.round(G.quantile(c, 0.5), 6).alias("p50"),
        F.round(G.quantile(c, 0.99), 6).alias("p99"),
        F.min("n").alias("min_n"),
        F.max("n").alias("max_n"),
    )


@register("identity_consistency", f"""
WITH posts AS ({A.EVENTS_POSTS_SQL}),
u AS (SELECT {USER_ID} AS uid, {USERNAME} AS name FROM posts),
pairs AS (SELECT DISTINCT uid, name FROM u WHERE uid IS NOT NULL AND name IS NOT NULL)
SELECT (SELECT count(*) FROM (SELECT name FROM pairs GROUP BY name HAVING count(*) > 1)) AS names_with_many_ids,
       (SELECT count(*) FROM (SELECT uid FROM pairs GROUP BY uid HAVING count(*) > 1)) AS ids_with_many_names,
       count(*) AS n_rows, count(DISTINCT name) AS n_distinct_names,
       round(count(*) / count(DISTINCT name), 6) AS rows_per_name
FROM u""")
def q_identity_consistency(spark, sf):
    """D9 + A11 + A15: names with several ids, ids with several names, repetition."""
    return P.identity_consistency(events_posts(spark, sf))


@register("time_range", f"""
WITH posts AS ({A.EVENTS_POSTS_SQL})
SELECT min({A.sql_utc_day()}) AS first_day, max({A.sql_utc_day()}) AS last_day,
       count(*) FILTER (WHERE coalesce(year({A.sql_utc_day()}) <> {EVENTS_YEAR}, true)) AS n_outside_year
FROM posts""")
def q_time_range(spark, sf):
    """D12 + A13 + P12: first/last UTC day, posts outside the year."""
    return P.time_range(events_posts(spark, sf), EVENTS_YEAR)


@register("integrity_counters", f"""
WITH posts AS ({A.EVENTS_POSTS_SQL})
SELECT count(*) AS n_posts, count(*) FILTER (WHERE id IS NULL) AS null_ids,
       count(*) FILTER (WHERE "user" IS NULL) AS null_users,
       count(*) FILTER (WHERE "user" IS NOT NULL AND {USERNAME} IS NULL) AS null_usernames,
       count(*) FILTER (WHERE {USERNAME} = '') AS empty_usernames,
       count(*) FILTER (WHERE date IS NULL) AS null_dates,
       count(*) FILTER (WHERE date IS NOT NULL AND {A.sql_utc_ts()} IS NULL) AS bad_dates,
       count(*) FILTER (WHERE content IS NULL) AS null_content
FROM posts""")
def q_integrity_counters(spark, sf):
    """Integrity counters of the input."""
    return P.integrity_counters(events_posts(spark, sf))


# ---------------------------------------------------------------------------
# Documents: text profiles.

_DOCS = f"d AS ({A.DOCUMENTS_POSTS_SQL})"


@register("truncation_profile", f"""
WITH {_DOCS}
SELECT count(*) AS n_posts,
  count(*) FILTER (WHERE n_chars > {A.DOC_LONG_CHARS}) AS n_truncated,
  round(count(*) FILTER (WHERE n_chars > {A.DOC_LONG_CHARS}) / count(*), 6) AS truncated_share,
  count(*) FILTER (WHERE id % {A.DOC_MOD} = {A.DOC_TRUNCATED}) AS n_extended,
  count(*) FILTER (WHERE regexp_matches(content, '{ENDS_WITH_ELLIPSIS}')) AS n_ellipsis,
  round(count(*) FILTER (WHERE regexp_matches(content, '{ENDS_WITH_ELLIPSIS}')) / count(*), 6) AS ellipsis_share
FROM d""")
def q_truncation_profile(spark, sf):
    """D1 + P10 + P13 + P14: truncated flag, extended text, ellipsis endings."""
    return P.truncation_profile(documents_records(spark, sf))


@register("retweet_profile", f"""
WITH {_DOCS},
r AS (SELECT *, (id % {A.DOC_MOD} = {A.DOC_RETWEET} OR id % {A.DOC_EXTRA_RETWEET_MOD} = 0) AS meta,
             starts_with(content, 'RT @') AS txt FROM d)
SELECT count(*) AS n_posts, count(*) FILTER (WHERE meta) AS n_retweet_meta,
  round(count(*) FILTER (WHERE meta) / count(*), 6) AS retweet_meta_share,
  count(*) FILTER (WHERE txt) AS n_retweet_text,
  round(count(*) FILTER (WHERE txt) / count(*), 6) AS retweet_text_share
FROM r""")
def q_retweet_profile(spark, sf):
    """D2 + P11 + P13: retweets by metadata and by text."""
    return P.retweet_profile(documents_records(spark, sf))


@register("mention_discrepancy", f"""
WITH {_DOCS},
s AS (SELECT id, content, meta_names,
             list_distinct(regexp_extract_all(content, '{MENTION_IN_TEXT}', 1)) AS text_names FROM d),
f AS (SELECT id, substring(content, 1, 50) AS snippet,
             len(list_filter(meta_names, lambda x: NOT list_contains(text_names, x))) > 0 AS hidden,
             len(list_filter(text_names, lambda x: NOT list_contains(meta_names, x))) > 0 AS fake FROM s)
SELECT count(*) AS n_posts, count(*) FILTER (WHERE hidden) AS n_hidden, count(*) FILTER (WHERE fake) AS n_fake,
  min(id) FILTER (WHERE hidden) AS hidden_example_id, arg_min(snippet, id) FILTER (WHERE hidden) AS hidden_example,
  min(id) FILTER (WHERE fake) AS fake_example_id, arg_min(snippet, id) FILTER (WHERE fake) AS fake_example
FROM f""")
def q_mention_discrepancy(spark, sf):
    """D3 + E8 + F9-F11: hidden and fake mentions."""
    return P.mention_discrepancy(documents_posts(spark, sf))


@register("mention_structure", f"""
WITH m AS ({A.SUPPLIER_MENTIONS_SQL}),
o AS (SELECT l_orderkey, bool_or(username IS NULL) AS has_null FROM m GROUP BY l_orderkey)
SELECT count(*) AS n_posts,
  count(*) FILTER (WHERE l_orderkey % {A.MENTION_NULL_LIST_MOD} <> 0) AS n_with_list,
  count(*) FILTER (WHERE l_orderkey % {A.MENTION_NULL_LIST_MOD} <> 0 AND l_orderkey % {A.MENTION_EMPTY_LIST_MOD} <> 0
                   AND has_null) AS n_with_null_name
FROM o""")
def q_mention_structure(spark, sf):
    """D10 + F12: posts with a list, lists with a null name."""
    return P.mention_structure(lineitem_posts(spark, sf))


# ---------------------------------------------------------------------------
# Emoji complexity.

from postscope.plans.catalog_questions import sql_emoji_counts  # noqa: E402


@register("emoji_complexity_run", f"""
WITH {sql_emoji_counts('run')},
x AS (SELECT *, length(emoji) > 1 OR contains(emoji, chr(8205)) AS complex FROM c)
SELECT emoji, n, (SELECT CAST(sum(n) AS BIGINT) FROM x) AS total_tokens,
       (SELECT CAST(sum(n) FILTER (WHERE complex) AS BIGINT) FROM x) AS complex_tokens
FROM x WHERE complex ORDER BY n DESC, emoji LIMIT 3""")
def q_emoji_complexity_run(spark, sf):
    """D11 + F13 with the run definition."""
    return P.emoji_complexity(events_posts(spark, sf), "run")


@register("emoji_complexity", f"""
WITH {sql_emoji_counts('grapheme')},
x AS (SELECT *, length(emoji) > 1 OR contains(emoji, chr(8205)) AS complex FROM c)
SELECT emoji, n, (SELECT CAST(sum(n) AS BIGINT) FROM x) AS total_tokens,
       (SELECT CAST(sum(n) FILTER (WHERE complex) AS BIGINT) FROM x) AS complex_tokens
FROM x WHERE complex ORDER BY n DESC, emoji LIMIT 3""")
def q_emoji_complexity(spark, sf):
    """D11 with whole emoji sequences."""
    return P.emoji_complexity(events_posts(spark, sf), "grapheme")


# ---------------------------------------------------------------------------
# JSON lines: strict parse, dead letters, untyped records.

_LINES = f"l AS ({A.EVENTS_JSON_LINES_SQL})"


@register("strict_parse_summary", f"""
WITH {_LINES}
SELECT coalesce(expected_reason, 'ok') AS reject_reason, count(*) AS n FROM l GROUP BY 1""")
def q_strict_parse_summary(spark, sf):
    """S2 + S7: lines per reject reason ('ok' for valid posts)."""
    parsed = S.parse_posts_strict(event_lines(spark, sf))
    return G.count_by(parsed.select(F.coalesce("reject_reason", F.lit("ok")).alias("reject_reason")), "reject_reason")


@register("dead_letter", f"""
WITH {_LINES}
SELECT line_no, value AS raw, expected_reason AS reject_reason FROM l WHERE expected_reason IS NOT NULL""")
def q_dead_letter(spark, sf):
    """The rejected lines with their reason."""
    return S.dead_letter(S.parse_posts_strict(event_lines(spark, sf)), keep=("line_no",))


@register("corrupt_lines", f"""
WITH {_LINES}
SELECT count(*) AS n_lines, count(expected_reason) AS n_corrupt,
       round(count(expected_reason) / count(*), 6) AS corrupt_share FROM l""")
def q_corrupt_lines(spark, sf):
    """Share of lines that do not parse as posts."""
    return P.corrupt_lines(S.parse_posts_strict(event_lines(spark, sf)))


# Every line that is one JSON value is a record, also with a repeated key.
_RECORDS = f"""{_LINES}, ok AS (SELECT line_no, value FROM l WHERE json_valid(value))"""
_JSON_TYPE = """CASE WHEN json_type(value, '{p}') IS NULL THEN 'missing'
  WHEN json_type(value, '{p}') = 'NULL' THEN 'null'
  WHEN json_type(value, '{p}') = 'VARCHAR' THEN 'string'
  WHEN json_type(value, '{p}') IN ('BIGINT', 'UBIGINT') THEN 'integer'
  WHEN json_type(value, '{p}') = 'DOUBLE' THEN 'number'
  WHEN json_type(value, '{p}') = 'BOOLEAN' THEN 'boolean'
  WHEN json_type(value, '{p}') = 'OBJECT' THEN 'object'
  WHEN json_type(value, '{p}') = 'ARRAY' THEN 'array' END"""


@register("key_column_profile", f"""
WITH {_RECORDS},
cells AS ({" UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_JSON_TYPE.format(p='$.' + c)} AS type FROM ok" for c in P.KEY_COLUMNS)})
SELECT "column", type, count(*) AS n FROM cells GROUP BY 1, 2""")
def q_key_column_profile(spark, sf):
    """D8 + A9 + F14 + S3: value types of the key columns in untyped records."""
    from postscope.sources.posts import records_from_text

    return P.key_column_profile(records_from_text(event_lines(spark, sf)))


@register("record_field_sum", """
SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum, count(*) AS n
FROM events GROUP BY 1""")
def q_record_field_sum(spark, sf):
    """S3: untyped access to a JSON field (``props``) through VARIANT."""
    ev = load(spark, sf, "events")
    v = F.try_parse_json("props")
    return ev.groupBy("event_type").agg(
        F.sum(F.try_variant_get(v, "$.k", "bigint")).alias("k_sum"), F.count(F.lit(1)).alias("n")
    )


@register("top_days_top_user_json", sql_q1(A.EVENTS_LENIENT_SQL, A.sql_utc_day()))
def q_top_days_top_user_json(spark, sf):
    """S1 + Q1: JSON text lines parsed with the fixed schema (malformed lines
    give rows of nulls, which carry no day; of a line with more text after
    its object the object counts), then Q1."""
    from postscope.schema import POST

    posts = event_lines(spark, sf).select(F.from_json("value", POST, S.JSON_OPTIONS).alias("p")).select("p.*")
    return Q.top_days_top_user(posts, K)


_DRIFT_KINDS = {"id": "BIGINT", "date": "STRING", "content": "STRING", "user": "OBJECT", "mentionedUsers": "ARRAY"}
_DRIFT_CELLS = " UNION ALL ".join(
    f"SELECT '{f}' AS field, '{k}' AS want, CASE json_type(value, '$.{f}') WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' "
    f"ELSE json_type(value, '$.{f}') END AS kind FROM ok" for f, k in _DRIFT_KINDS.items())


@register("schema_drift", f"""
WITH {_RECORDS}, cells AS ({_DRIFT_CELLS}),
seen AS (SELECT field, want, count(DISTINCT kind) FILTER (WHERE kind <> 'NULL') AS kinds, min(kind) FILTER (WHERE kind <> 'NULL') AS kind
         FROM cells GROUP BY field, want)
SELECT field, CASE WHEN kinds = 0 THEN 'absent' WHEN kinds > 1 THEN 'mixed' WHEN kind = want THEN 'ok' ELSE 'different' END AS status
FROM seen""")
def q_schema_drift(spark, sf):
    """Observed structure of the JSON lines against the post schema."""
    from postscope.sources.posts import records_from_text

    return P.schema_drift(records_from_text(event_lines(spark, sf))).select("field", "status")


def _element_kind(elements: str, inner: str) -> str:
    """SQL: the kind of an array's elements, or of a field of theirs, within one
    record: null where none has a value, VARIANT where they differ."""
    kinds = f"list_distinct(list_filter(list_transform({elements}, lambda x: {inner}), lambda t: t IS NOT NULL AND t <> 'NULL'))"
    return f"CASE len({kinds}) WHEN 0 THEN NULL WHEN 1 THEN {kinds}[1] ELSE 'VARIANT' END"


_NESTED_WANT = {
    "$": "OBJECT", "$.id": "BIGINT", "$.date": "STRING", "$.content": "STRING", "$.user": "OBJECT", "$.user.id": "BIGINT",
    "$.user.username": "STRING", "$.mentionedUsers": "ARRAY", "$.mentionedUsers[]": "OBJECT", "$.mentionedUsers[].username": "STRING"}
_NESTED_KINDS = {p: f"json_type(value, '{p}')" for p in _NESTED_WANT if "[]" not in p} | {
    "$[]": _element_kind("CASE WHEN json_type(value) = 'ARRAY' THEN CAST(value AS JSON[]) ELSE [] END", "json_type(x)"),
    "$.mentionedUsers[]": _element_kind("coalesce(json_extract(value, '$.mentionedUsers[*]'), [])", "json_type(x)"),
    "$.mentionedUsers[].username": _element_kind("coalesce(json_extract(value, '$.mentionedUsers[*]'), [])", "json_type(x, '$.username')"),
}
_NESTED_CELLS = " UNION ALL ".join(f"SELECT day, '{p}' AS path, {k} AS t FROM dated" for p, k in _NESTED_KINDS.items())


@register("schema_drift_nested", f"""
WITH {_RECORDS}, dated AS (SELECT value, try_cast(substring(json_extract_string(value, '$.date'), 1, 10) AS DATE) AS day FROM ok),
cells AS (SELECT day, path, CASE t WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' ELSE t END AS kind FROM ({_NESTED_CELLS}) c WHERE t <> 'NULL'),
met AS (SELECT day, path, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds, count(DISTINCT kind) AS k, count(*) AS n FROM cells GROUP BY day, path),
w AS (SELECT * FROM (VALUES {", ".join(f"('{p}', '{k}')" for p, k in _NESTED_WANT.items())}) t(path, expected)),
every AS (SELECT day, path FROM (SELECT DISTINCT day FROM dated) d, w UNION SELECT day, path FROM met)
SELECT every.day, every.path, w.expected, coalesce(met.kinds, '') AS kinds, coalesce(met.n, 0) AS n,
  CASE WHEN w.expected IS NULL THEN 'extra' WHEN met.k IS NULL THEN 'absent' WHEN met.k > 1 THEN 'mixed' WHEN met.kinds = w.expected THEN 'ok' ELSE 'different' END AS status
FROM every LEFT JOIN w USING (path) LEFT JOIN met ON met.path = every.path AND met.day IS NOT DISTINCT FROM every.day""")
def q_schema_drift_nested(spark, sf):
    """D14 at any depth and per day written in the record: kinds met at every
    path, array elements included, against the post schema."""
    from postscope.sources.posts import records_from_text

    day = F.try_to_date(F.substring(F.try_variant_get("v", "$.date", "string"), 1, 10), "yyyy-MM-dd")
    return P.nested_drift(records_from_text(event_lines(spark, sf)).select("v", day.alias("day")), ["day"])


# ---------------------------------------------------------------------------
# Samples and sketches.


@register("head_sample", f"""
WITH posts AS ({A.EVENTS_POSTS_SQL}) SELECT id, date FROM posts ORDER BY id LIMIT 1000""")
def q_head_sample(spark, sf):
    """K6: the first 1,000 posts by id (the limit is the feature)."""
    return G.head_sample(events_posts(spark, sf), 1000).select("id", "date")


@register("reservoir_sample", """
SELECT c_custkey, c_name FROM (SELECT c_custkey, c_name,
  md5('42:{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_name":"' || c_name || '"}') AS h FROM customer)
ORDER BY h LIMIT 100""")
def q_reservoir_sample(spark, sf):
    """K7: a uniform, seeded sample of exactly 100 customers."""
    return G.reservoir_sample(load(spark, sf, "customer").select("c_custkey", "c_name"), 100, seed=42)


@register("approx_distinct_users", f"""
WITH posts AS ({A.EVENTS_POSTS_SQL})
SELECT count(DISTINCT {USERNAME}) AS exact_users, true AS approx_within, true AS hll_within FROM posts""")
def q_approx_distinct_users(spark, sf):
    """HyperLogLog distinct authors, within five standard errors of the
    exact count (rsd 1 %; 2 ** 12 registers: 1.6 %)."""
    p = events_posts(spark, sf).select(F.col("user.username").alias("u"))
    exact = F.count_distinct("u")

    def within(estimate, rsd):
        return F.abs(estimate - exact) <= 5 * rsd * exact

    return p.agg(
        exact.alias("exact_users"),
        within(X.approx_distinct("u", 0.01), 0.01).alias("approx_within"),
        within(F.hll_sketch_estimate(X.hll_sketch("u")), 0.016).alias("hll_within"),
    )


@register("approx_top_users", f"""
WITH posts AS ({A.EVENTS_POSTS_SQL})
SELECT {USERNAME} AS username, count(*) AS n FROM posts WHERE {USERNAME} IS NOT NULL GROUP BY 1 ORDER BY n DESC, username LIMIT {K}""")
def q_approx_top_users(spark, sf):
    """Heavy-hitter authors in bounded memory (exact while they fit)."""
    p = events_posts(spark, sf).select(F.col("user.username").alias("username"))
    return X.approx_top_k(p, "username", K, 100000)


@register("daily_rollup_top_days", f"""
WITH posts AS ({A.EVENTS_POSTS_SQL}),
c AS (SELECT {A.sql_utc_day()} AS date, count(*) AS n FROM posts WHERE {A.sql_utc_day()} IS NOT NULL GROUP BY 1)
SELECT date, n FROM c ORDER BY n DESC, date DESC LIMIT {K}""")
def q_daily_rollup_top_days(spark, sf):
    """Hourly rollup, re-aggregated to days, top k read from it."""
    from postscope.functions.days import parse_ts

    hourly = X.daily_rollup(events_posts(spark, sf), parse_ts("date"))
    return G.top_k(X.roll_up_days(hourly), K, "n", ["date"], descending_keys=True).select(
        "date", F.col("n").cast("long").alias("n")
    )
