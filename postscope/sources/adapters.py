"""Shape the driver's tables as posts (schema ``POST``).

The driver's tables hold no posts, emoji or ``@handle`` texts, so each
adapter derives them with a fixed, documented rule from whole tables. Every
Spark adapter has a DuckDB twin (``*_SQL``, a CTE body over the same table)
built from the same fixed values, so the oracle applies the identical rule.

* ``events_posts``: one post per event. ``date`` is the event time written as
  ISO text with an offset chosen by ``event_id % 4``, some unparsable or
  date-only texts; ``user`` from ``user_id`` with name changes (full-width
  ``ＵＳＥＲ_`` on half the posts of ids ending in 3), a name shared by two
  ids (ids ending in 24 and 49 use the name of the id before), nameless and
  userless posts; ``content`` is text with emoji chosen by ``CASE``.
* ``orders_posts``: one post per order, author = the customer (many ties).
* ``lineitem_posts``: one post per order whose mention list holds the
  suppliers of its lines (upper-cased on odd orders, a null name at line 7,
  ``''`` at line 6; null list when ``l_orderkey % 11 = 0``, empty when
  ``% 13 = 0``).
* ``lineitem_line_posts``: the same mentions, one post per line item.
* ``documents_posts``: one post per document, some marked truncated (`` …``)
  or retweeted (``RT @source: ``); the mention list is the source plus, on
  even ids, the ``@names`` written in the text.
* ``events_json_lines``: events as JSON text lines, some broken on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postscope.schema import POST
from postscope.functions.text import MENTION_IN_TEXT


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Fixed values.
# Offsets written after the event time, chosen by event_id % 4.
OFFSETS = ["+00:00", "-05:00", "+05:30", "Z"]
BAD_DATE_MOD, BAD_DATE_TEXT = 53, "not a date"
DATE_ONLY_MOD = 59
NO_USER_MOD, NO_NAME_MOD, NO_CONTENT_MOD = 17, 19, 23
WIDE_PREFIX, PLAIN_PREFIX = "\uFF35\uFF33\uFF25\uFF32_", "user_"
# Text per event type, then emoji snippets picked by user_id and event_id.
TYPE_TEXT = {
    "view": "Watching",
    "click": "Clicked \U0001F44D",
    "signup": "Joined \U0001F389",
    "purchase": "Bought \U0001F6CD\uFE0F",
    "error": "Oops \U0001F631",
}
SNIPPETS = [
    "\U0001F468\u200D\U0001F469\u200D\U0001F467\u200D\U0001F466",  # family
    "\U0001F64F\U0001F3FB",  # folded hands, light skin tone
    "\u2708\uFE0F",  # airplane + VS16
    "\u2764\uFE0F\u2764\uFE0F",  # two hearts
    "\U0001F1EE\U0001F1F3",  # flag pair
    "\U0001F1EE x",  # lone regional indicator
    "\u00A9 5 #",  # text-default pictograph, digit, hash
    "\U0001FAE0",  # newer emoji
    "\u0915\u094D\u200D\u0937",  # Indic conjunct with ZWJ
    "\U0001F600",  # grinning face
    "\U0001F525\U0001F525",  # two fires
    "\U0001F44D\U0001F3FD",  # thumbs up, medium skin tone
    "\U0001F680",  # rocket
    "\u2728",  # sparkles
    "1\uFE0F\u20E3",  # keycap one
    "no emoji here",
    "\U0001F600\U0001F525\u2708",  # run without separators
    "\U0001F469\u200D\u2764\uFE0F\u200D\U0001F468",  # couple with heart
]
SECOND_SNIPPET_MOD = 37
# Documents: which ids get an ellipsis ending or a retweet prefix.
DOC_MOD, DOC_TRUNCATED, DOC_RETWEET = 10, 3, 7
DOC_EXTRA_RETWEET_MOD = 31
DOC_REPEAT_MOD = 9
DOC_LONG_CHARS = 10000
# Mention lists from lineitem.
LINE_NULL_NAME, LINE_EMPTY_NAME = 7, 6
MENTION_NULL_LIST_MOD, MENTION_EMPTY_LIST_MOD = 11, 13
# JSON lines, by event_id: cut short, an array, wrong field types, a text id,
# led by a tab, blank (tab only), text after the object, two objects, a
# repeated key. The first that applies is used.
CUT_MOD, ARRAY_MOD, WRONG_TYPE_MOD, TEXT_ID_MOD = 97, 89, 83, 79
TAB_MOD, BLANK_MOD, TRAILING_MOD, TWO_MOD, REPEAT_MOD = 73, 71, 67, 61, 57
TRAILING_TEXT = " trailing"
# Staged input files (one folder each).
STAGED_PARTS = 16
# ---------------------------------------------------------------------------


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + F.lit(1)).cast("int"))


def iso_seconds(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` of a timestamp, from its text: a timestamp
    without zone gives the same text whatever the session zone."""
    text = ts.cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))


def name_id(user_id: Column) -> Column:
    return F.when((user_id % 25) == 24, user_id - 1).otherwise(user_id)


def events_posts(events: DataFrame) -> DataFrame:
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    date = (
        F.when(eid % BAD_DATE_MOD == 0, F.lit(BAD_DATE_TEXT))
        .when(eid % DATE_ONLY_MOD == 0, F.substring(ts.cast("string"), 1, 10))
        .otherwise(F.concat(iso_seconds(ts), _pick(OFFSETS, eid % 4)))
    )
    prefix = F.when(((uid % 10) == 3) & ((eid % 2) == 0), F.lit(WIDE_PREFIX)).otherwise(F.lit(PLAIN_PREFIX))
    username = F.when(eid % NO_NAME_MOD == 0, F.lit(None).cast("string")).otherwise(
        F.concat(prefix, name_id(uid).cast("string"))
    )
    user = F.when(eid % NO_USER_MOD == 0, F.lit(None)).otherwise(
        F.struct(uid.alias("id"), username.alias("username"))
    )
    type_text = F.coalesce(
        F.element_at(F.create_map(*[x for kv in TYPE_TEXT.items() for x in map(F.lit, kv)]), F.col("event_type")),
        F.lit(""),
    )
    n = len(SNIPPETS)
    content = F.when(eid % NO_CONTENT_MOD == 0, F.lit(None).cast("string")).otherwise(
        F.concat_ws(" ", type_text, _pick(SNIPPETS, uid % n), _pick(SNIPPETS, (eid % SECOND_SNIPPET_MOD) % n))
    )
    return events.select(
        eid.alias("id"),
        date.alias("date"),
        content.alias("content"),
        user.cast(POST["user"].dataType).alias("user"),
        F.lit(None).cast(POST["mentionedUsers"].dataType).alias("mentionedUsers"),
    )


def orders_posts(orders: DataFrame, customer: DataFrame, salt_buckets: int | None = None) -> DataFrame:
    """One post per order; left join keeps orders without a customer (no user).

    By default a customer with a huge share of orders is left to AQE's skew
    join; ``salt_buckets`` instead salts hot customers explicitly
    (``operators.joins.salted_join``, one extra bounded pass to find them).
    """
    c = customer.select(F.col("c_custkey").alias("o_custkey"), "c_custkey", "c_name")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    if salt_buckets:
        from postscope.operators.joins import salted_join

        j = salted_join(o, c, "o_custkey", "left", buckets=salt_buckets)
    else:
        j = o.join(c, "o_custkey", "left")
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.concat(iso_seconds(F.col("o_orderdate")), F.lit("+00:00")).alias("date"),
        F.lit(None).cast("string").alias("content"),
        F.when(F.col("c_custkey").isNull(), F.lit(None))
        .otherwise(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("username")))
        .cast(POST["user"].dataType)
        .alias("user"),
        F.lit(None).cast(POST["mentionedUsers"].dataType).alias("mentionedUsers"),
    )


def supplier_mentions(lineitem: DataFrame, supplier: DataFrame, salt_buckets: int | None = None) -> DataFrame:
    """(l_orderkey, username) per line: the supplier name with the fixed quirks.
    ``salt_buckets`` salts hot suppliers explicitly, as in ``orders_posts``."""
    s = supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    li = lineitem.select("l_orderkey", "l_suppkey", "l_linenumber")
    if salt_buckets:
        from postscope.operators.joins import salted_join

        j = salted_join(li, s, "l_suppkey", "inner", buckets=salt_buckets)
    else:
        j = li.join(s, "l_suppkey", "inner")
    name = (
        F.when(F.col("l_linenumber") == LINE_NULL_NAME, F.lit(None).cast("string"))
        .when(F.col("l_linenumber") == LINE_EMPTY_NAME, F.lit(""))
        .when(F.col("l_orderkey") % 2 == 1, F.upper("s_name"))
        .otherwise(F.col("s_name"))
    )
    return j.select("l_orderkey", name.alias("username"))


def lineitem_posts(lineitem: DataFrame, supplier: DataFrame, salt_buckets: int | None = None) -> DataFrame:
    """One post per order with its mention list (groups are bounded: ≤ 7 lines)."""
    m = supplier_mentions(lineitem, supplier, salt_buckets)
    k = F.col("l_orderkey")
    elem = F.when(k % MENTION_EMPTY_LIST_MOD == 0, F.lit(None)).otherwise(F.struct(F.col("username")))
    posts = m.groupBy("l_orderkey").agg(F.collect_list(elem).alias("mentionedUsers"))
    return posts.select(
        k.alias("id"),
        F.lit(None).cast("string").alias("date"),
        F.lit(None).cast("string").alias("content"),
        F.lit(None).cast(POST["user"].dataType).alias("user"),
        F.when(k % MENTION_NULL_LIST_MOD == 0, F.lit(None))
        .otherwise(F.col("mentionedUsers"))
        .cast(POST["mentionedUsers"].dataType)
        .alias("mentionedUsers"),
    )


def lineitem_line_posts(lineitem: DataFrame, supplier: DataFrame, salt_buckets: int | None = None) -> DataFrame:
    """One post per line item whose list holds its one supplier (null list
    when ``l_orderkey % 11 = 0``, empty when ``% 13 = 0``, as in
    ``lineitem_posts``). The mentions are the same multiset as in
    ``lineitem_posts`` without regrouping lines by order (no shuffle by order), so
    questions that count element by element give the same answer."""
    m = supplier_mentions(lineitem, supplier, salt_buckets)
    k = F.col("l_orderkey")
    lst = (
        F.when(k % MENTION_NULL_LIST_MOD == 0, F.lit(None))
        .when(k % MENTION_EMPTY_LIST_MOD == 0, F.array())
        .otherwise(F.array(F.struct(F.col("username"))))
    )
    return m.select(
        k.alias("id"),
        F.lit(None).cast("string").alias("date"),
        F.lit(None).cast("string").alias("content"),
        F.lit(None).cast(POST["user"].dataType).alias("user"),
        lst.cast(POST["mentionedUsers"].dataType).alias("mentionedUsers"),
    )


def _doc_content(did: Column, text: Column) -> Column:
    return (
        F.when(did % DOC_MOD == DOC_TRUNCATED, F.concat(text, F.lit(" \u2026")))
        .when(did % DOC_MOD == DOC_RETWEET, F.concat(F.lit("RT @"), F.col("source"), F.lit(": "), text))
        .otherwise(text)
    )


def documents_posts(documents: DataFrame) -> DataFrame:
    did, text = F.col("doc_id"), F.col("text")
    content = _doc_content(did, text)
    written = F.transform(
        F.regexp_extract_all(text, F.lit(MENTION_IN_TEXT), 1), lambda x: F.struct(x.alias("username"))
    )
    meta = F.when(
        did % 2 == 0, F.concat(F.array(F.struct(F.col("source").alias("username"))), written)
    ).otherwise(F.array(F.struct(F.col("source").alias("username"))))
    return documents.select(
        did.alias("id"),
        F.lit(None).cast("string").alias("date"),
        content.alias("content"),
        F.struct(did.alias("id"), F.col("lang").alias("username")).cast(POST["user"].dataType).alias("user"),
        meta.cast(POST["mentionedUsers"].dataType).alias("mentionedUsers"),
    )


def documents_records(documents: DataFrame) -> DataFrame:
    """``id, content`` and an untyped record ``v`` (VARIANT) with optional
    keys, for the truncation and retweet profiles. Keys whose value is null
    are left out; the record holds only small fields, not the text."""
    did = F.col("doc_id")
    rec = F.struct(
        did.alias("id"),
        F.when(F.col("n_chars") > DOC_LONG_CHARS, F.lit(True)).alias("truncated"),
        F.when(did % DOC_MOD == DOC_TRUNCATED, F.struct(F.col("n_chars").alias("full_text_chars"))).alias(
            "extended_tweet"
        ),
        F.when(
            (did % DOC_MOD == DOC_RETWEET) | (did % DOC_EXTRA_RETWEET_MOD == 0),
            F.struct(F.col("source").alias("user")),
        ).alias("retweeted_status"),
    )
    return documents.select(
        did.alias("id"), _doc_content(did, F.col("text")).alias("content"), F.parse_json(F.to_json(rec)).alias("v")
    )


def events_json_lines(events: DataFrame) -> DataFrame:
    """Events as JSON text lines (``value``), built by plain concatenation so
    the text is byte-identical in the oracle: posts with an emoji text and
    five kinds of mention list, damaged as listed in the fixed values."""
    eid, uid = F.col("event_id"), F.col("user_id")
    num = eid.cast("string")
    date = F.concat(iso_seconds(F.col("ts")), _pick(OFFSETS, eid % 4))
    content = F.concat(F.lit('"content":"'), F.col("event_type"), F.lit(" "), _pick(SNIPPETS, uid % len(SNIPPETS)), F.lit('"'))
    name = F.concat(F.lit('{"username":"User_'), (uid % 50).cast("string"), F.lit('"}'))
    mentions = (
        F.when(eid % 5 == 0, F.lit(""))
        .when(eid % 5 == 1, F.lit(',"mentionedUsers":null'))
        .when(eid % 5 == 2, F.lit(',"mentionedUsers":[]'))
        .when(eid % 5 == 3, F.concat(F.lit(',"mentionedUsers":['), name, F.lit(',{"username":""}]')))
        .otherwise(F.concat(F.lit(',"mentionedUsers":[{"username":null},'), name, F.lit("]")))
    )
    rest = F.concat(
        F.lit(',"date":"'), date, F.lit('","user":{"id":'), uid.cast("string"), F.lit(',"username":"user_'), uid.cast("string"),
        F.lit('"},'), content, mentions, F.lit("}"),
    )
    good = F.concat(F.lit('{"id":'), num, rest)
    line = (
        F.when(eid % CUT_MOD == 0, F.substring(good, 1, 20))
        .when(eid % ARRAY_MOD == 0, F.concat(F.lit("["), num, F.lit("]")))
        .when(eid % WRONG_TYPE_MOD == 0, F.concat(F.lit('{"id":'), num, F.lit(',"date":5,"user":"str",'), content, F.lit("}")))
        .when(eid % TEXT_ID_MOD == 0, F.concat(F.lit('{"id":"x"'), rest))
        .when(eid % TAB_MOD == 0, F.concat(F.lit("\t"), good))
        .when(eid % BLANK_MOD == 0, F.lit("\t "))
        .when(eid % TRAILING_MOD == 0, F.concat(good, F.lit(TRAILING_TEXT)))
        .when(eid % TWO_MOD == 0, F.concat(good, F.lit('{"id":'), num, F.lit("}")))
        .when(eid % REPEAT_MOD == 0, F.concat(F.lit('{"id":'), num, F.lit(',"id":'), num, rest))
        .otherwise(good)
    )
    return events.select(eid.alias("line_no"), line.alias("value"))


# ---------------------------------------------------------------------------
# DuckDB twins. Non-ASCII text is written with chr() so the SQL stays ASCII.

def sql_str(s: str) -> str:
    parts, run = [], ""
    for ch in s:
        if 32 <= ord(ch) < 127 and ch != "'":
            run += ch
        else:
            if run:
                parts.append(f"'{run}'")
                run = ""
            parts.append("''''" if ch == "'" else f"chr({ord(ch)})")
    if run or not parts:
        parts.append(f"'{run}'")
    return "(" + " || ".join(parts) + ")"


def sql_list(values) -> str:
    return "[" + ", ".join(sql_str(v) for v in values) + "]"


_N = len(SNIPPETS)
_TYPE_CASE = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN {sql_str(v)}" for k, v in TYPE_TEXT.items()
) + " ELSE '' END"
_NAME_ID = "CASE WHEN user_id % 25 = 24 THEN user_id - 1 ELSE user_id END"

EVENTS_POSTS_SQL = f"""
SELECT event_id AS id,
  CASE WHEN event_id % {BAD_DATE_MOD} = 0 THEN '{BAD_DATE_TEXT}'
       WHEN event_id % {DATE_ONLY_MOD} = 0 THEN strftime(ts, '%Y-%m-%d')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || {sql_list(OFFSETS)}[event_id % 4 + 1] END AS date,
  CASE WHEN event_id % {NO_CONTENT_MOD} = 0 THEN NULL
       ELSE concat_ws(' ', {_TYPE_CASE}, {sql_list(SNIPPETS)}[user_id % {_N} + 1],
                      {sql_list(SNIPPETS)}[(event_id % {SECOND_SNIPPET_MOD}) % {_N} + 1]) END AS content,
  CASE WHEN event_id % {NO_USER_MOD} = 0 THEN NULL
       ELSE struct_pack(id := user_id, username := CASE WHEN event_id % {NO_NAME_MOD} = 0 THEN NULL
            ELSE (CASE WHEN user_id % 10 = 3 AND event_id % 2 = 0 THEN {sql_str(WIDE_PREFIX)} ELSE '{PLAIN_PREFIX}' END)
                 || CAST({_NAME_ID} AS VARCHAR) END) END AS "user"
FROM events"""

ORDERS_POSTS_SQL = """
SELECT o_orderkey AS id,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS date,
  CASE WHEN c_custkey IS NULL THEN NULL ELSE struct_pack(id := c_custkey, username := c_name) END AS "user"
FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""

SUPPLIER_MENTIONS_SQL = f"""
SELECT l_orderkey,
  CASE WHEN l_linenumber = {LINE_NULL_NAME} THEN NULL WHEN l_linenumber = {LINE_EMPTY_NAME} THEN ''
       WHEN l_orderkey % 2 = 1 THEN upper(s_name) ELSE s_name END AS username
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""

# Mentions that survive into post lists (null and emptied lists removed).
LISTED_MENTIONS_SQL = f"""
SELECT l_orderkey, username FROM ({SUPPLIER_MENTIONS_SQL}) m
WHERE l_orderkey % {MENTION_NULL_LIST_MOD} <> 0 AND l_orderkey % {MENTION_EMPTY_LIST_MOD} <> 0"""

DOCUMENTS_POSTS_SQL = f"""
SELECT doc_id AS id,
  CASE WHEN doc_id % {DOC_MOD} = {DOC_TRUNCATED} THEN text || ' ' || chr(8230)
       WHEN doc_id % {DOC_MOD} = {DOC_RETWEET} THEN 'RT @' || source || ': ' || text
       ELSE text END AS content,
  CASE WHEN doc_id % 2 = 0
       THEN list_distinct(list_concat([source], regexp_extract_all(text, '{MENTION_IN_TEXT}', 1)))
       ELSE [source] END AS meta_names,
  lang, n_chars, source
FROM documents"""

_CONTENT_SQL = f"""'"content":"' || event_type || ' ' || {sql_list(SNIPPETS)}[user_id % {_N} + 1] || '"'"""
_NAME_SQL = """'{"username":"User_' || CAST(user_id % 50 AS VARCHAR) || '"}'"""
#: The lines themselves: line_no, value, and ``head``, the first object of a
#: line that starts with a whole one (what a lenient reader takes).
EVENTS_LINES_SQL = f"""
SELECT event_id AS line_no,
  CASE WHEN event_id % {CUT_MOD} = 0 THEN substring(good, 1, 20)
       WHEN event_id % {ARRAY_MOD} = 0 THEN '[' || num || ']'
       WHEN event_id % {WRONG_TYPE_MOD} = 0 THEN '{{"id":' || num || ',"date":5,"user":"str",' || content || '}}'
       WHEN event_id % {TEXT_ID_MOD} = 0 THEN '{{"id":"x"' || rest
       WHEN event_id % {TAB_MOD} = 0 THEN chr(9) || good
       WHEN event_id % {BLANK_MOD} = 0 THEN chr(9) || ' '
       WHEN event_id % {TRAILING_MOD} = 0 THEN good || '{TRAILING_TEXT}'
       WHEN event_id % {TWO_MOD} = 0 THEN good || '{{"id":' || num || '}}'
       WHEN event_id % {REPEAT_MOD} = 0 THEN '{{"id":' || num || ',"id":' || num || rest
       ELSE good END AS value, good
FROM (SELECT *, '{{"id":' || num || rest AS good FROM (
  SELECT event_id, CAST(event_id AS VARCHAR) AS num, {_CONTENT_SQL} AS content,
    ',"date":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || {sql_list(OFFSETS)}[event_id % 4 + 1]
      || '","user":{{"id":' || CAST(user_id AS VARCHAR) || ',"username":"user_' || CAST(user_id AS VARCHAR) || '"}},'
      || {_CONTENT_SQL}
      || CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN ',"mentionedUsers":null' WHEN 2 THEN ',"mentionedUsers":[]'
           WHEN 3 THEN ',"mentionedUsers":[' || {_NAME_SQL} || ',{{"username":""}}]'
           ELSE ',"mentionedUsers":[{{"username":null}},' || {_NAME_SQL} || ']' END || '}}' AS rest
  FROM events) e) g"""


def _is(path: str, *kinds: str) -> str:
    """DuckDB: the value at ``path`` is absent, null or of one of the JSON types."""
    return f"coalesce(json_type(value, '{path}') IN ('NULL', {', '.join(repr(k) for k in kinds)}), true)"


_ELEMENTS = "coalesce(CAST(json_extract(value, '$.mentionedUsers') AS JSON[]), [])"
#: Judged from the text alone: every line that isn't blank, with the reason
#: why it is no post (null for a post).
EVENTS_JSON_LINES_SQL = f"""
SELECT line_no, value, CASE
    WHEN NOT json_valid(value) THEN 'malformed_json'
    WHEN json_type(value) <> 'OBJECT' THEN 'not_an_object'
    WHEN NOT ({_is("$.id", "BIGINT", "UBIGINT")} AND {_is("$.date", "VARCHAR")} AND {_is("$.content", "VARCHAR")}
      AND {_is("$.user", "OBJECT")} AND {_is("$.user.id", "BIGINT", "UBIGINT")} AND {_is("$.user.username", "VARCHAR")}
      AND {_is("$.mentionedUsers", "ARRAY")}
      AND len(list_filter({_ELEMENTS}, lambda x: NOT coalesce(json_type(x) IN ('NULL', 'OBJECT'), true)
            OR NOT coalesce(json_type(x, '$.username') IN ('NULL', 'VARCHAR'), true))) = 0) THEN 'wrong_type' END AS expected_reason
FROM ({EVENTS_LINES_SQL}) x WHERE NOT regexp_full_match(value, '[ \\t\\r\\n]*')"""

#: Posts a lenient reader with a fixed schema makes of the lines: the first
#: object of each line; a field of another type reads as text.
EVENTS_LENIENT_SQL = f"""
SELECT json_extract_string(head, '$.date') AS date, json_extract_string(head, '$.content') AS content,
  CASE WHEN json_type(head, '$.user') = 'OBJECT' THEN struct_pack(id := CAST(json_extract(head, '$.user.id') AS BIGINT),
    username := json_extract_string(head, '$.user.username')) END AS "user",
  CASE WHEN json_type(head, '$.mentionedUsers') = 'ARRAY' THEN json_extract_string(head, '$.mentionedUsers[*].username') END AS names,
  line_no
FROM (SELECT line_no, CASE WHEN json_valid(value) THEN value WHEN starts_with(value, good) THEN good END AS head
      FROM ({EVENTS_LINES_SQL}) x) h WHERE json_type(head) = 'OBJECT'"""

# SQL expression: UTC day of an ISO text with offset (``Z`` read as +00:00).
SQL_UTC_DAY = (
    "CAST(timezone('UTC', try_strptime(regexp_replace({c}, 'Z$', '+00:00'), "
    "'%Y-%m-%dT%H:%M:%S%z')) AS DATE)"
)
SQL_UTC_TS = (
    "timezone('UTC', try_strptime(regexp_replace({c}, 'Z$', '+00:00'), '%Y-%m-%dT%H:%M:%S%z'))"
)


def sql_utc_day(c: str = "date") -> str:
    return SQL_UTC_DAY.format(c=c)


def sql_utc_ts(c: str = "date") -> str:
    return SQL_UTC_TS.format(c=c)
