"""Registered queries that run the file-based jobs: the on-demand runner
(T2) for every question and strategy, its run event (O1-O3), the file-arrival
stream (T1), schema inference (S4), the ingest into day-partitioned Parquet
(S11, S12) and the stored rollup (A18).

Each call stages the events JSON lines (``adapters.events_json_lines``, the
whole table) as text files with an ordinary distributed write into a folder
under the shared folder named by ``spark.checkpoint.dir``, then runs the job
on those files exactly as a user would on their own input. Each call has a
folder of its own, as the frame it returns reads it lazily; the cluster clears
the shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from postscope.functions import emoji as EM
from postscope.plans.catalog import K, ORACLE_SQL, event_lines, events_posts, load, register
from postscope.plans.catalog_profiles import _LINES
from postscope.plans.catalog_questions import USERNAME, sql_q1
from postscope.session import shared_dir
from postscope.sources import adapters as A

_SESSION = uuid.uuid4().hex[:12]


def staging(spark, name: str) -> str:
    """A new folder for each call: a frame of an earlier call still reads its own."""
    return shared_dir(spark, f"staging-{_SESSION}/{name}-{uuid.uuid4().hex[:12]}")


def stage_lines(spark, sf, name: str, parts: int | None = None) -> str:
    """Write the lines below ``<base>/input``; with ``parts`` as one file in
    each of that many folders (``event_id`` modulo)."""
    base = staging(spark, name)
    lines = event_lines(spark, sf)
    if parts is None:
        lines.select("value").write.mode("overwrite").text(f"{base}/input")
    else:
        folder = (F.col("line_no") % parts).cast("int").alias("part")
        lines.select("value", folder).repartitionById(parts, "part").write.mode("overwrite").partitionBy("part").text(f"{base}/input")
    return base


# Posts of the lines, as the strict reader of a question takes them: judged
# per question from the text; of a repeated key the last value counts (both
# values are equal in these lines).
_OBJECTS = f"""o AS (SELECT value FROM ({A.EVENTS_LINES_SQL}) x WHERE json_valid(value) AND json_type(value) = 'OBJECT')"""
_Q1_OK = "json_type(value, '$.date') = 'VARCHAR' AND json_type(value, '$.user.username') = 'VARCHAR'"
_Q2_OK = "json_type(value, '$.content') = 'VARCHAR'"
_Q3_OK = """json_type(value, '$.mentionedUsers') IN ('NULL', 'ARRAY')
  AND len(list_filter(coalesce(json_extract(value, '$.mentionedUsers[*]'), []),
    lambda x: NOT coalesce(json_type(x, '$.username') = 'VARCHAR', false))) = 0"""
PREFIX_DAY = "try_strptime(substring(date, 1, 10), '%Y-%m-%d')::DATE"
_STRICT_POSTS = f"""SELECT json_extract_string(value, '$.date') AS date,
  struct_pack(username := json_extract_string(value, '$.user.username')) AS "user"
FROM (SELECT value FROM ({A.EVENTS_LINES_SQL}) x WHERE json_valid(value) AND json_type(value) = 'OBJECT' AND {_Q1_OK}) v"""


def _emojis(content_sql: str, definition: str) -> str:
    return f"""WITH p AS ({content_sql}),
t AS (SELECT unnest(regexp_extract_all(content, '{EM.pattern(definition)}', 0)) AS emoji FROM p)
SELECT emoji, count(*) AS n FROM t GROUP BY emoji ORDER BY n DESC, emoji LIMIT {K}"""


_ON_DEMAND = {
    ("q1", "time"): sql_q1(A.EVENTS_LENIENT_SQL, A.sql_utc_day()),
    ("q1", "memory"): sql_q1(_STRICT_POSTS, PREFIX_DAY, strict=True),
    ("q2", "time"): _emojis(f"SELECT content FROM ({A.EVENTS_LENIENT_SQL}) l", "property"),
    ("q2", "memory"): _emojis(
        f"SELECT json_extract_string(value, '$.content') AS content FROM ({A.EVENTS_LINES_SQL}) x "
        f"WHERE json_valid(value) AND json_type(value) = 'OBJECT' AND {_Q2_OK}", "range"),
    ("q3", "time"): f"""WITH n AS (SELECT unnest(names) AS name FROM ({A.EVENTS_LENIENT_SQL}) l)
SELECT lower(name) AS username, count(*) AS n FROM n WHERE name IS NOT NULL AND name <> '' GROUP BY 1 ORDER BY n DESC, username LIMIT {K}""",
    ("q3", "memory"): f"""WITH {_OBJECTS}, n AS (SELECT unnest(json_extract_string(value, '$.mentionedUsers[*].username')) AS name FROM o WHERE {_Q3_OK})
SELECT lower(name) AS username, count(*) AS n FROM n GROUP BY 1 ORDER BY n DESC, username LIMIT {K}""",
}


def _on_demand(question: str, strategy: str):
    def q(spark, sf):
        from postscope.plans.registry import run

        base = stage_lines(spark, sf, f"on_demand_{question}_{strategy}")
        return run(spark, question, strategy, f"{base}/input", K)

    q.__doc__ = f"T2: ``run(spark, {question!r}, {strategy!r}, path)`` over staged NDJSON files."
    return q


for (_q, _s), _sql in _ON_DEMAND.items():
    register(f"on_demand_{_q}_{_s}", _sql)(_on_demand(_q, _s))


@register("run_event_q2_memory", f"""
WITH {_OBJECTS}, lines AS (SELECT value FROM ({A.EVENTS_LINES_SQL}) x WHERE NOT regexp_full_match(value, '[ \\t\\r\\n]*')),
p AS (SELECT json_extract_string(value, '$.content') AS content FROM o WHERE {_Q2_OK}),
t AS (SELECT unnest(regexp_extract_all(content, '{EM.pattern("range")}', 0)) AS emoji FROM p)
SELECT 'q2_memory_execution' AS event, 'success' AS status, 'q2' AS question,
  CAST(least({K}, (SELECT count(DISTINCT emoji) FROM t)) AS DOUBLE) AS output_rows,
  CAST((SELECT count(DISTINCT emoji) FROM t) AS DOUBLE) AS unique_emojis,
  (SELECT count(*) FROM lines WHERE NOT json_valid(value)) AS malformed_json,
  (SELECT count(*) FROM lines WHERE json_valid(value) AND json_type(value) <> 'OBJECT') AS not_an_object,
  (SELECT count(*) FROM o WHERE NOT coalesce({_Q2_OK}, false)) AS invalid_post""")
def q_run_event(spark, sf):
    """O1-O3: the event row of a logged run; its counts, without the times."""
    from postscope.plans.registry import run_logged

    base = stage_lines(spark, sf, "run_event")
    _, event = run_logged(spark, "q2", "memory", f"{base}/input", K)

    def lines(reason):
        of = F.filter("errors", lambda e: e["type"] == reason)
        return F.coalesce(F.get(of, 0)["lines"], F.lit(0).cast("long")).alias(reason)

    return event.select(
        "event", "status", F.col("context")["question"].alias("question"), F.col("metrics")["output_rows"].alias("output_rows"),
        F.col("metrics")["unique_emojis"].alias("unique_emojis"), *map(lines, ("malformed_json", "not_an_object", "invalid_post")))


@register("run_event_integrity", f"""
WITH l AS ({A.EVENTS_LENIENT_SQL}), x AS (SELECT value FROM ({A.EVENTS_LINES_SQL}) y WHERE NOT regexp_full_match(value, '[ \\t\\r\\n]*'))
SELECT 'q1_time_execution' AS event, (SELECT count(DISTINCT {A.sql_utc_day()}) FROM l)::DOUBLE AS total_dates,
  (SELECT count(*) FROM x)::DOUBLE AS n_posts, (SELECT count(*) FROM x)::DOUBLE - (SELECT count(date) FROM l) AS null_dates,
  (SELECT count(*) FROM l WHERE date IS NOT NULL AND {A.sql_utc_ts()} IS NULL)::DOUBLE AS bad_dates,
  (SELECT count(*) FROM x)::DOUBLE - (SELECT count("user") FROM l) AS null_users, 0.0::DOUBLE AS empty_usernames""")
def q_run_event_integrity(spark, sf):
    """O2 + D13: a logged run with the integrity counters of its posts, counted
    by the job that answers."""
    from postscope.plans.registry import run_logged

    _, event = run_logged(spark, "q1", "time", f"{stage_lines(spark, sf, 'run_integrity')}/input", K, integrity=True)
    names = ("total_dates", "n_posts", "null_dates", "bad_dates", "null_users", "empty_usernames")
    return event.select("event", *(F.col("metrics")[n].alias(n) for n in names))


@register("file_arrival_answers", f"""
WITH d AS (SELECT line_no % {A.STAGED_PARTS} AS part, {A.sql_utc_day()} AS date, {USERNAME} AS author FROM ({A.EVENTS_LENIENT_SQL}) l),
pairs AS (SELECT part, date, author, count(*) AS n FROM d WHERE date IS NOT NULL GROUP BY ALL),
days AS (SELECT part, date, CAST(sum(n) AS BIGINT) AS total, CAST(sum(n) FILTER (WHERE author IS NOT NULL) AS BIGINT) AS day_total_tweets,
         first(author ORDER BY n DESC, author) FILTER (WHERE author IS NOT NULL) AS top_user FROM pairs GROUP BY part, date),
r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY total DESC, date DESC) AS i FROM days)
SELECT 'part=' || CAST(part AS VARCHAR) AS folder, date, top_user, day_total_tweets FROM r WHERE i <= {K} AND day_total_tweets IS NOT NULL""")
def q_file_arrival_answers(spark, sf):
    """The file-arrival stream (available-now) over staged NDJSON files in
    sub-folders; one Q1 answer per file, read back from the output folder."""
    from postscope.streaming.arrival import read_answers, start_file_arrival

    base = stage_lines(spark, sf, "arrival", A.STAGED_PARTS)
    q = start_file_arrival(spark, f"{base}/input", f"{base}/output", f"{base}/checkpoint", K, max_files_per_trigger=64)
    q.awaitTermination()  # the available-now trigger ends by itself
    folder = F.regexp_extract("source_name", r"^(.*)/[^/]*$", 1).alias("folder")
    return read_answers(spark, f"{base}/output").select(folder, "date", "top_user", "day_total_tweets")


_INGEST_COUNTS = f"""
WITH {_LINES},
s AS (SELECT CASE WHEN expected_reason IS NULL THEN 'ok' ELSE 'rejected' END AS status,
             CASE WHEN expected_reason IS NULL THEN {A.sql_utc_day("json_extract_string(value, '$.date')")} END AS d
      FROM l)
SELECT status, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day, count(*) AS n
FROM s GROUP BY ALL"""


def _ingested(spark, sf, name: str) -> str:
    from postscope.plans.ingest import ingest_posts

    base = stage_lines(spark, sf, name)
    ingest_posts(spark, f"{base}/input", f"{base}/posts")
    return f"{base}/posts"


@register("ingest_day_counts", _INGEST_COUNTS)
def q_ingest_day_counts(spark, sf):
    """S2 + S10 + S11 + S12: staged NDJSON ingested once into
    status/year/month/day Parquet; rows per partition read back."""
    from postscope.operators.aggregate import count_by

    posts = spark.read.parquet(_ingested(spark, sf, "ingest"))
    return count_by(posts.select(F.col("status"), "year", "month", "day"), "status", "year", "month", "day")


_INGESTED_POSTS = f"""SELECT json_extract_string(value, '$.date') AS date,
  struct_pack(username := json_extract_string(value, '$.user.username')) AS "user"
FROM ({A.EVENTS_JSON_LINES_SQL}) v WHERE expected_reason IS NULL"""


@register("top_days_top_user_ingested", sql_q1(_INGESTED_POSTS, A.sql_utc_day()))
def q_top_days_top_user_ingested(spark, sf):
    """Q1 over the ingested layout: days from partition counts, authors read
    from the k chosen days only (dynamic partition pruning)."""
    from postscope.plans.ingest import top_days_top_user_ingested

    return top_days_top_user_ingested(spark, _ingested(spark, sf, "ingest_q1"), K)


@register("stored_rollup_top_days", f"""
WITH posts AS ({A.EVENTS_POSTS_SQL}),
c AS (SELECT {A.sql_utc_day()} AS date, count(*) AS n FROM posts WHERE {A.sql_utc_day()} IS NOT NULL GROUP BY 1)
SELECT date, n FROM c ORDER BY n DESC, date DESC LIMIT {K}""")
def q_stored_rollup_top_days(spark, sf):
    """The hourly rollup stored by day, read back and re-aggregated."""
    from postscope.functions.days import parse_ts
    from postscope.operators import approx as X
    from postscope.operators.aggregate import top_k

    path = f"{staging(spark, 'rollup')}/hourly"
    X.write_rollup(X.daily_rollup(events_posts(spark, sf), parse_ts("date")), path)
    return top_k(X.roll_up_days(X.read_rollup(spark, path)), K, "n", ["date"], descending_keys=True).select("date", F.col("n").cast("long").alias("n"))


@register("inferred_field_counts", f"""
WITH l AS ({A.EVENTS_LENIENT_SQL}),
x AS (SELECT value FROM ({A.EVENTS_LINES_SQL}) y WHERE NOT regexp_full_match(value, '[ \\t\\r\\n]*'))
SELECT (SELECT count(*) FROM l) AS id, (SELECT count(date) FROM l) AS date, (SELECT count(content) FROM l) AS content""")
def q_inferred_field_counts(spark, sf):
    """Staged NDJSON read with a schema inferred from every record; the
    non-null values of the text fields (one row). Inference widens ``id`` and
    ``user`` to text because some lines hold ``"id":"x"`` or ``"user":"str"``,
    which is why the fixed schema is the default."""
    from postscope.sources.posts import scan_posts_inferred

    base = stage_lines(spark, sf, "inferred")
    df = scan_posts_inferred(spark, f"{base}/input")
    return df.agg(*[F.count(F.col(c)).alias(c) for c in ("id", "date", "content")])


def stage_documents(spark, sf, name: str) -> str:
    """The documents as NDJSON records with their text, optional keys and, on
    some, a key written twice; the folder of the files."""
    path = f"{staging(spark, name)}/input"
    did = F.col("id")
    fields = F.to_json(F.struct("id", "content"))
    rest = F.regexp_replace(F.to_json("v"), r"^\{", ",")
    twice = F.when(did % A.DOC_REPEAT_MOD == 0, F.lit(',"lang":"x","lang":"y"')).otherwise(F.lit(""))
    line = F.concat(F.regexp_replace(fields, r"\}$", ""), twice, rest)
    A.documents_records(load(spark, sf, "documents")).select(line.alias("value")).write.text(path)
    return path


@register("truncation_profile_file", ORACLE_SQL["truncation_profile"])
def q_truncation_profile_file(spark, sf):
    """D1 + S3 over files: untyped records read from NDJSON, none lost to a
    repeated key."""
    from postscope.plans.profiles import truncation_profile
    from postscope.sources.posts import scan_records

    return truncation_profile(scan_records(spark, stage_documents(spark, sf, "truncation")))


@register("retweet_profile_file", ORACLE_SQL["retweet_profile"])
def q_retweet_profile_file(spark, sf):
    """D2 + S3 over files."""
    from postscope.plans.profiles import retweet_profile
    from postscope.sources.posts import scan_records

    return retweet_profile(scan_records(spark, stage_documents(spark, sf, "retweets")))


@register("key_column_profile_file", ORACLE_SQL["key_column_profile"])
def q_key_column_profile_file(spark, sf):
    """D8 + S3 over files: every line that is a JSON value is a record."""
    from postscope.plans.profiles import key_column_profile
    from postscope.sources.posts import scan_records

    return key_column_profile(scan_records(spark, f"{stage_lines(spark, sf, 'key_columns')}/input"))


LINES_PER_CHUNK = 100


@register("line_chunk_counts", f"""
WITH c AS (SELECT line_no % {A.STAGED_PARTS} AS part, count(*) AS m FROM ({A.EVENTS_LINES_SQL}) x
           WHERE NOT regexp_full_match(value, '[ \\t\\r\\n]*') GROUP BY 1),
k AS (SELECT part, m, unnest(range(CAST(ceil(m / {LINES_PER_CHUNK}.0) AS BIGINT))) AS chunk FROM c)
SELECT 'part=' || CAST(part AS VARCHAR) AS folder, CAST(0 AS BIGINT) AS block, chunk, least({LINES_PER_CHUNK}, m - chunk * {LINES_PER_CHUNK}) AS lines FROM k""")
def q_line_chunk_counts(spark, sf):
    """Chunks of consecutive lines per (file, input split), numbered where
    they are read; the files are smaller than a split."""
    from postscope.operators.aggregate import count_by
    from postscope.sources.posts import scan_line_chunks

    base = stage_lines(spark, sf, "line_chunks", A.STAGED_PARTS)
    chunks = scan_line_chunks(spark, f"{base}/input/*/*", LINES_PER_CHUNK)
    return count_by(chunks, F.regexp_extract("file", r"([^/]*)/[^/]*$", 1).alias("folder"), "block", "chunk", name="lines")


@register("arrival_ledger_answers", f"""
SELECT folder, false AS failed, date, top_user, day_total_tweets FROM ({ORACLE_SQL["file_arrival_answers"]}) a
UNION ALL SELECT 'part=bad', true, NULL, NULL, NULL""")
def q_arrival_ledger_answers(spark, sf):
    """T1 with the ledger: one answer per staged file, an error row for a file
    that can't be read, and nothing to do for a second run."""
    from postscope.streaming.ledger import answer_arrivals, read_results

    base = stage_lines(spark, sf, "arrival_ledger", A.STAGED_PARTS)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/input/part=bad/lines.json.gz")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(b"this is no gzip file"))
    out.close()
    answer_arrivals(spark, f"{base}/input", f"{base}/output", K, max_files=64)
    answer_arrivals(spark, f"{base}/input", f"{base}/output", K, max_files=64)
    folder = F.regexp_extract("source_name", r"^(.*)/[^/]*$", 1).alias("folder")
    return read_results(spark, f"{base}/output").select(folder, F.col("error").isNotNull().alias("failed"), "date", "top_user", "day_total_tweets")
