"""Registered queries: the causes of the differences between the two
strategies (Q5), each line judged from its text in the SQL twin."""

from __future__ import annotations

from postscope.functions import emoji as EM
from postscope.plans import parity as P
from postscope.plans.catalog import event_lines, register
from postscope.plans.catalog_files import PREFIX_DAY, _Q1_OK, _Q2_OK, _Q3_OK
from postscope.sources import adapters as A

_OK = {"q1": _Q1_OK, "q2": _Q2_OK, "q3": _Q3_OK}
_DAY = A.sql_utc_day("date")
_PREFIX = f"CAST({PREFIX_DAY} AS DATE)"


def _both(question: str) -> str:
    """CTE ``j``: what a lenient reader sees of each line, whether the line is one
    object and whether the question's strict reader takes it."""
    return f"""v AS (SELECT line_no, value, json_valid(value) AND coalesce(json_type(CASE WHEN json_valid(value) THEN value END) = 'OBJECT', false) AS obj FROM ({A.EVENTS_LINES_SQL}) x),
ok AS (SELECT line_no, {_OK[question]} AS ok FROM v WHERE obj),
j AS (SELECT l.date, l.content, struct_extract(l."user", 'username') AS username, l.names, v.obj, v.obj AND coalesce(ok.ok, false) AS ok
      FROM ({A.EVENTS_LENIENT_SQL}) l JOIN v USING (line_no) LEFT JOIN ok USING (line_no))"""


_ROWS = {
    "q1": f"""d AS (SELECT *, {_DAY} AS utc, CASE WHEN ok THEN {_PREFIX} END AS written FROM j),
e AS (SELECT *, CASE WHEN utc IS NOT DISTINCT FROM written THEN 'other' WHEN utc IS NULL THEN 'V2' ELSE 'V1' END AS same FROM d),
rows AS (SELECT utc AS date, username, CASE WHEN ok THEN same WHEN NOT obj THEN 'V12' WHEN username IS NULL THEN 'V3' ELSE 'V13' END AS cause, 1 AS t, 0 AS m FROM e WHERE utc IS NOT NULL
  UNION ALL SELECT written, username, same, 0, 1 FROM e WHERE ok AND written IS NOT NULL)""",
    "q2": f"""rows AS (SELECT unnest(regexp_extract_all(content, '{EM.pattern("property")}', 0)) AS emoji,
    CASE WHEN ok THEN 'V8' WHEN NOT obj THEN 'V12' ELSE 'V13' END AS cause, 1 AS t, 0 AS m FROM j
  UNION ALL SELECT unnest(regexp_extract_all(content, '{EM.pattern("range")}', 0)), 'V8', 0, 1 FROM j WHERE ok)""",
    "q3": """n AS (SELECT unnest(names) AS name, ok, obj, len(list_filter(names, lambda x: x IS NULL)) > 0 AS nameless FROM j),
rows AS (SELECT lower(name) AS username, CASE WHEN ok THEN 'other' WHEN NOT obj THEN 'V12' WHEN nameless THEN 'V11' ELSE 'V13' END AS cause, 1 AS t, 0 AS m FROM n WHERE name <> ''
  UNION ALL SELECT lower(name), CASE WHEN name = '' THEN 'V10' ELSE 'other' END, 0, 1 FROM n WHERE ok)""",
}


def _sql(question: str) -> str:
    every = (*P.CAUSES[question], P.OTHER)
    sums = ", ".join(f"CAST(coalesce(sum(m - t) FILTER (WHERE cause = '{c}'), 0) AS BIGINT) AS {c}" for c in every)
    return f"""
WITH {_both(question)}, {_ROWS[question]}
SELECT * FROM (SELECT {", ".join(P.KEYS[question])}, CAST(sum(t) AS BIGINT) AS time_n, CAST(sum(m) AS BIGINT) AS memory_n, {sums} FROM rows GROUP BY ALL) s
WHERE {" OR ".join(f"{c} <> 0" for c in every)}"""


def _query(question: str):
    def q(spark, sf):
        return P.causes_of_lines(event_lines(spark, sf), question)

    q.__doc__ = f"Q5: per output key of {question} the counts of both strategies and the rules behind their difference."
    return q


for _question in P.CAUSES:
    register(f"parity_causes_{_question}", _sql(_question))(_query(_question))
