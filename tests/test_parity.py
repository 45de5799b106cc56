"""Q5: the causes of every difference between the strategies add up."""

import json

import pytest
from conftest import post
from pyspark.sql import functions as F

from postscope.plans import parity as P
from postscope.plans import registry

LINES = [
    post("2021-02-12T10:00:00+00:00", "a", "\U0001F600 x", mentions=["B", ""]),
    post("2021-02-12T23:30:00-05:00", "a", "5 \U0001F525"),  # UTC: the day after
    post("2021-02-12", "a", "no time"),
    post("2021-02-12T10:00:00Z", None, "\U0001F600", mentions=["c", None]),
    post("2021-02-12T10:00:00Z", "b", None, mentions="null"),
    {"date": 5, "user": {"username": "b"}, "content": 7, "mentionedUsers": [{"username": 1}]},
    json.dumps(post("2021-02-13T10:00:00Z", "t", "✨", mentions=["d"])) + " trailing",
    "[1]", "broken", "",
]


@pytest.fixture
def path(write_posts):
    return write_posts(LINES)


def _by_key(df, question):
    return {tuple(str(r[k]) if r[k] is not None else None for k in P.KEYS[question]): {c: r[c] for c in df.columns if r[c] and c not in P.KEYS[question]}
            for r in df.collect()}


@pytest.mark.parametrize("question", ["q1", "q2", "q3"])
def test_causes_add_up(spark, path, question):
    df = P.causes(spark, path, question)
    for r in df.collect():
        assert r.memory_n - r.time_n == sum(r[c] for c in P.CAUSES[question]) and r.other == 0


@pytest.mark.parametrize("question", ["q2", "q3"])
def test_counts_are_those_of_the_strategies(spark, path, question):
    key, = P.KEYS[question]
    got = {r[key]: (r.time_n, r.memory_n) for r in P.causes(spark, path, question).collect()}
    time, memory = ({r[key]: r.n for r in registry.run(spark, question, s, path, 100).collect()} for s in ("time", "memory"))
    assert {k: (time.get(k, 0), memory.get(k, 0)) for k in got} == got
    assert all(time[k] == memory[k] for k in set(time) & set(memory) - set(got)) and set(time) ^ set(memory) <= set(got)


def test_q1_causes(spark, path):
    assert _by_key(P.causes(spark, path, "q1"), "q1") == {
        ("2021-02-12", "a"): {"time_n": 1, "memory_n": 3, "V1": 1, "V2": 1},
        ("2021-02-13", "a"): {"time_n": 1, "V1": -1},
        ("2021-02-12", None): {"time_n": 1, "V3": -1},
        ("2021-02-13", "t"): {"time_n": 1, "V12": -1},
    }


def test_q3_causes(spark, path):
    assert _by_key(P.causes(spark, path, "q3"), "q3") == {
        ("",): {"memory_n": 1, "V10": 1}, ("c",): {"time_n": 1, "V11": -1}, ("d",): {"time_n": 1, "V12": -1}, ("1",): {"time_n": 1, "V13": -1}}


def test_no_lines_and_unknown_question(spark):
    none = spark.createDataFrame([], "value string")
    assert all(P.causes_of_lines(none, q).count() == 0 for q in P.CAUSES)
    with pytest.raises(ValueError):
        P.causes_of_lines(none, "q4")


def test_one_pass(spark):
    lines = spark.createDataFrame([("{}",)], "value string").where(F.col("value") != "")
    plan = P.causes_of_lines(lines, "q1")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
