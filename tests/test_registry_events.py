import pytest

from conftest import post
from postscope.plans import registry
from postscope.plans.events import append_event, event_frame


def test_run_time_and_memory(spark, write_posts):
    p = write_posts([
        post("2021-02-12T10:00:00Z", "a", "hi \u2708\ufe0f", mentions=["X", None]),
        post("2021-02-12T11:00:00Z", "a", "\u2708\ufe0f", mentions=["x"]),
        '{"date": broken',
    ])
    assert [tuple(r) for r in registry.run(spark, "q1", "time", p).collect()][0][1] == "a"
    assert registry.run(spark, "q3", "time", p).collect()[0].n == 2
    assert registry.run(spark, "q3", "memory", p).collect()[0].n == 1
    assert registry.run(spark, "q2", "memory", p).collect()[0].n == 2


def test_unknown_and_missing(spark):
    with pytest.raises(ValueError):
        registry.run(spark, "q9", "time", "/x")
    with pytest.raises(ValueError):
        registry.run(spark, "q1", "time", None)


def test_event_row(spark, tmp_path):
    event = event_frame(spark, "job", "success", {"file_path": "mem", "k": 3}, [("start", 1.0), ("plan", 1.5), ("collect", 3.5)],
                        {"output_rows": 5, "missing": None}, [("bad_line", "3 lines", 3)])
    append_event(event, str(tmp_path / "log"))
    append_event(event, str(tmp_path / "log"))
    row = event.first()
    assert (row.event, row.status, row.total_duration_ms) == ("job", "success", 2500.0)
    assert row.steps == {"plan": 500.0, "collect": 2000.0} and row.metrics == {"output_rows": 5.0}
    assert row.context == {"file_path": "mem", "k": "3"} and tuple(row.errors[0]) == ("bad_line", "3 lines", 3)
    assert row.memory_usage.driver_python_peak_mb > 0 and row.memory_usage.driver_jvm_used_mb > 0
    assert spark.read.json(str(tmp_path / "log")).count() == 2


def test_failed_run_is_logged_and_raised(spark, tmp_path):
    with pytest.raises(ValueError):
        registry.run_logged(spark, "q7", "time", "/x", log_path=str(tmp_path / "log"))
    row = spark.read.json(str(tmp_path / "log")).first()
    assert row.status == "error" and row.errors[0]["type"] == "ValueError"


def test_run_logged_metrics(spark, write_posts, tmp_path):
    p = write_posts([
        post("2021-02-12T10:00:00Z", "a", "hi \u2708\ufe0f \U0001F600", mentions=["X", "y"]),
        post("2021-02-13T11:00:00Z", "b", "\u2708\ufe0f", mentions=["x"]),
    ])
    rows, ev = registry.run_logged(spark, "q1", "time", p, log_path=str(tmp_path / "log"))
    assert len(rows) == 2 and ev.first().metrics == {"total_dates": 2.0, "output_rows": 2.0}
    assert [tuple(r) for r in rows] == [tuple(r) for r in registry.run(spark, "q1", "time", p).collect()]
    _, ev2 = registry.run_logged(spark, "q2", "time", p)
    assert ev2.first().metrics["unique_emojis"] == 2.0
    _, ev3 = registry.run_logged(spark, "q3", "memory", p)
    assert ev3.first().metrics["unique_mentions"] == 2.0
    assert set(ev3.first().steps) == {"build_query_plan", "execution_collect"}
    with pytest.raises(ValueError):
        registry.run_logged(spark, "q7", "time", p)
    assert spark.read.json(str(tmp_path / "log")).count() == 1


def test_time_and_memory_days_differ(spark, write_posts):
    import datetime as dt

    p = write_posts([post("2021-02-12T23:59:59-05:00", "a")])
    assert registry.run(spark, "q1", "time", p).collect()[0].date == dt.date(2021, 2, 13)
    assert registry.run(spark, "q1", "memory", p).collect()[0].date == dt.date(2021, 2, 12)


def test_run_logged_reports_rejects(spark, write_posts):
    p = write_posts([post("2021-02-12T10:00:00Z", "a", mentions=["x"]), '{"date": "2021', "[1]"])
    rows, ev = registry.run_logged(spark, "q3", "memory", p)
    assert [(r.username, r.n) for r in rows] == [("x", 1)]
    assert sorted((e.type, e.lines) for e in ev.first().errors) == [("malformed_json", 1), ("not_an_object", 1)]


def test_command_line(spark, write_posts, capsys):
    from postscope.__main__ import main

    p = write_posts([post("2021-02-12T10:00:00Z", "a"), post("2021-02-12T11:00:00Z", "a")])
    assert main(["q1", "time", p, "--master", "local[2]"]) == 0
    assert capsys.readouterr().out.strip() == '["2021-02-12","a"]'


def test_six_function_interface(spark, write_posts):
    import datetime as dt

    p = write_posts([post("2021-02-12T10:00:00Z", "a", "\u2708\ufe0f", mentions=["X"]),
                     post("2021-02-12T11:00:00Z", "a", "\u2708\ufe0f", mentions=["x"])])
    assert registry.q1_time(spark, p) == [(dt.date(2021, 2, 12), "a")]
    assert registry.q1_memory(spark, p) == [(dt.date(2021, 2, 12), "a")]
    assert registry.q2_time(spark, p) == [("\u2708", 2)]
    assert registry.q3_memory(spark, p) == [("x", 2)]


def test_memory_strategy_rejects_wrong_types(spark, write_posts):
    p = write_posts([post("2021-02-12T10:00:00Z", "a"), '{"date": "2021-02-13T10:00:00Z", "user": {"username": 5}}'])
    assert len(registry.run(spark, "q1", "time", p).collect()) == 2
    rows, ev = registry.run_logged(spark, "q1", "memory", p)
    assert len(rows) == 1 and [e.type for e in ev.first().errors] == ["invalid_post"]


def test_strict_lines_judged_per_question(spark, write_posts):
    e = "\U0001F600"
    p = write_posts([
        '{"content":"%s"}' % e, '{"date":5,"content":"%s"}' % e, '{"user":"str","content":"%s"}' % e, '{"id":"x","content":"%s"}' % e,
        '\t{"content":"%s"}' % e, '{"content":"%s"} trailing' % e, "\t ", '{"content":"%s"}{"content":"%s"}' % (e, e),
    ])
    assert [tuple(r) for r in registry.run(spark, "q2", "memory", p).collect()] == [(e, 5)]


def test_event_with_integrity_counters(spark, write_posts):
    path = write_posts([post("2021-02-12T10:00:00Z", "a"), post("no date", ""), post(None, None, "x"), "broken"])
    rows, event = registry.run_logged(spark, "q1", "time", path, integrity=True)
    plain_rows, plain = registry.run_logged(spark, "q1", "time", path)
    metrics = event.first().metrics
    assert rows == plain_rows and "n_posts" not in plain.first().metrics
    assert (metrics["n_posts"], metrics["bad_dates"], metrics["null_dates"], metrics["empty_usernames"], metrics["total_dates"]) == (4, 1, 2, 1, 1)
