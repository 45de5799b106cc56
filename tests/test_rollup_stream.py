"""The rollup that a stream keeps up to date."""

import datetime as dt
import json
import os

from conftest import post
from postscope.plans import questions as Q
from postscope.sources.posts import scan_posts
from postscope.streaming import rollup as R


def _write(path, rows):
    with open(path, "w") as f:
        for r in rows:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def _run(spark, inp, table, files=1):
    q = R.start_rollup(spark, inp, table, files)
    q.awaitTermination(120)
    return sum(p["numInputRows"] > 0 for p in q.recentProgress)


def _counts(spark, table, **days):
    return sorted(((str(r.date), r.hour, r.author, r.n) for r in R.read_counts(spark, table, **days).collect()), key=str)


FILES = [
    [post("2024-01-01T10:00:00Z", "a"), post("2024-01-01T10:30:00Z", "a"), post("2024-01-01T23:30:00-02:00", "b"), "broken"],
    [post("2024-01-02T01:00:00Z", "b"), post("2024-01-02T02:00:00Z"), post("no date", "a")],
    [post("2024-01-01T10:59:59Z", "a"), post("2024-01-03T00:00:00Z", "c")],
]


def _staged(tmp_path, n=3):
    inp, table = str(tmp_path / "in"), str(tmp_path / "table")
    os.makedirs(f"{inp}/sub", exist_ok=True)
    for i, rows in enumerate(FILES[:n]):
        _write(f"{inp}/{'sub/' if i == 1 else ''}f{i}.json", rows)
    return inp, table


WANT = sorted([("2024-01-01", 10, "a", 3), ("2024-01-02", 1, "b", 2), ("2024-01-02", 2, None, 1), ("2024-01-03", 0, "c", 1)], key=str)


def test_batches_add_up_and_late_hours_merge(spark, tmp_path):
    inp, table = _staged(tmp_path, 2)
    assert _run(spark, inp, table) == 2
    assert ("2024-01-01", 10, "a", 2) in _counts(spark, table)
    assert _run(spark, inp, table) == 0  # nothing new
    _staged(tmp_path)  # the third file has posts of an hour counted before
    assert _run(spark, inp, table) == 1
    assert _counts(spark, table) == WANT
    assert _counts(spark, table, first=dt.date(2024, 1, 2), last=dt.date(2024, 1, 2)) == WANT[1:3]
    assert {r.batch for r in spark.read.parquet(table).select("batch").distinct().collect()} == {0, 1, 2}


def test_replayed_batch_changes_nothing(spark, tmp_path):
    inp, table = _staged(tmp_path)
    _run(spark, inp, table)
    before = _counts(spark, table)
    last = max((f for f in os.listdir(f"{table}/_checkpoint/commits") if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):  # as if the job had died after the write and before the commit
        if os.path.exists(f"{table}/_checkpoint/commits/{f}"):
            os.remove(f"{table}/_checkpoint/commits/{f}")
    assert _run(spark, inp, table) == 1
    assert _counts(spark, table) == before == WANT


def test_question_from_the_table_equals_that_from_the_posts(spark, tmp_path):
    inp, table = _staged(tmp_path)
    _run(spark, inp, table, 2)
    posts = scan_posts(spark, [f"{inp}/f0.json", f"{inp}/sub/f1.json", f"{inp}/f2.json"])
    for k in (1, 2, 10):
        assert R.top_days_top_user(spark, table, k).collect() == Q.top_days_top_user(posts, k).collect()
    one = R.top_days_top_user(spark, table, 10, dt.date(2024, 1, 3), dt.date(2024, 1, 3)).collect()
    assert [(str(r.date), r.top_user) for r in one] == [("2024-01-03", "c")]


def test_a_range_of_days_prunes_folders(spark, tmp_path):
    inp, table = _staged(tmp_path)
    _run(spark, inp, table, 5)
    plan = R.read_counts(spark, table, first=dt.date(2024, 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
