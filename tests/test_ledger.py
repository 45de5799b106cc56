"""T1 with a ledger: changed files, unreadable files, replays."""

import json
import os

import pytest
from conftest import post
from postscope.streaming import ledger as L


def _write(path, rows, at):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    os.utime(path, (at, at))


def _results(spark, out):
    return sorted((r.source_name, r.error is not None, r.top_user) for r in L.read_results(spark, out).collect())


@pytest.fixture
def folders(tmp_path):
    inp, out = str(tmp_path / "in put"), str(tmp_path / "out")
    _write(f"{inp}/a.json", [post("2021-02-12T10:00:00Z", "x")], 1_000_000)
    _write(f"{inp}/sub/a.json", [post("2021-02-13T10:00:00Z", "y")], 1_000_100)
    return inp, out


def test_new_changed_and_unchanged_files(spark, folders):
    inp, out = folders
    assert L.answer_arrivals(spark, inp, out, max_files=1) == (2, 0)
    assert _results(spark, out) == [("a.json", False, "x"), ("sub/a.json", False, "y")]
    assert L.answer_arrivals(spark, inp, out) == (0, 0)
    _write(f"{inp}/a.json", [post("2021-02-12T10:00:00Z", "changed")], 2_000_000)
    _write(f"{inp}/b.json", [], 2_000_000)
    with open(f"{inp}/b.json", "w") as f:
        f.write("\n")
    assert L.answer_arrivals(spark, inp, out) == (2, 0)
    assert _results(spark, out) == [("a.json", False, "changed"), ("b.json", False, None), ("sub/a.json", False, "y")]
    versions = [(r.source_name, r.length) for r in L.read_ledger(spark, out).collect()]
    assert len(versions) == 4 and len({n for n, _ in versions}) == 3
    # the same length, another time
    _write(f"{inp}/a.json", [post("2021-02-12T10:00:00Z", "CHANGED")], 3_000_000)
    assert L.answer_arrivals(spark, inp, out) == (1, 0)
    assert _results(spark, out)[0] == ("a.json", False, "CHANGED")


def test_unreadable_file_gets_an_error_row(spark, folders):
    inp, out = folders
    with open(f"{inp}/bad.json.gz", "wb") as f:
        f.write(b"no gzip")
    assert L.answer_arrivals(spark, inp, out) == (2, 1)
    assert _results(spark, out) == [("a.json", False, "x"), ("bad.json.gz", True, None), ("sub/a.json", False, "y")]
    assert L.answer_arrivals(spark, inp, out) == (0, 0)  # not tried again as it is
    errors = [r.error for r in L.read_ledger(spark, out).collect() if r.source_name == "bad.json.gz"]
    assert len(errors) == 1 and "bad.json.gz" in errors[0]
    import gzip

    with gzip.open(f"{inp}/bad.json.gz", "wt") as f:
        f.write(json.dumps(post("2021-02-14T10:00:00Z", "z")) + "\n")
    assert L.answer_arrivals(spark, inp, out) == (1, 0)
    assert ("bad.json.gz", False, "z") in _results(spark, out)


def test_run_that_died_before_the_ledger(spark, folders):
    inp, out = folders
    L.answer_arrivals(spark, inp, out)
    before = _results(spark, out)
    for f in os.listdir(f"{out}/_ledger"):
        os.remove(f"{out}/_ledger/{f}")
    assert L.read_ledger(spark, out).count() == 0
    assert L.answer_arrivals(spark, inp, out) == (2, 0) and _results(spark, out) == before


def test_other_failures_are_raised(spark, folders, monkeypatch):
    from pyspark.errors import PySparkException

    def fail(*_):
        raise PySparkException("the output can't be written")

    inp, out = folders
    monkeypatch.setattr(L, "_answer", fail)
    with pytest.raises(PySparkException):
        L.answer_arrivals(spark, inp, out)
    assert L.read_ledger(spark, out).count() == 0
