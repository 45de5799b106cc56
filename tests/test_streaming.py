import os
import tempfile

from conftest import post
from postscope.streaming.arrival import read_answers, start_file_arrival


def _write(path, rows):
    import json

    with open(path, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_two_files_then_rerun_then_third(spark, tmp_path):
    inp, out, ck = (str(tmp_path / x) for x in ("input", "output", "ck"))
    os.makedirs(inp)
    _write(f"{inp}/a.json", [post("2021-02-12T10:00:00Z", "x"), post("2021-02-12T11:00:00Z", "x")])
    _write(f"{inp}/b.json", [post("2021-03-01T10:00:00Z", "y")])
    q = start_file_arrival(spark, inp, out, ck)
    q.awaitTermination(120)
    got = sorted((r.source_name, str(r.date), r.top_user) for r in read_answers(spark, out).collect())
    assert got == [("a.json", "2021-02-12", "x"), ("b.json", "2021-03-01", "y")]
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2

    q2 = start_file_arrival(spark, inp, out, ck)
    q2.awaitTermination(120)
    assert all(p["numInputRows"] == 0 for p in q2.recentProgress)

    _write(f"{inp}/c.json", [post("2021-04-01T10:00:00Z", "z")])
    q3 = start_file_arrival(spark, inp, out, ck)
    q3.awaitTermination(120)
    assert sum(p["numInputRows"] for p in q3.recentProgress) == 1
    names = sorted({r.source_name for r in read_answers(spark, out).collect()})
    assert names == ["a.json", "b.json", "c.json"]


def test_sub_folders_and_empty_files(spark, tmp_path):
    inp, out, ck = (str(tmp_path / x) for x in ("in put", "output", "ck"))
    for d in ("a", "b"):
        os.makedirs(f"{inp}/{d}")
        _write(f"{inp}/{d}/x.json", [post("2021-02-12T10:00:00Z", f"user-{d}")])
    with open(f"{inp}/none.json", "w") as f:
        f.write("\n")
    _write(f"{inp}/nobody.json", [post("2021-02-12T10:00:00Z")])
    start_file_arrival(spark, inp, out, ck, max_files_per_trigger=3).awaitTermination()
    got = sorted((r.source_name, r.top_user) for r in read_answers(spark, out).collect())
    assert got == [("a/x.json", "user-a"), ("b/x.json", "user-b")]
    every = {r.source_name for r in read_answers(spark, out, empty=True).collect()}
    assert every == {"a/x.json", "b/x.json", "none.json", "nobody.json"}
