from conftest import post
from postscope.plans import ingest as I
from postscope.plans import questions as Q
from postscope.sources.posts import scan_posts


def _rows():
    rows = []
    for i in range(400):
        d = (i * 7) % 19 + 1
        name = None if i % 13 == 0 else f"u{(i * 3) % 11}"
        rows.append(post(f"2021-03-{d:02d}T{i % 24:02d}:30:00-05:00", name, "hi \u2708\ufe0f",
                         mentions=[f"M{i % 5}"], pid=i))
    rows += ['{"date": "2021-03-01T', "[1]", post("no date", "x", pid=999)]
    return rows


def test_ingest_then_q1_matches_direct(spark, write_posts, tmp_path):
    src = write_posts(_rows())
    dest = str(tmp_path / "ingested")
    obs = I.ingest_posts(spark, src, dest)
    m = obs.get
    assert (m["lines"], m["rejected"], m["without_day"]) == (403, 2, 1)
    direct = [tuple(r) for r in Q.top_days_top_user(scan_posts(spark, src), 10).collect()]
    pruned_df = I.top_days_top_user_ingested(spark, dest, 10)
    assert [tuple(r) for r in pruned_df.collect()] == direct
    plan = pruned_df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert I.read_dead_letters(spark, dest).count() == 2


def test_other_questions_read_ingested(spark, write_posts, tmp_path):
    src = write_posts(_rows())
    dest = str(tmp_path / "ingested")
    I.ingest_posts(spark, src, dest)
    posts = I.read_ingested(spark, dest)
    assert Q.top_emojis(posts).collect() == Q.top_emojis(scan_posts(spark, src)).collect()
    assert Q.top_mentioned(posts).collect() == Q.top_mentioned(scan_posts(spark, src)).collect()


def test_salted_layout_same_answer(spark, write_posts, tmp_path):
    src = write_posts(_rows())
    dest = str(tmp_path / "salted")
    I.ingest_posts(spark, src, dest, files_per_day=3)
    direct = Q.top_days_top_user(scan_posts(spark, src), 10).collect()
    assert I.top_days_top_user_ingested(spark, dest, 10).collect() == direct


def test_ingest_exact_types(spark, write_posts, tmp_path):
    src = write_posts([post("2021-03-01T10:00:00Z", "a"), '{"date": 5, "user": {"username": "b"}}'])
    dest = str(tmp_path / "exact")
    obs = I.ingest_posts(spark, src, dest)
    assert obs.get["rejected"] == 1
    assert [r.reject_reason for r in I.read_dead_letters(spark, dest).collect()] == ["wrong_type"]
