import datetime as dt

import pytest

from conftest import post
from postscope.plans.questions import day_summaries, top_days_top_user, top_days_top_user_by_id

D = dt.date
PLANS = ["one_scan", "two_scan"]


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("plan", PLANS)
def test_busiest_author_of_each_day(posts_df, plan):
    june = [("2022-06-01", "kim"), ("2022-06-01", "lee"), ("2022-06-01", "lee"), ("2022-06-03", "kim"), ("2022-06-03", "ida")]
    df = posts_df([post(f"{d}T0{i}:15:00+00:00", a) for i, (d, a) in enumerate(june)])
    # 1 June has three posts, 3 June two with a tie that the smaller name wins
    assert rows(top_days_top_user(df, 10, plan=plan)) == [(D(2022, 6, 1), "lee"), (D(2022, 6, 3), "ida")]
    assert rows(top_days_top_user(df, 1, plan=plan)) == [(D(2022, 6, 1), "lee")]


@pytest.mark.parametrize("plan", PLANS)
def test_empty(posts_df, plan):
    assert rows(top_days_top_user(posts_df([]), 10, plan=plan)) == []


def test_utc_day_change_v1(posts_df):
    df = posts_df([post("2021-02-12T23:59:59-05:00", "u")])
    assert rows(top_days_top_user(df)) == [(D(2021, 2, 13), "u")]
    assert rows(top_days_top_user(df, day_mode="prefix")) == [(D(2021, 2, 12), "u")]
    df0 = posts_df([post("2021-02-12T23:59:59+00:00", "u")])
    assert rows(top_days_top_user(df0)) == rows(top_days_top_user(df0, day_mode="prefix")) == [(D(2021, 2, 12), "u")]


def test_bad_dates_dropped_v2(posts_df):
    df = posts_df([post("bad", "a"), post("2021-02-12", "a"), post(None, "a"), post("2021-02-14T00:00:00Z", "b")])
    assert rows(top_days_top_user(df)) == [(D(2021, 2, 14), "b")]


def test_nameless_posts_select_days_v3(posts_df):
    a, b = "2021-02-10T10:00:00+00:00", "2021-02-11T10:00:00+00:00"
    df = posts_df([post(a, "x"), post(a), post(a, uid=5), post(b, "y"), post(b, "z")])
    assert rows(top_days_top_user(df, 1)) == [(D(2021, 2, 10), "x")]
    assert rows(top_days_top_user(df, 1, strict=True)) == [(D(2021, 2, 11), "y")]
    # V4: output order is by the named total: day B (2 named) before day A (1)
    assert rows(top_days_top_user(df, 2)) == [(D(2021, 2, 11), "y"), (D(2021, 2, 10), "x")]


def test_day_tie_latest_first_v5(posts_df):
    df = posts_df([post(f"2021-03-{d:02d}T10:00:00+00:00", "u") for d in range(1, 12)])
    got = [r[0] for r in rows(top_days_top_user(df, 10))]
    assert got == [D(2021, 3, d) for d in range(11, 1, -1)]


def test_nameless_day_has_no_row_v7(posts_df):
    a, b = "2021-02-10T10:00:00+00:00", "2021-02-11T10:00:00+00:00"
    df = posts_df([post(a), post(a), post(b, "y")])
    assert rows(top_days_top_user(df, 10)) == [(D(2021, 2, 11), "y")]


@pytest.mark.parametrize("n", [1, 7, 64])
def test_repartition_invariant(posts_df, n):
    base = [post(f"2021-03-{(i % 13) + 1:02d}T{i % 24:02d}:00:00+00:00", f"u{i % 7}") for i in range(300)]
    df = posts_df(base)
    assert rows(top_days_top_user(df.repartition(n))) == rows(top_days_top_user(df))
    assert rows(top_days_top_user(df.repartition(n), plan="two_scan")) == rows(top_days_top_user(df))


def test_by_id_uses_latest_name(posts_df):
    df = posts_df([
        post("2021-02-12T10:00:00+00:00", "old", uid=1, pid=1),
        post("2021-02-12T11:00:00+00:00", "new", uid=1, pid=2),
        post("2021-02-12T12:00:00+00:00", "other", uid=2, pid=3),
    ])
    assert rows(top_days_top_user_by_id(df)) == [(D(2021, 2, 12), 1, "new")]
    # by raw name, the renamed author splits in two and loses the tie
    assert rows(top_days_top_user(df)) == [(D(2021, 2, 12), "new")]


def test_summaries_columns(posts_df):
    df = posts_df([post("2021-02-12T10:00:00+00:00", "a"), post("2021-02-12T10:00:00+00:00")])
    r = day_summaries(df).collect()[0]
    assert (r.total, r.day_total_tweets, r.top_author) == (2, 1, "a")
