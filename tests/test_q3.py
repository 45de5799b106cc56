from conftest import post
from postscope.plans.questions import top_mentioned


def got(df, **kw):
    return [(r.username, r.n) for r in top_mentioned(df, 10, **kw).collect()]


def test_counts_every_mention_and_folds_case(posts_df):
    df = posts_df([post(mentions=["Nadia", "OMAR", "nadia"]), post(mentions=["NADIA"]), post(mentions=["omar", "zoe"])])
    assert got(df) == [("nadia", 3), ("omar", 2), ("zoe", 1)]


def test_posts_without_names(posts_df):
    df = posts_df([post(mentions=[None, ""]), post(mentions=[]), post(mentions="null"), post()])
    assert got(df) == []


def test_equal_counts_in_name_order(posts_df):
    df = posts_df([post(mentions=["Wren", "abel"]), post(mentions=["mia"])])
    assert got(df) == [("abel", 1), ("mia", 1), ("wren", 1)]


def test_null_inside_list_v10(posts_df):
    df = posts_df([post(mentions=["X", None])])
    assert got(df) == [("x", 1)]
    assert got(df, strict=True) == []


def test_empty_name_alone_v11(posts_df):
    df = posts_df([post(mentions=[""])])
    assert got(df) == []
    assert got(df, strict=True) == [("", 1)]


def test_rank_k_tie_v9(posts_df):
    names = [f"n{i:02d}" for i in range(11)]
    df = posts_df([post(mentions=names)])
    assert [u for u, _ in got(df)] == names[:10]
