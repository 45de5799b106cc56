from pyspark.sql import functions as F

from conftest import post
from postscope.operators import aggregate as G
from postscope.plans import profiles as P


def test_posts_per_user_and_collisions(posts_df):
    df = posts_df([post(username="\uff35ser1"), post(username="user1"), post(username=""), post(username="b")])
    got = sorted((r.username, r.n) for r in P.posts_per_user(df).collect())
    assert got == [("b", 1), ("user1", 2)]
    r = P.handle_collisions(df).collect()[0]
    assert (r.n_raw, r.n_normalized, r.n_collisions) == (3, 2, 1)


def test_cutoff_ties(posts_df):
    rows = [post(username=f"u{i:02d}") for i in range(12)]
    r = P.cutoff_ties(posts_df(rows), 10).collect()[0]
    assert (r.cutoff_value, r.keys_at_cutoff, r.keys_at_cutoff_in_top, r.split_tie) == (1, 12, 10, True)


def test_activity_outliers(posts_df):
    rows = [post(username="bot")] * 50 + [post(username=f"u{i}") for i in range(100)]
    out = P.activity_outliers(posts_df(rows)).collect()
    assert out[0].username == "bot" and out[0].alert is True and len(out) == 5


def test_mention_discrepancy(posts_df):
    df = posts_df([
        post(content="hi @a", mentions=["a"], pid=1),
        post(content="hi @b", mentions=[], pid=2),
        post(content="hi", mentions=["c"], pid=3),
    ])
    r = P.mention_discrepancy(df).collect()[0]
    assert (r.n_hidden, r.n_fake, r.hidden_example_id, r.fake_example_id) == (1, 1, 3, 2)


def test_mention_structure_and_integrity(posts_df):
    df = posts_df([post(mentions=["a", None]), post(mentions="null"), post(date="bad", username="")])
    r = P.mention_structure(df).collect()[0]
    assert (r.n_posts, r.n_with_list, r.n_with_null_name) == (3, 1, 1)
    i = P.integrity_counters(df).collect()[0]
    assert (i.bad_dates, i.empty_usernames, i.null_users) == (1, 1, 2)
    observed, obs = P.observe_integrity(df)
    observed.count()
    assert obs.get["bad_dates"] == 1


def test_time_range(posts_df):
    df = posts_df([post("2020-12-31T23:00:00-05:00"), post("2021-03-01T00:00:00Z"), post("x")])
    r = P.time_range(df, 2021).collect()[0]
    assert (str(r.first_day), str(r.last_day), r.n_outside_year) == ("2021-01-01", "2021-03-01", 1)


def test_emoji_complexity(posts_df):
    df = posts_df([post(content="\u2708\ufe0f \u2708\ufe0f \U0001F600")])
    r = P.emoji_complexity(df, "grapheme").collect()
    assert (r[0].n, r[0].total_tokens, r[0].complex_tokens) == (2, 3, 2)


def test_top_n_per_group_uses_group_limit(posts_df, spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    out = G.top_n_per_group(df, "g", [F.col("v").desc()], 2)
    assert sorted((r.g, r.v) for r in out.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_value_at_rank_short(spark):
    df = spark.createDataFrame([("a", 3)], "key string, n bigint")
    assert G.value_at_rank(df, 10, "n", ["key"]).collect()[0].value is None


def test_reservoir_sample_exact_and_repeatable(spark):
    df = spark.range(10000).select(F.col("id"))
    a = [r.id for r in G.reservoir_sample(df, 150, seed=7).collect()]
    b = [r.id for r in G.reservoir_sample(df.repartition(13), 150, seed=7).collect()]
    c = [r.id for r in G.reservoir_sample(df, 150, seed=8).collect()]
    assert len(a) == 150 and len(set(a)) == 150 and sorted(a) == sorted(b) and set(a) != set(c)
    # roughly uniform: each half of the id range gets a fair share
    low = sum(1 for x in a if x < 5000)
    assert 45 < low < 105


def test_schema_drift(spark):
    from postscope.sources.posts import records_from_text

    lines = spark.createDataFrame(
        [('{"id": 1, "date": "2021-01-01", "user": {"id": 1, "username": "a"}}',),
         ('{"id": 2, "date": 5, "user": "str"}',)], "value string")
    got = {r.field: r.status for r in P.schema_drift(records_from_text(lines)).collect()}
    assert got == {"id": "ok", "date": "mixed", "content": "absent", "user": "mixed", "mentionedUsers": "absent"}
    one = spark.createDataFrame([('{"id": "x", "date": "d"}',)], "value string")
    got = {r.field: r.status for r in P.schema_drift(records_from_text(one)).collect()}
    assert got["id"] == "different" and got["date"] == "ok"


def test_everything_runs_on_empty_input(spark, posts_df):
    """Empty posts: every profile and question answers (no division or
    scalar-subquery error under ANSI mode)."""
    from pyspark.sql import functions as F

    from postscope.plans import questions as Q

    empty = posts_df([])
    records = empty.select("id", "content", F.parse_json(F.lit("{}")).alias("v"))
    outs = [
        P.truncation_profile(records), P.retweet_profile(records), P.mention_discrepancy(empty),
        P.posts_per_user(empty), P.handle_collisions(empty), P.activity_outliers(empty),
        P.cutoff_ties(empty), P.identity_consistency(empty), P.mention_structure(empty),
        P.emoji_complexity(empty), P.time_range(empty), P.integrity_counters(empty),
        P.key_column_profile(records), P.schema_drift(records),
        Q.top_days_top_user(empty), Q.top_days_top_user(empty, plan="two_scan"),
        Q.top_days_top_user_by_id(empty), Q.top_emojis(empty), Q.top_mentioned(empty, strict=True),
        Q.mode_parity(empty),
    ]
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    try:
        for df in outs:
            df.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    r = P.cutoff_ties(empty).collect()[0]
    assert r.cutoff_value is None and r.keys_at_cutoff == 0


def test_report(spark, posts_df):
    from postscope.sources.posts import records_from_text

    df = posts_df([post("2021-02-12T10:00:00Z", f"u{i % 3}", "hi \u2708\ufe0f", mentions=["a"], pid=i) for i in range(30)])
    lines = spark.createDataFrame([('{"id": 1, "truncated": true}',)], "value string")
    records = records_from_text(lines).select(F.lit(1).cast("long").alias("id"), F.lit("x").alias("content"), "v")
    rep = P.report(df, records, sample=20)
    assert len(rep) == 13
    for name, out in rep.items():
        out.collect()
    assert rep["integrity_counters"].collect()[0].n_posts == 20
