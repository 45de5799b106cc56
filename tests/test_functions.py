import datetime as dt

from pyspark.sql import functions as F

from postscope.functions import days, handles, text


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr(F.col("x")).alias("r")).collect()[0].r


def test_days(spark):
    assert one(spark, days.post_day_utc, "2021-02-12T23:59:59-05:00") == dt.date(2021, 2, 13)
    assert one(spark, days.post_day_utc, "2021-02-12T10:00:00Z") == dt.date(2021, 2, 12)
    assert one(spark, days.post_day_utc, "2021-02-12T10:00:00+0530") == dt.date(2021, 2, 12)
    assert one(spark, days.post_day_utc, "2021-02-12") is None
    assert one(spark, days.post_day_utc, "garbage") is None
    assert one(spark, days.post_day_prefix, "2021-02-12T23:59:59-05:00") == dt.date(2021, 2, 12)


def test_day_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, days.post_day_utc, "2021-02-12T23:59:59-05:00") == dt.date(2021, 2, 13)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_nfkc_h3(spark):
    decomposed, composed = "Pen\u0303a", "Pe\u00f1a"
    a = one(spark, handles.normalize_handle, decomposed)
    b = one(spark, handles.normalize_handle, composed)
    assert a == b == "pe\u00f1a"
    assert one(spark, handles.normalize_handle, "\ufb01") == "fi"
    assert one(spark, handles.normalize_handle, "\uff35SER") == "user"
    assert one(spark, handles.normalize_handle, None) is None


def test_text_predicates(spark):
    assert one(spark, text.ends_with_ellipsis, "cut here\u2026 \n\t") is True
    assert one(spark, text.ends_with_ellipsis, "no\u2026 end") is False
    assert one(spark, text.is_retweet_text, "RT @x: hi") is True
    assert one(spark, text.outside_year, "bad") is True
    assert one(spark, text.outside_year, "2021-05-05T00:00:00Z") is False
    assert one(spark, text.mentions_in_text, "@se\u00f1or hi @se\u00f1or @b_1") == ["se\u00f1or", "b_1"]
    assert one(spark, text.is_complex_token, "\u2708\ufe0f") is True
    assert one(spark, text.is_complex_token, "\u2708") is False


def test_emoji_patterns_compile(spark):
    from postscope.functions import emoji as E

    df = spark.createDataFrame([("x",)], "c string")
    for name in E.DEFINITIONS:
        df.select(F.regexp_extract_all("c", F.lit(E.pattern(name)), 0)).collect()


def test_cluster_conf_scales_with_input():
    from postscope.session import cluster_conf

    small = cluster_conf(400 << 20, 8)
    big = cluster_conf(100 << 40, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(big["spark.sql.shuffle.partitions"]) > 40000
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_strip_and_year(spark):
    assert one(spark, text.strip_ws, " \t\u3000 hi there \n\u00a0") == "hi there"
    assert one(spark, days.year_of, "2020-12-31T23:00:00-05:00") == 2021
    assert one(spark, days.year_of, "nope") is None


def test_queries_see_files_added_later(spark, tmp_path):
    from postscope.plans import catalog

    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for n in (50, 100):
        rows.limit(50).write.mode("append").parquet(str(tmp_path / "events.parquet"))
        assert catalog.QUERIES["integrity_counters"](spark, str(tmp_path)).first().n_posts == n
