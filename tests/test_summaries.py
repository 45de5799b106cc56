"""Stored sketches (A12, A16, A17): merging, error bounds, days replaced."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postscope.operators import approx as X
from postscope.plans import summaries as S


def _posts(spark, rows):
    return spark.createDataFrame(rows, "date string, content string, username string").select(
        "date", "content", F.when(F.col("username").isNotNull(), F.struct(F.lit(1).cast("long").alias("id"), "username")).alias("user"))


def _made(n, seed=1):
    rnd = random.Random(seed)
    return [(f"2024-01-{rnd.randrange(1, 11):02d}T10:00:00Z" if rnd.random() < 0.95 else "no date", "x" * rnd.randrange(200) if rnd.random() < 0.9 else None,
             f"u{min(int(rnd.paretovariate(0.7)), 3000)}" if rnd.random() < 0.9 else None) for _ in range(n)]


def test_summaries_answer_any_range(spark, tmp_path):
    rows, path = _made(4000), str(tmp_path / "days")
    S.write_by_day(S.daily_summaries(_posts(spark, rows)), path)
    assert S.read_days(spark, path).count() == 10
    import datetime as dt

    some = S.read_days(spark, path, dt.date(2024, 1, 3), dt.date(2024, 1, 6))
    assert "PartitionFilters: [isnotnull(date" in some._jdf.queryExecution().toString()
    names = [u for d, _, u in rows if "2024-01-03" <= d[:10] <= "2024-01-06" and u]
    exact = Counter(names)
    assert abs(some.agg(S.distinct_users().alias("n")).first().n - len(exact)) <= 5 * S.Settings().distinct_error * len(exact)
    top = [(r.username, r.n) for r in S.top_authors(some, 5).collect()]
    assert top == sorted(exact.items(), key=lambda x: (-x[1], x[0]))[:5]
    lengths = sorted(len(c) for d, c, _ in rows if "2024-01-03" <= d[:10] <= "2024-01-06" and c is not None)
    for q, est in zip((0.5, 0.9, 0.99), some.agg(S.length_quantiles().alias("q")).first().q):
        assert sum(x < est for x in lengths) / len(lengths) <= q + 0.03 and sum(x <= est for x in lengths) / len(lengths) >= q - 0.03


def test_rewriting_days_replaces_them_only(spark, tmp_path):
    path = str(tmp_path / "days")
    build = lambda rows: S.write_by_day(S.daily_summaries(_posts(spark, rows)), path)
    build([("2024-01-01T00:00:00Z", "a", "x"), ("2024-01-02T00:00:00Z", "b", "y")])
    build([("2024-01-02T00:00:00Z", "b", "y"), ("2024-01-02T01:00:00Z", "b", "z")])
    rows = {str(r.date): (r.n, r.users) for r in S.read_days(spark, path).groupBy("date").agg(F.sum("n").alias("n"), S.distinct_users().alias("users")).collect()}
    assert rows == {"2024-01-01": (1, 1), "2024-01-02": (2, 2)}


def test_heavy_hitters_beyond_capacity_keep_their_bound(spark):
    """Far more names than counters: counts are estimates within the bound."""
    rnd, items = random.Random(4), 100
    names = [f"n{min(int(rnd.paretovariate(0.6)), 5000)}" for _ in range(20000)]
    df = spark.createDataFrame([(i % 7, u) for i, u in enumerate(names)], "day int, u string").repartition(5)
    states = df.groupBy("day").agg(X.top_k_state("u", items).alias("s"), F.count("u").alias("n"))
    bound = states.agg(X.top_k_error(F.sum("n"), items).alias("b")).first().b
    assert bound == -(-20000 * 7 // (2 * 256))
    exact = Counter(names)
    top = X.top_k_of_states(states, "s", 5, items, name="u").collect()
    assert top[0].u == exact.most_common(1)[0][0] and all(abs(r.n - exact[r.u]) <= bound for r in top)
    per_day = X.top_k_of_states(states, "s", 2, items, ["day"], "u")
    assert per_day.count() == 14


def test_count_min(spark):
    rows = [(f"2024-01-0{1 + i % 3}", f"k{i % 500}" if i % 5 else "hot", 1 + i % 4) for i in range(5000)] + [("2024-01-01", None, 9)]
    counts = spark.createDataFrame(rows, "day string, key string, n long")
    eps, delta = 0.01, 0.02
    width, depth = X.count_min_shape(eps, delta)
    table = X.count_min_table(counts, "key", ["day"], eps, delta)
    assert table.count() <= 3 * width * depth and depth == 4
    exact = counts.where("key is not null").groupBy("key").agg(F.sum("n").alias("n"))
    total = exact.agg(F.sum("n")).first()[0]
    found = X.count_min_lookup(exact, "key", table, eps, delta).collect()
    assert len(found) == exact.count() and all(r.estimate >= r.n for r in found)
    assert sum(r.estimate > r.n + eps * total for r in found) <= delta * len(found)
    absent = X.count_min_lookup(spark.createDataFrame([("nobody",)], "key string"), "key", table.limit(0), eps, delta).collect()
    assert [(r.key, r.estimate) for r in absent] == [("nobody", 0)]


def test_no_posts(spark, tmp_path):
    none = _posts(spark, [("no date", "x", "u")])
    assert S.daily_summaries(none).count() == 0 and S.daily_count_min(none).count() == 0
    lone = S.daily_summaries(_posts(spark, [("2024-01-01T00:00:00Z", None, None)]))
    assert lone.agg(S.length_quantiles().alias("q"), S.distinct_users().alias("n")).first()[:] == (None, 0)
    assert S.top_authors(lone).count() == 0


def test_hot_day_is_combined_before_the_shuffle(spark):
    plan = S.daily_summaries(_posts(spark, _made(50)))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_hll_sketch_agg") > plan.index("Exchange") and plan.count("Exchange") == 1


@pytest.mark.parametrize("max_items, counters", [(10000, 16384), (100_000, 262144), (12, 16), (13, 32)])
def test_error_bound(spark, max_items, counters):
    assert spark.range(1).select(X.top_k_error(F.lit(counters * 2), max_items)).first()[0] == 7
