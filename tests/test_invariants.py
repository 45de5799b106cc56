"""Invariants from the survey's test plan (section 5)."""

import pytest
from pyspark.sql import functions as F

from conftest import post
from postscope.operators.extract import emoji_tokens, mentions_from_metadata
from postscope.plans import questions as Q
from postscope.sources import posts as S

TEXTS = ["a \u2708\ufe0f b \u2764\ufe0f\u2764\ufe0f", "\U0001F468\u200d\U0001F469\u200d\U0001F467", "plain", "\U0001F1EE\U0001F1F3 \U0001F64F\U0001F3FB"]


def _posts(posts_df):
    rows = []
    for i in range(60):
        rows.append(post(f"2021-02-{(i % 9) + 1:02d}T{i % 24:02d}:00:00+00:00", f"u{i % 5}",
                         TEXTS[i % len(TEXTS)], mentions=[f"M{i % 3}", f"m{i % 4}"], pid=i))
    return posts_df(rows)


@pytest.mark.parametrize("definition", ["property", "range", "simple", "run", "grapheme"])
def test_sum_of_counts_equals_tokens(posts_df, definition):
    df = _posts(posts_df)
    total = Q.emoji_counts(df, definition).agg(F.sum("n")).collect()[0][0] or 0
    assert total == emoji_tokens(df, definition).count()


def test_sum_of_mention_counts_equals_exploded(posts_df):
    df = _posts(posts_df)
    assert Q.mention_counts(df).agg(F.sum("n")).collect()[0][0] == mentions_from_metadata(df).count()


def test_strict_equals_default_on_clean_data(posts_df):
    df = _posts(posts_df)
    assert Q.mode_parity(df).count() == 0
    assert Q.top_mentioned(df).collect() == Q.top_mentioned(df, strict=True).collect()


@pytest.mark.parametrize("n", [1, 7, 64])
def test_q2_q3_repartition_invariant(posts_df, n):
    df = _posts(posts_df)
    assert Q.top_emojis(df.repartition(n)).collect() == Q.top_emojis(df).collect()
    assert Q.top_mentioned(df.repartition(n)).collect() == Q.top_mentioned(df).collect()


def test_steps_chain_with_transform(posts_df):
    df = _posts(posts_df)
    out = df.transform(emoji_tokens, "range").transform(lambda t: t.groupBy("emoji").count())
    assert out.count() > 0


def test_lines_partitioned_and_result_writer(spark, write_posts, tmp_path):
    p = write_posts([post("2021-02-12T10:00:00Z", f"u{i}") for i in range(20)])
    assert S.scan_lines_partitioned(spark, p, 5).rdd.getNumPartitions() == 5
    out = str(tmp_path / "result")
    S.write_result_json(Q.top_days_top_user(S.scan_posts(spark, p)), out)
    back = spark.read.json(out).collect()
    assert len(back) == 1 and back[0].top_user == "u0"
