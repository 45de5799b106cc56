"""Importance resampling against a plain recomputation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postscope.llm import importance
from postscope.llm.importance import Settings
from postscope.llm.queries import op13_importance_resampling

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def brute(docs, target, s=Settings()):
    """doc_id, n_features, weight, score, rank of each (id, text)."""

    def found(text):
        w = WORD.findall((text or "").translate(UPPER))
        return len(w), [" ".join(w[i : i + n]) for n in range(1, s.longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % s.buckets
    raw, tgt = (Counter(bucket(f) for t in ts for f in found(t)[1]) for ts in ([t for _, t in docs], target))
    S, T = sum(raw.values()), sum(tgt.values())
    gain = [math.floor(1000 * math.log((tgt[b] + 1) * (S + s.buckets) / ((raw[b] + 1) * (T + s.buckets)))) for b in range(s.buckets)]
    rows = []
    for i, (doc_id, text) in enumerate(docs):
        n, fs = found(text)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{s.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, i))
    pool = sorted((r for r in rows if r[4] >= s.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {r[5]: k + 1 for k, r in enumerate(pool[: len(pool) * s.percent // 100])}
    return sorted(((*r[:4], rank.get(r[5])) for r in rows), key=str)


def made(n, seed=1):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Ünder", "ABC", "日本", "x1"]
    text = lambda: " ,".join(rnd.choices(words, k=rnd.randrange(0, 60)))
    return [(k, text()) for k in range(n)], [" ".join(rnd.choices(words[:10], k=30)) for _ in range(20)]


def frames(spark, docs, target):
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame([(t,) for t in target], "text string"))


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = op13_importance_resampling(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows(got) == brute(docs, target) and sum(r.rank is not None for r in got.collect()) > 5


@pytest.mark.parametrize("settings", [Settings(), Settings(buckets=7), Settings(longest=3, percent=33), Settings(percent=100, least_words=0), Settings(percent=0)])
def test_settings(spark, settings):
    docs, target = made(300)
    assert rows(importance.resample(*frames(spark, docs, target), settings)) == brute(docs, target, settings)


def test_ties_by_id(spark):
    """With one bucket all weights are equal, and repeated ids have equal scores."""
    docs = [(k % 40 if k % 3 else None, "a b c d " * 6) for k in range(400)]
    s = Settings(buckets=1, percent=50)
    got = importance.resample(*frames(spark, docs, ["a b"]), s)
    assert rows(got) == brute(docs, ["a b"], s)
    assert sorted(r.rank for r in got.where("rank is not null").collect()) == list(range(1, 201))


def test_bracket_widens(spark):
    """A sketch that is far off still gives a valid bracket, by exact counts."""
    rnd = random.Random(2)
    scores = [(int(rnd.paretovariate(0.5)),) for _ in range(5000)]
    df = spark.createDataFrame(scores, "score long")
    ordered = sorted((s for s, in scores), reverse=True)
    for accuracy in (1, 3, 1000):
        for k in (1, 17, 500, 4999, 5000):
            low, high, above = importance.bracket(df, 5000, k, accuracy)
            assert low <= ordered[k - 1] <= high and above == sum(s > high for s in ordered) < k


def test_rank_spreads_over_ranges(spark):
    """Equal scores and ids (half of all rows) don't meet in one range."""
    from postscope.llm.common import Scratch

    df = spark.range(8000).select(F.lit(5).alias("score"), F.when(F.col("id") < 4000, F.col("id")).alias("doc_id"), F.col("id").alias("__row"))
    out = importance.ranked(df, Scratch(spark, "test-rank"))
    assert [r.rank for r in out.orderBy(F.col("doc_id").asc_nulls_last(), "__row").collect()] == list(range(1, 8001))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 4000


def test_edges(spark):
    long = "the quick brown fox " * 50_000
    data = [(1, None), (1, None), (2, ""), (None, "a few words " * 9), (None, None), (3, "!!! --"), (4, long), (5, "x" * 200_000)]
    docs, target = frames(spark, data, ["quick fox", None, ""])
    clash = docs.withColumns({c: F.lit(c) for c in ("bucket", "n", "part", "count", "gain", "h")})
    for t in (target, target.limit(0)):
        out = importance.resample(clash, t, Settings(percent=50))
        assert out.columns == [*clash.columns, "n_features", "weight", "score", "rank"]
        assert rows(out) == brute(data, [r.text for r in t.collect()], Settings(percent=50)) and out.where("h <> 'h'").count() == 0
    assert importance.resample(clash.limit(0), target).count() == 0
    with pytest.raises(ValueError):
        importance.resample(docs.withColumn("rank", F.lit(1)), target)


def test_draws_the_target_kind(spark):
    docs, _ = made(400)
    kind = [(1000 + k, " ".join(random.Random(k).choices(["alpha", "beta", "gamma"], k=40))) for k in range(40)]
    got = importance.resample(*frames(spark, docs + kind, ["alpha beta gamma"] * 50)).where("rank is not null")
    drawn = [r.doc_id for r in got.collect()]
    assert len(drawn) > 20 and np.mean([d >= 1000 for d in drawn]) > 4 * 40 / 440
