"""Periodic runs against a brute force over all lags and starts."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from postscope.llm import periodic_runs
from postscope.llm.periodic_runs import Settings, lag_scan, runs_of, segments
from postscope.llm.queries import op11_periodic_runs, planted_repeats

SF = "/root/testdata/sf0.001"
BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in BLANKS.split(text or "") if w]


def brute(words, shortest=24, times=3):
    """All maximal stretches of every lag; of equal stretches the smallest lag."""
    out = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, times * q):
                out.setdefault((i, j + q - i), q)
            i = max(i + 1, j)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def edit(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    words = edit(doc_id, words_of(text))
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_matches_brute_force(spark):
    """The texts of fewer than 1,500 words: the brute force takes square time."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in op11_periodic_runs(spark, SF).collect()}
    short = [d for d in docs if len(words_of(d.text)) < 1500]
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    assert [got[d.doc_id] for d in short] == [expected(d.doc_id, d.text) for d in short]
    assert sum(got[d.doc_id][1] for d in short) > 10


def test_planted_repeats(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = planted_repeats(docs).join(docs.select("doc_id", F.col("text").alias("whole")), "doc_id").collect()
    assert all(words_of(r.text) == edit(r.doc_id, words_of(r.whole)) for r in rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(b"ab"), min_size=1, max_size=7), st.integers(1, 60)), max_size=8), st.sampled_from([3, 4]),
       st.sampled_from([1, 6, 24]))
def test_any_words(pieces, times, shortest):
    words = [bytes([c]) for unit, n in pieces for c in (unit * n)[:n]]
    rule = Settings(shortest, times)
    assert runs_of([words, words[::-1]], rule) == [brute(words, shortest, times), brute(words[::-1], shortest, times)]


def test_splitting_leaves_every_run():
    rnd, rule = random.Random(3), Settings()
    rows = [[rnd.choice("abcdefghijklmnopqrstuvwxyz") * rnd.randrange(1, 4) for _ in range(rnd.randrange(400))] for _ in range(40)]
    for row in rows[::2]:
        at, q = rnd.randrange(len(row) + 1), rnd.randrange(1, 40)
        row[at:at] = ([rnd.choice("xyz") + str(i) for i in range(q)] * 40)[: max(24, 3 * q) + rnd.randrange(9)]
    rows = [[w.encode() for w in row] for row in rows]
    assert runs_of(rows, rule) == [brute(r) for r in rows]


def test_no_segment_holds_a_rare_word():
    import numpy as np

    rnd = random.Random(8)
    words = np.abs(np.array([rnd.randrange(1 + i % 60) * (i % 1000 > 200) - i * (i % 100 == 0) for i in range(6000)]))
    found = segments(words, np.repeat([0, 1], 3000), Settings())
    assert found and all(np.bincount(words[a:b])[words[a:b]].min() >= 3 and b - a >= 24 and not a < 3000 < b for a, b in found)


def test_long_runs_take_no_square_time():
    import numpy as np

    assert lag_scan(np.zeros(300_000, dtype=np.int64), Settings()) == [(0, 300_000, 1)]
    assert lag_scan(np.arange(300_000) % 5000, Settings()) == [(0, 300_000, 5000)]


def test_edges(spark):
    run = "x y " * 12
    rows = [(1, None, "a"), (1, None, "a"), (2, "", "b"), (None, run, None), (3, run * 5000, "c"), (4, " \t\n" + run + " z", "d"),
            (5, "x y " * 11 + "x", "e"), (6, " ".join(["w"] * 40), "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {c: F.lit(c) for c in ("start", "length", "period", "place", "hits", "__text")})
    out = {r.doc_id: r for r in periodic_runs.find(docs, keep=("doc_id", "start", "lang")).collect()}
    as_runs = lambda r: [tuple(x) for x in r.runs]
    assert as_runs(out[1]) == as_runs(out[2]) == as_runs(out[5]) == as_runs(out[6]) == [] and out[1].collapsed == out[2].collapsed == ""
    assert as_runs(out[None]) == as_runs(out[4]) == [(0, 24, 2)] and out[None].collapsed == "x y" and out[4].collapsed == "x y  z"
    assert as_runs(out[3]) == [(0, 120_000, 2)] and out[3].start == "start" and out[6].n_words == 1
    cut = periodic_runs.collapse(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert {(r.doc_id, r.text) for r in cut.collect()} >= {(1, None), (3, "x y"), (5, "x y " * 11 + "x")}
    assert periodic_runs.find(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find(docs.withColumn("runs", F.lit(1)), keep=("doc_id", "runs"))
    with pytest.raises(ValueError):
        Settings(6, 2)


def test_strongest(spark):
    rows = [([(0, 30, 10), (2, 24, 4), (9, 36, 6), (40, 60, 10)],), ([],)]
    df = spark.createDataFrame(rows, "runs array<struct<start:long,length:long,period:long>>")
    assert [r[0] and tuple(r[0]) for r in df.select(periodic_runs.strongest(F.col("runs"))).collect()] == [(2, 24, 4), None]
