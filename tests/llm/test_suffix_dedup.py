"""Repeated byte strings against a count of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from postscope.llm import suffix_dedup
from postscope.llm.queries import op12_suffix_array_dedup
from postscope.llm.suffix_dedup import Settings, cut, merged, repeats, suffix_order

SF = "/root/testdata/sf0.001"
#: Every path on little data: texts in several blocks, groups of two pieces split.
SMALL = Settings(length=20, gram=6, group=1, classes=4, block=64, batch=16)


def brute(texts, length):
    """Per text: maximal removed (start, end) and the remaining bytes."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=np.int64)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        edge = np.flatnonzero(np.diff(gone.astype(int), prepend=0, append=0)).tolist()
        out.append((list(zip(edge[::2], edge[1::2])), bytes(np.frombuffer(t, dtype=np.uint8)[~gone])))
    return out


def rows(df):
    return [(r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in df.orderBy("doc_id").collect()]


def expected(texts, length):
    return [(len(t), spans, left) for t, (spans, left) in zip(texts, brute(texts, length))]


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    texts = [(r.text or "").encode() for r in docs]
    want = [(d.doc_id, len(t), sum(b - a for a, b in spans), len(spans), hashlib.sha256(left).hexdigest())
            for d, t, (spans, left) in zip(docs, texts, brute(texts, 200))]
    got = op12_suffix_array_dedup(spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert [tuple(r) for r in got.orderBy("doc_id").collect()] == want and sum(r[2] > 0 for r in want) > 10


def made(n, seed, letters="abcd"):
    rnd = random.Random(seed)
    shared = ["".join(rnd.choices("abcdefgh é", k=rnd.randrange(15, 60))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [rnd.choice(shared) if rnd.random() < 0.4 else "".join(rnd.choices(letters, k=rnd.randrange(1, 50))) for _ in range(rnd.randrange(6))]
        out.append("".join(parts))
    return out + out[:3] + ["a" * 300, "ab" * 150]


@pytest.mark.parametrize("rule", [SMALL, Settings(20, 6, 5, 1, 50, 8), Settings(20, 20, 1, 20, 100, 1), Settings(21, 1, 3, 7)])
def test_against_all_windows(spark, rule):
    texts = made(80, rule.gram)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert rows(suffix_dedup.find(df, settings=rule)) == expected([t.encode() for t in texts], rule.length)


def test_hot_passage_in_texts_of_their_own(spark):
    """One passage in every text, each time with other text around it: one group
    of very many pieces, which is split."""
    rnd = random.Random(4)
    passage = "".join(rnd.choices("klmnopqr", k=50))
    own = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randrange(30, 60)))
    texts = [own() + passage[: rnd.randrange(30, 51)] + own() for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = rows(suffix_dedup.find(df, settings=Settings(20, 6, 10, 4)))
    assert got == expected([t.encode() for t in texts], 20) and all(len(r[1]) == 1 for r in got)


def test_groups_stay_bounded(spark):
    """No group of more than ``group`` pieces reaches the suffix sort."""
    from postscope.llm.common import Scratch

    texts = made(150, 9)
    df = spark.createDataFrame([(k, t.encode()) for k, t in enumerate(texts)], "__row long, __data binary")
    found = suffix_dedup.pieces(df, SMALL)
    sizes = [r["count"] for r in found.groupBy("key").count().collect()]
    assert max(sizes) > 20
    seen = []
    original = suffix_dedup.sorted_groups
    try:
        suffix_dedup.sorted_groups = lambda f, s: (seen.append(max((r["count"] for r in f.groupBy("key").count().collect()), default=0)), original(f, s))[1]
        scratch = Scratch(spark, "test-suffix")
        suffix_dedup.repeated_spans(scratch.write(df), Settings(20, 6, 4, 4), scratch).count()
    finally:
        suffix_dedup.sorted_groups = original
    assert seen and seen[0] <= 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=5, max_size=40) | st.text("ab\0", min_size=5, max_size=60).map(str.encode), max_size=9), st.data())
def test_two_stage_sort(data, pick):
    n = np.array([pick.draw(st.integers(1, len(d) - 4)) for d in data], dtype=np.int64)
    windows = [d[i : i + 5] for d, m in zip(data, n) for i in range(m)]
    seen = Counter(windows)
    assert repeats(data, n, 5).tolist() == [seen[w] > 1 for w in windows]


def test_suffix_order_is_sorted():
    rnd = random.Random(6)
    text = bytes(rnd.choice(b"aab") for _ in range(3000))
    x = np.append(np.frombuffer(text, dtype=np.uint8).astype(np.uint16) + 1, 0).astype(np.uint16)
    wanted = np.arange(2950)
    order = np.argsort(suffix_order(x, wanted, 50))
    windows = [text[i : i + 50] for i in order]
    assert windows == sorted(windows)


def test_equal_windows_have_equal_anchors():
    rnd = random.Random(7)
    shared = bytes(rnd.choice(b"xyz") for _ in range(60))
    texts = [bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(40))) + shared + bytes(rnd.choice(b"abc") for _ in range(9)) for _ in range(9)]
    by_window = {}
    for t, at, n, anchor, key in zip(*(c.tolist() for c in cut(texts, SMALL))):
        for w in range(at, at + n):
            by_window.setdefault(texts[t][w : w + 20], set()).add((anchor - w, key))
    assert all(len(v) == 1 for v in by_window.values())
    assert sum(cut(texts, SMALL)[2]) == sum(len(t) - 19 for t in texts)


def test_merged():
    assert merged(np.array([9, 0, 3, 20]), np.array([12, 5, 9, 21])) == [(0, 12), (20, 21)]


def test_edges(spark):
    long = "".join(random.Random(1).choices("abcdefghij ", k=300_000))
    same = "one and the same passage, of two hundred bytes or more, " * 4
    data = [(1, None), (1, None), (2, ""), (3, "short"), (None, same), (None, same), (4, long + same[:210]), (5, long[1000:1300] + "é" * 99),
            (6, "x" * 199), (6, "x" * 199), (7, "y" * 200), (8, "z" * 201), (9, "é" * 120)]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("key", "piece", "at", "n", "count", "hot", "core")})
    out = suffix_dedup.find(docs, keep=("doc_id", "key", "n")).select("doc_id", "key", "n", *suffix_dedup.OWN)
    got = sorted(((r.doc_id or -1, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in out.collect()), key=str)
    texts = [(t or "").encode() for _, t in data]
    assert got == sorted(((d or -1, *e) for (d, _), e in zip(data, expected(texts, 200))), key=str)
    assert out.where("key <> 'key' or n <> 'n'").count() == 0
    assert suffix_dedup.find(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.find(docs.withColumn("kept", F.lit(1)), keep=("doc_id", "kept"))


def test_dedup_keeps_whole_characters(spark):
    unit = "aé" * 100 + "bcé" * 40
    docs = spark.createDataFrame([(1, "x" + unit + "è", 0), (2, "y" + unit + "ê", 0), (3, None, 7), (4, "lone", 4)], "doc_id long, text string, n_chars long")
    out = suffix_dedup.dedup(docs)
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} == {(1, "xè", 2), (2, "yê", 2), (3, None, 7), (4, "lone", 4)}
