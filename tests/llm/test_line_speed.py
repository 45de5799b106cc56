"""Line dedup: what is left to Spark, what leaves the tasks, tests of many lines at once."""

import random

import numpy as np
from pyspark.sql import functions as F

from postscope.llm import clusters
from postscope.llm import line_dedup as L
from postscope.llm.common import Scratch


def test_occurrences_match_the_python_rules(spark):
    odd = ["", None, "a", " \t a b \x0b\f\r\n\r\n   x　 \n\t\r \n \x1fq\x1f \n\u0085z\U0001f600\t\n a\t", "\n\n", " " * 9, "é" * 100 + " \r", "x\x00y \n\x00"]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    rows = docs.select(F.col("doc_id").alias("__id"), F.xxhash64("doc_id", "text").alias("__rid"), F.col("text").alias("__text"))
    found = L.occurrences(rows)
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()  # no Python worker
    want = sorted((r[1], i, L.line_hash(s)) for r in rows.collect() for i, s in L.lines_of(r[2] or ""))
    assert sorted((r.rid, r.line, r.node) for r in found.collect()) == want


def test_many_at_once_match_the_test_of_one():
    rng, s = random.Random(12), L.Settings()
    a = ["".join(rng.choice("abé\U0001f600 ") for _ in range(rng.randrange(5, 90))) for _ in range(100)]
    lines = a + [x if i % 5 == 0 else x[: rng.randrange(5, len(x) + 1)] + "z" * (i % 3) for i, x in enumerate(a)]
    one, many = L.test(s)({"s": lines, "mark": [0] * 200}), L.many(s)({"s": lines})
    for x in range(200):
        rest = np.array([y for y in range(200) if y != x])
        assert many(x, rest).tolist() == [one(x, int(y)) for y in rest]


def test_local_links_with_many_connect_the_same():
    rng = np.random.default_rng(5)
    keys = [rng.integers(0, 60, 3) for _ in range(300)]
    value = rng.integers(0, 200, 300)

    def roots(links):
        root = list(range(300))
        for x, y in links:
            root = [min(root[x], root[y]) if r in (root[x], root[y]) else r for r in root]
        return root

    one = clusters.local_links(keys, lambda x, y: abs(value[x] - value[y]) <= 3, np.arange(300))
    many = clusters.local_links(keys, None, np.arange(300), many=lambda x, rest: abs(value[x] - value[rest]) <= 3)
    assert len(one) > 50 and roots(one) == roots(many) and len(one) == len(many)


def test_unwanted_lines_stay_in_their_task(spark):
    rows = spark.createDataFrame([(f"line {i:04d}\nother line {i:04d}",) for i in range(2000)], "__text string")
    wanted = [L.line_hash(f"line {i:04d}") for i in range(0, 2000, 20)]
    nodes = spark.createDataFrame([(x,) for x in wanted], "node long")
    bits = L.sketch(nodes)
    assert L.may_hold(bits, np.array(wanted, dtype=np.int64)).all()
    others = np.array([L.line_hash(f"other line {i:04d}") for i in range(2000)], dtype=np.int64)
    assert L.may_hold(bits, others).mean() < 0.2
    assert L.may_hold(L.sketch(nodes, most=8), np.array(wanted, dtype=np.int64)).all()  # full, but nothing is lost
    assert {(r.node, r.s) for r in L.candidates(rows, nodes).collect()} == {(x, f"line {i:04d}") for x, i in zip(wanted, range(0, 2000, 20), strict=True)}


def test_components_write_once_a_round(spark):
    rng = random.Random(3)
    ids = rng.sample(range(-(1 << 40), 1 << 40), 4000)
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in zip(ids, ids[1:], strict=False) if rng.random() < 0.98] + [(ids[0], x) for x in ids[::200]]
    root = {x: x for x in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    scratch = Scratch(spark, "test-components")
    got = {r.node: r.root for r in clusters.components(scratch, spark.createDataFrame(edges, "a long, b long").repartition(40)).collect()}
    assert got == {x: find(x) for x in {x for e in edges for x in e}}
    assert scratch.written <= 12
