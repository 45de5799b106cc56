"""Linking against a brute force over all pairs that share a key."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from postscope.llm import clusters
from postscope.llm.common import Scratch


def brute(keys: dict[int, list[int]], value: dict[int, int]) -> dict[int, int]:
    root = {x: x for x in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by: dict[int, list[int]] = {}
    for x, ks in keys.items():
        for k in ks:
            by.setdefault(k, []).append(x)
    for members in by.values():
        for x, y in combinations(members, 2):
            if abs(value[x] - value[y]) <= 1:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {x: find(x) for x in keys}


@pytest.mark.parametrize("shape", ["hot", "chain", "copies"])
def test_matches_brute_force(spark, shape):
    def near(columns):  # defined here, so that it travels whole
        return lambda x, y: abs(columns["value"][x] - columns["value"][y]) <= 1

    rng = np.random.default_rng(7)
    n = 900
    if shape == "hot":  # one key of all items, most of them unlike
        keys = {i: [1, 100 + i // 3] for i in range(n)}
        value = {i: int(v) for i, v in enumerate(rng.integers(0, 4 * n, n))}
    elif shape == "chain":  # small keys only, connected to one cluster
        keys = {i: [10 + i, 11 + i, 5000 + int(rng.integers(0, 300))] for i in range(n)}
        value = {i: int(v) for i, v in enumerate(rng.integers(0, 40, n))}
    else:  # a large group of copies that share all keys, and stragglers
        keys = {i: [1, 2, 3] if i % 3 else [3, 50 + i % 7] for i in range(n)}
        value = {i: 0 if i % 3 else int(rng.integers(0, 300)) for i in range(n)}
    scratch = Scratch(spark, "test-link")
    items = scratch.write(spark.createDataFrame([(i, keys[i], value[i]) for i in keys], "node long, keys array<long>, value long"))
    cluster = scratch.write(clusters.components(scratch, clusters.stars(items.select(F.explode("keys").alias("key"), "node"))))
    assert cluster.groupBy("root").count().agg(F.max("count")).first()[0] > clusters.CHUNK
    found = {r.node: r.root for r in clusters.link(scratch, items, cluster, ["value"], near).collect()}
    assert {x: found.get(x, x) for x in keys} == brute(keys, value)


def test_alike_stars(spark):
    """Nodes of a key are connected as far as their marks are alike; keys with
    very many nodes, in a task or at their reducer, are connected whole."""
    rng = random.Random(9)
    small = [(k, rng.randrange(1, 10**6), rng.randrange(1, 6)) for k in range(300) for _ in range(rng.randrange(1, 9))]
    hot = [(1000, 10**7 + i, i) for i in range(1, 3001)]  # more than a task's and a reducer's bound
    middle = [(1001, 2 * 10**7 + i, i) for i in range(1, 601)]  # beyond the reducer's bound only
    rows = small + hot + middle + small[:50]
    rng.shuffle(rows)
    marks = lambda a, b: (a == b) | (a == 0) | (b == 0)
    postings = spark.createDataFrame(rows, "key long, node long, mark long").repartition(16)
    for flush, most in ((1_000_000, 64), (500, 20)):
        edges = clusters.alike_stars(postings, marks, flush, most)
        got = groups(edges.collect())
        want = groups([(a, b) for k, a, x in small for l, b, y in small if k == l and x == y and a != b]
                      + [(a, group[0][1]) for group in (hot, middle) for _, a, _ in group[1:]])
        assert got == want


def groups(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    out = {}
    for x in parent:
        out.setdefault(find(x), set()).add(x)
    return {frozenset(v) for v in out.values() if len(v) > 1}


def test_groups_of_few_pairs_are_given_as_pairs(spark):
    """Of a key's groups of alike marks, one of few pairs gives them all, one of
    many is connected."""
    few, many = [(1, 100 + i, 1 + i // 3) for i in range(30)], [(1, 1000 + i, 99) for i in range(60)]
    postings = spark.createDataFrame(few + many, "key long, node long, mark long").repartition(4)

    def post(batch):
        return batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)

    found = clusters.alike_pairs(postings, post, lambda a, b: (a == b) | (a == 0) | (b == 0)).collect()
    assert {(r.a, r.b) for r in found if not r.whole} == {(a, b) for _, a, x in few for _, b, y in few if x == y and a < b}
    assert groups([(r.a, r.b) for r in found if r.whole]) == {frozenset(a for _, a, _ in many)}
