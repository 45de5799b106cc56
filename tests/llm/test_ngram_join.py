import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from postscope.llm import clusters, ngram_join
from postscope.llm.common import Scratch, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k=5):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, percent=75):
    """(id, size, least id reachable) per row, from all pairs with a common shingle."""
    sets = [shingle_set(t) for _, t in rows]
    parent, index = list(range(len(rows))), defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, s in enumerate(sets):
        for y, n in Counter(y for g in s for y in index[g]).items():
            if 100 * n >= percent * (len(s) + len(sets[y]) - n):
                parent[find(x)] = find(y)
        for g in s:
            index[g].append(x)
    least = {}
    for x, (i, _) in enumerate(rows):
        least[find(x)] = min(least.get(find(x), i), i)
    return sorted((i, len(sets[x]), least[find(x)]) for x, (i, _) in enumerate(rows))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in ngram_join.join(docs).collect()) == brute(rows)


def near_copies(n, words, edits, seed=3):
    """A chain of documents, each a few words from one before: some pairs link, others only by way of third ones."""
    rng = random.Random(seed)
    texts = [[f"w{rng.randrange(500)}" for _ in range(words)]]
    while len(texts) < n:
        t = list(rng.choice(texts[-6:]))
        for _ in range(rng.randrange(1, edits)):
            t[rng.randrange(len(t))] = f"w{rng.randrange(500)}"
        texts.append(t)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("chunk", [3, 400])
def test_large_groups_in_chunks(spark, monkeypatch, chunk):
    """A cluster that is dealt into many chunks links as one task would."""
    monkeypatch.setattr(clusters, "CHUNK", chunk)
    monkeypatch.setattr(clusters, "LEADERS", 1)
    rows = near_copies(60, 60, 6) + [(100 + i, t) for i, t in near_copies(20, 40, 3, seed=9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in ngram_join.join(docs).collect()) == brute(rows)


def test_threshold_is_exact(spark):
    """100 * intersection >= 75 * union at the border: 3 of 4 shingles link, 2 of 3 don't."""
    base = "a b c d e f g h i j k"  # 7 shingles
    rows = [(1, base), (2, base + " l"), (3, "q r s t u v"), (4, "q r s t u w"), (5, base + " l m n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in ngram_join.join(docs).collect()) == brute(rows)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(50)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
    got = clusters.components(Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long").repartition(7))
    assert {r.node: r.root for r in got.collect()} == want


def test_stars_connect_each_key(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(40), rng.randrange(1000)) for _ in range(400)]
    edges = clusters.stars(spark.createDataFrame(rows, "key long, node long").repartition(5), flush=50)
    got = {r.node: r.root for r in clusters.components(Scratch(spark, "t"), edges).collect()}
    of_key = defaultdict(set)
    for k, n in rows:
        of_key[k].add(got.get(n, n))
    assert all(len(v) == 1 for v in of_key.values())


def test_word_hashes():
    a = word_hashes(b" ab cd\nab\tabc ")
    assert len(a) == 4 and a[0] == a[2] and len(set(a.tolist())) == 3
    assert np.array_equal(word_hashes(b"xx yy"), word_hashes(b"zzzzzz xx yy")[1:]) and len(word_hashes(b" ")) == 0


def test_shared_tokens_go_back_in_seven_bytes(spark):
    """Six of the token and one of its frequency, which keeps the order."""
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i % 3, 40))) for i in range(9)], "doc_id long, text string")
    s = ngram_join.Settings()
    packed = ngram_join.dealt(docs, np.empty(0, dtype=np.uint64), 4, s).repartitionById(4, "to")
    back = ngram_join.counted(packed, 4).where("back and often is not null").collect()
    assert back and all(len(r.tokens) == 6 * len(r.often) and sum(ngram_join._read_counts(r.asDict())) == len(r.often) for r in back)
    classes = ngram_join._class(np.arange(1, 1 << 20)).astype(int)
    assert (np.diff(classes) >= 0).all() and classes[0] == 1 and classes[-1] < ngram_join.LAST
    assert np.array_equal(ngram_join._unpack(ngram_join._pack(np.array([1 << 47, 5], dtype=np.uint64), 6), 6), [1 << 47, 5])


@pytest.mark.parametrize("percent", [60, 75])
def test_sizes_ruled_out_at_once_are_those_of_the_test(percent):
    ns = [1, 3, 4, 5, 75, 100, 134]
    near = ngram_join.near(percent)({"n": ns})
    for x in range(len(ns)):
        assert near(x, np.arange(len(ns))).tolist() == [100 * min(ns[x], y) >= percent * max(ns[x], y) for y in ns]
