import random
from collections import Counter, defaultdict

import numpy as np

from postscope.llm import line_dedup as L
from postscope.llm.queries import QUERIES


def brute(rows, percent=80, k=5):
    """Dropped lines per id, from all pairs of lines with a common shingle."""
    places = defaultdict(list)
    for i, t in rows:
        for j, s in L.lines_of(t or ""):
            places[s].append((i, j))
    lines = list(places)
    grams, index, parent = [frozenset(s[j : j + k] for j in range(len(s) - k + 1)) for s in lines], defaultdict(list), list(range(len(lines)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, g in enumerate(grams):
        for y, n in Counter(y for s in g for y in index[s]).items():
            if 100 * n >= percent * (len(g) + len(grams[y]) - n):
                parent[find(x)] = find(y)
        for s in g:
            index[s].append(x)
    first, drops = {}, Counter()
    for x, s in enumerate(lines):
        first[find(x)] = min(first.get(find(x), min(places[s])), min(places[s]))
    for x, s in enumerate(lines):
        for place in places[s]:
            drops[place[0]] += place != first[find(x)]
    return drops


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    drops = brute(rows)
    got = QUERIES["op7_fuzzy_line_dedup"](spark, sf).collect()
    assert {r.doc_id: r.n_dropped for r in got} == {i: drops[i] for i, _ in rows}


def test_one_line_of_each_group_stays(spark):
    line = "The committee met on Tuesday to discuss the budget for the coming year in some detail."
    rows = [(1, f"alpha beta gamma\n{line}"), (2, f"{line.replace('Tuesday', 'tuesday')}\nsomething else entirely"), (3, line), (4, f"  {line}\n\nown words here")]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars int")
    got = {r.doc_id: (r.text, r.n_chars) for r in L.dedup(docs).collect()}
    assert got == {1: (rows[0][1], len(rows[0][1])), 2: ("something else entirely", 23), 4: ("\nown words here", 15)}


def test_banding_recall_and_precision():
    rng, s = random.Random(6), L.Settings()
    alphabet = "abcdefghijklmnopqrstuvwxyz      "
    lines = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80, 400))) for _ in range(300)]
    near = []
    for t in lines:
        c = list(t)
        for _ in range(max(1, len(t) // 120)):
            c[rng.randrange(len(c))] = "#"
        near.append("".join(c))
    (a, x), (b, y) = L.band_keys(lines, s), L.band_keys(near, s)
    assert ((a == b).any(axis=1)).mean() > 0.98
    assert not any(np.intersect1d(a[i], a[j]).size for i in range(0, 100) for j in range(i))
    alone = L.band_keys([lines[5]], s)
    assert np.array_equal(alone[0][0], a[5]) and alone[1][0] == x[5]  # whatever else is in the batch
    assert L.alike(s)(x, y).mean() > 0.98  # far from all of these pairs reach the threshold


def test_marks_keep_pairs_at_the_threshold():
    """Whatever the length, pairs just above the threshold have alike marks,
    and unlike lines of the same words mostly haven't."""
    rng, s = random.Random(7), L.Settings()
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    pairs, others = [], []
    for _ in range(6000):
        a = " ".join(rng.choice(words) for _ in range(rng.randrange(3, 90)))
        b = a
        while True:  # change words while the lines stay similar
            at, size = rng.randrange(len(b)), rng.randrange(1, 6)
            new = b[:at] + rng.choice(words)[:size] + b[at + size:]
            test = L.test(s)({"s": [a, new], "mark": [0, 0]})
            if len(new) < 5 or not test(0, 1):
                break
            b = new
        pairs.append((a, b))
        others.append(" ".join(rng.choice(words) for _ in range(rng.randrange(30, 90))))
    marks = [L.band_keys(list(x), s)[1] for x in zip(*pairs, strict=True)]
    assert L.alike(s)(*marks).mean() > 0.998
    unlike = L.band_keys(others, s)[1]
    assert L.alike(s)(unlike[1:], unlike[:-1]).mean() < 0.02
    for x, y in (marks, (unlike[1:], unlike[:-1])):
        assert L.alike(s)(x, y).tolist() == [L.alike_pair(s)(int(a), int(b)) for a, b in zip(x, y, strict=True)]


def test_marks_count_repeated_shingles_once():
    s = L.Settings()
    _, mark = L.band_keys(["-" * 20, "-" * 100, "-" * 5000, "ab" * 40, "ab" * 4000], s)
    for x, y in ((0, 1), (0, 2), (1, 2), (3, 4)):
        assert L.alike(s)(mark[[x]], mark[[y]]).all()


def test_repeated_shingles_link(spark):
    docs = spark.createDataFrame([(1, "-" * 20), (2, "-" * 100), (3, "=" * 30), (4, "-" * 3000)], "doc_id long, text string")
    assert sorted(r.doc_id for r in L.dedup(docs).collect()) == [1, 3]


def test_chains_of_candidates_are_tested_by_pair(spark, monkeypatch):
    """Bands of few lines give pairs; a long chain of candidates, of which only
    some are similar, isn't gathered into one cluster to be linked in chunks."""
    rng = random.Random(11)
    line, rows = "".join(rng.choice("abcdefghijklmnop ") for _ in range(150)), []
    for i in range(600):  # each line like the one before, at about the threshold
        rows.append((i, line))
        at, size = rng.randrange(0, 130), 10 + i % 6
        line = line[:at] + "".join(rng.choice("abcdefghijklmnop") for _ in range(size)) + line[at + size:]

    def refuse(*_):
        raise AssertionError("these lines need no chunks")

    monkeypatch.setattr(L, "links_of", refuse)
    drops = brute(rows)
    got = L.marked(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert 100 < sum(drops.values()) < 600
    differ = sum(len(r["__drops"]) != drops[r.doc_id] for r in got)
    assert differ <= 6  # banding misses 1 pair of 1,000 at the threshold, marks 1 of 5,000


def test_pairs_at_once_match_the_test_of_one():
    rng, s = random.Random(12), L.Settings()
    a = ["".join(rng.choice("abé\U0001f600 ") for _ in range(rng.randrange(5, 90))) for _ in range(256)]
    b = [x if i % 5 == 0 else x[: rng.randrange(5, len(x) + 1)] + "z" * (i % 3) for i, x in enumerate(a)]
    want = [L.test(s)({"s": [x, y], "mark": [0, 0]})(0, 1) for x, y in zip(a, b, strict=True)]
    assert L.similar(a, b, s).tolist() == want and 0 < sum(want) < 256
