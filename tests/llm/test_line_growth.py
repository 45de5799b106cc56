"""Candidates of line dedup grow with the lines, not with their square (op7_fuzzy_line_dedup)."""

import random

import numpy as np

from postscope.llm import clusters
from postscope.llm import line_dedup as L


def grams(t):
    return {t[j : j + 5] for j in range(len(t) - 4)}


def likeness(a, b):
    return len(grams(a) & grams(b)) / len(grams(a) | grams(b))


def words(rng, n):
    return " ".join("".join(rng.choice(["th", "on", "er", "an", "re", "st", "nd", "ou", "le", "ti"]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def test_a_hot_key_of_unlike_nodes_connects_nothing(spark):
    rng = random.Random(2)
    unlike = [(1, i, 10**6 + i) for i in range(5000)]  # 1,250 and more of a key in a task
    pairs = [(2, 10**5 + i, 1 + i // 2) for i in range(600)]
    dense = [(3, 10**6 + i, 77) for i in range(3000)]
    rows = unlike + pairs + dense
    rng.shuffle(rows)
    postings = spark.createDataFrame(rows, "key long, node long, mark long").repartition(8)

    def post(batch):
        mark = batch.column(2).to_numpy().view(np.uint64)
        return batch.column(0).to_numpy(), batch.column(1).to_numpy(), np.stack([mark, mark >> np.uint64(1)], axis=1)

    found = clusters.alike_pairs(postings, post, lambda a, b: (a[:, 0] == b[:, 0]) | (a[:, 0] == 0) | (b[:, 0] == 0)).collect()
    assert sorted((r.a, r.b) for r in found if not r.whole) == [(10**5 + i, 10**5 + i + 1) for i in range(0, 600, 2)]
    whole = [(r.a, r.b) for r in found if r.whole]
    assert {x for e in whole for x in e} == {x for _, x, _ in dense} and len(whole) == 2999


def test_a_crowd_gives_the_pairs_of_brute_force(monkeypatch):
    rng = np.random.default_rng(8)
    mark = np.r_[rng.integers(1, 4000, 900), np.full(60, 5000), rng.integers(6000, 6100, 700)].astype(np.uint64)
    rng.shuffle(mark)
    alike = lambda a, b: np.abs(a.astype(np.int64) - b.astype(np.int64)) <= 1
    near = alike(mark[:, None], mark[None, :])
    root = np.arange(len(mark))
    for _ in range(200):
        root = np.where(near, root[None, :], len(mark)).min(axis=1)
    many = np.bincount(root, np.triu(near, 1).sum(axis=1), len(mark)) > 3 * np.bincount(root, minlength=len(mark))
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True) if not many[root[i]]}
    for block in (1000, 1 << 18):
        monkeypatch.setattr(clusters, "BLOCK", block)
        got, whole, a, b = clusters._crowd(mark, alike, 3)
        assert (got == root).all() and len(want) > 50
        assert whole[many[root]].all() and {*zip(a.tolist(), b.tolist(), strict=True)} == {(i, j) for i, j in want if not whole[i]}
        assert (whole == many[root]).mean() > 0.95


def test_marks_keep_what_is_similar_at_any_length():
    rng, s, pairs = random.Random(6), L.Settings(), []
    for n in [*range(20, 260, 6), 400, 900] * 25:
        t = words(rng, n)[:n]
        cut = t[: round(len(t) * 0.85)]  # the shorter one may be of known size, the longer one not
        other = list(t)
        while likeness(t, "".join(other)) > 0.83:
            other[rng.randrange(len(t))] = rng.choice("xyzq")
        pairs += [(t, x) for x in (cut, "".join(other)) if min(len(t), len(x)) >= 5 and likeness(t, x) >= 0.8]
    a, b = (L.keys_and_marks(list(x), s)[1] for x in zip(*pairs, strict=True))
    straddle = ((a[:, 0] & np.uint64(127)) == L.UNKNOWN) != ((b[:, 0] & np.uint64(127)) == L.UNKNOWN)
    known = ((a[:, 0] & np.uint64(127)) != L.UNKNOWN) & ((b[:, 0] & np.uint64(127)) != L.UNKNOWN)
    hit, before = L.alike_rows(s)(a, b), L.alike(s)(a[:, 0], b[:, 0])
    assert len(pairs) > 1500 and straddle.sum() > 50
    assert (hit[known | straddle] == before[known | straddle]).all()  # nothing lost there
    assert hit.mean() > 0.998


def test_marks_tell_short_lines_from_others():
    """Of the lines that share a band most are short ones and any others; the first number of the mark has little to say of these."""
    rng, s = random.Random(7), L.Settings()
    lines = [words(rng, n) for n in [8, 10, 12, 15, 40, 80, 120] * 60]
    marks = L.keys_and_marks(lines, s)[1]
    i, j = np.triu_indices(len(lines), 1)
    short = np.minimum(*(np.array([len(t) for t in lines])[x] for x in (i, j))) < 90
    i, j = i[short], j[short]
    assert L.alike(s)(marks[i, 0], marks[j, 0]).mean() > 0.3
    assert L.alike_rows(s)(marks[i], marks[j]).mean() < 0.002
