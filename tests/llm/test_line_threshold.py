"""Lines whose similarity is 0.80 to 0.85 link (op7_fuzzy_line_dedup)."""

import random

import numpy as np

from postscope.llm import line_dedup as L
from postscope.llm.queries import QUERIES
from test_line_dedup import brute


def test_query_matches_brute_force_at_80(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    drops = brute(rows, percent=80)
    got = QUERIES["op7_fuzzy_line_dedup"](spark, sf).collect()
    assert {r.doc_id: r.n_dropped for r in got} == {i: drops[i] for i, _ in rows}


def test_one_character_of_a_short_line(spark):
    line = "The committee met on Tuesday to discuss the new budget"  # 50 shingles, 45 / 55 stay common
    rows = [(1, line), (2, line.replace("met", "mEt")), (3, "Nothing in here is like the other two lines at all, is it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in L.dedup(docs).collect()) == [1, 3]


def test_banding_recall_at_the_threshold():
    rng, s = random.Random(3), L.Settings()
    lines = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz      ") for _ in range(49)) for _ in range(4000)]
    near = [t[:20] + "#" + t[21:] for t in lines]  # 40 / 50 shingles
    hit = (L.band_keys(lines, s)[0] == L.band_keys(near, s)[0]).any(axis=1)
    assert 1 - (1 - (s.percent / 100) ** s.rows) ** s.bands >= 0.998 and np.mean(hit) >= 0.996
