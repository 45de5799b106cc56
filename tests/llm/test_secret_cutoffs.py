"""A format's cutoff comes from all labelled strings (op2_secret_formats)."""

import random

from postscope.llm import secret_scan as S


def test_cutoff_covers_all_labelled_strings(spark):
    rng = random.Random(9)
    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789"
    keys = ["AKIA" + "".join(rng.choice(upper if rng.random() < 0.9 else digits) for _ in range(rng.choice((16, 16, 16, 20, 40)))) for _ in range(3000)]
    docs = spark.createDataFrame([(i, f"some words {k} {k} after") for i, k in enumerate(keys)], "doc_id long, text string")
    grammar = S.learn(docs, S.Settings())
    machine, cutoff = grammar.formats["access"]
    rates = sorted(S._rate(machine, k) for k in set(keys) - grammar.machines["access"][1])
    assert len(rates) > 2700
    want = rates[int(S.Settings().tolerated * len(rates))]
    assert want - 1 / S.BUCKET <= cutoff <= want
    sample = sorted(S._rate(machine, k) for k in S.labelled(docs, S.Settings())["access"][1::2])
    assert abs(sample[int(S.Settings().tolerated * len(sample))] - cutoff) > 1 / S.BUCKET  # what 200 strings gave
