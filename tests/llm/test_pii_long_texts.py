"""Base spans of long runs (op10): linear time, and the plain patterns' matches."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from postscope.llm import pii_disclosure as D

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    rows = df.select("i", *(v.alias(k) for k, v in D.base_spans(F.col("t")).items())).orderBy("i").collect()
    return [{k: [(s.start, s.end) for s in r[k]] for k in D.KINDS} for r in rows]


def test_same_matches_as_the_plain_patterns(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("ab1.@_%+- 2", k=rnd.randrange(80))) for _ in range(2000)]
    texts += ["a@b.c_d@e.f%x@y.z.", "a@b.c" * 50, "1.2.3.4 " * 300, "x@y.zz " * 1000, "256.1.1.1.1 01.002.3.4"]
    for text, got in zip(texts, spans(spark, texts), strict=True):
        assert got["email"] == [m.span() for m in EMAIL.finditer(text)]
        assert got["ip"] == [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]


@pytest.mark.parametrize("unit, tail, count", [("a", " x@y.zz", 1), ("9", ".1", 0), ("1.", "", 75_000), ("ab@cd.ef ", "", 33_333 * 2), ("a@", "", 0), ("a.b-", "@", 0)])
def test_long_runs_take_no_square_time(spark, unit, tail, count):
    text = unit * (600_000 // len(unit)) + tail
    began = time.perf_counter()
    got, = spans(spark, [text])
    assert sum(map(len, got.values())) == count and time.perf_counter() - began < 30
