import numpy as np
from pyspark.sql import functions as F

from postscope.llm import language_id as L
from postscope.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op6_rank_order_language"](spark, sf).join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_ngrams_and_ranks():
    grams = {tuple(c) for c in ([x] for x in L.ngrams("Ab, a").tolist())}
    assert len(L.ngrams("Ab, a").tolist()) == len("ab") + len("a") + len([" a", "ab", "b ", " a", "a "]) + len([" ab", "ab ", " a "]) and grams
    assert len(L.ngrams("123 ... ")) == 0
    ranks = L.ranked("aaa bbb aab", 3)
    assert chr(int(ranks[0])) == "a" and len(ranks) == 3


def test_distance_is_rank_order():
    class Row:
        def __init__(self, lang, gram, rank):
            self.lang, self.gram, self.rank = lang, gram, rank

    matcher = L.Matcher([Row("x", ord("a"), 0), Row("x", ord("b"), 1), Row("y", ord("b"), 0), Row("y", ord("a"), 1)], 2)
    assert matcher.predict("a a a b")[0] == "x" and matcher.predict("b b b a")[0] == "y"
    assert matcher.predict("?!") == ("und", 0.0)
    assert np.isclose(L.Matcher([Row("x", int(g), i) for i, g in enumerate(L.ranked("hello", 300))], 300).predict("hello")[1], 1.0)


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = [(i, "der die das und nicht", "de") for i in range(20)] + [(100 + i, "the and of with this", "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.lang_pred for r in L.identify(docs, F.col("doc_id") < 50).collect()}
    assert got == {"de"}
