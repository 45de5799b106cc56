"""Every labelled language is a stratum of its own, null too (op8_risk_controlled_rules)."""

from pyspark.sql import functions as F

from postscope.llm import quality_rules as Q
from test_quality_rules import documents


def moved(docs, labels, at, lang):
    by = F.col("doc_id") + F.lit(at).cast("long")
    return docs.withColumns({"doc_id": by, "lang": F.lit(lang).cast("string")}), labels.withColumn("doc_id", by)


def test_labelled_null_language_rules_no_other(spark):
    """Cutoffs of null hold for null only, not for languages without labels."""
    docs, labels = documents(spark, 1500, 300)
    unnamed, marks = moved(docs, labels, 10**7, None)
    bare, _ = moved(docs, labels, 2 * 10**7, "xx")
    kept = Q.keep_good(unnamed.union(bare), marks)
    assert {r.lang: r["count"] for r in kept.groupBy("lang").count().collect()} == {None: 1500, "xx": 1800}


def test_more_than_fifty_languages(spark):
    """The 56th language by labels has its own cutoffs, and pools with no other."""
    docs, labels = documents(spark, 1500, 300)
    last, marks = moved(docs, labels, 10**7, "zz")
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("v"), i)), " ")
    many = spark.range(55 * 2000).select((F.col("id") + 10**8).alias("doc_id"), words.alias("text"), F.concat(F.lit("l"), F.col("id") % 55).alias("lang"))
    # documents like the bad ones of zz are good in a language with few labels
    few, good = moved(docs.where("doc_id >= 1000000"), labels.where("doc_id >= 1000000"), 10**9, "yy")
    all_labels = marks.union(many.select("doc_id", F.lit(1).alias("quality"))).union(good.withColumn("quality", F.lit(1)))
    found = Q.calibrate(last.union(many).union(few), all_labels)
    assert len(found) == 57 and "symbols_per_word" in found["zz"] and found["yy"] == {}
    assert Q.keep_good(few, all_labels).count() == 300
