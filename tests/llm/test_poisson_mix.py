import math

import duckdb
from pyspark.sql import functions as F

from postscope.llm import poisson_mix as M
from postscope.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_matches_oracle(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(ORACLE_SQL["op5_poisson_mix"])
    got = QUERIES["op5_poisson_mix"](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_counts_follow_the_weights(spark):
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 6000, "big").otherwise("small").alias("source"))
    rows = {r.source: r for r in M.copies(docs, {"big": 1, "small": 3}, total=12000).groupBy("source").agg(
        F.sum("__n").alias("n"), F.count_if(F.col("__n") == 0).alias("zero")).collect()}
    # rates 3000 / 6000 and 9000 / 3000
    assert abs(rows["big"].n - 3000) < 5 * math.sqrt(3000) and abs(rows["small"].n - 9000) < 5 * math.sqrt(9000)
    assert abs(rows["big"].zero - 6000 * math.exp(-0.5)) < 250 and abs(rows["small"].zero - 3000 * math.exp(-3)) < 70


def test_shuffle_is_a_repeatable_permutation(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    order = [(r.doc_id, r["__copy"]) for r in M.mix(docs).collect()]
    again = [(r.doc_id, r["__copy"]) for r in M.mix(docs.repartition(3)).collect()]
    assert order == again and order != sorted(order) and len(set(order)) == len(order)


def test_pooled_rest(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 50).alias("source"))
    per, rest = M.rates(docs, None, None, 10, "source")
    assert len(per) == 10 and rest > 0
    assert abs(sum(r * 20 for r in per.values()) + rest * 800 - 1000) < 1e-6
