"""Every source has a rate of its own, however many there are (op5_poisson_mix)."""

import math

import duckdb
from pyspark.sql import functions as F

from postscope.llm import poisson_mix as M


def test_more_sources_than_any_cap(spark, tmp_path):
    """12,000 sources, a hot one and null against the operator's SQL."""
    s = F.when(F.col("id") < 24_000, F.concat(F.lit("s"), F.col("id") % 12_000)).when(F.col("id") < 34_000, "hot")
    docs = spark.range(34_100).select(F.col("id").alias("doc_id"), s.alias("source"), F.lit("x").alias("text"))
    docs.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    # the SQL's own rates, then each row's count from them
    want = con.sql("""WITH n AS (SELECT source, count(*) AS c FROM documents GROUP BY source)
        SELECT source, (SELECT sum(c) / sum(sqrt(c)) FROM n) * sqrt(c) / c FROM n""").fetchall()
    cdf = {source: M.cumulative(rate) for source, rate in want}
    rows = M.copies(docs).withColumn("u", M.uniform(M.draw("mix", F.col("doc_id")))).collect()
    assert len(rows) == 34_100 and all(r["__n"] == sum(c < r.u for c in cdf[r.source]) for r in rows)
    tail = sum(r["__n"] for r in rows if (r.source or "").startswith("s"))
    share = 12_000 * math.sqrt(2) / (12_000 * math.sqrt(2) + 100 + 10)
    assert abs(tail - 34_100 * share) < 5 * math.sqrt(34_100)
