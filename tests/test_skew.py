"""A third of all posts from one author on one day: the answer is right and
the shuffle carries pre-aggregated rows, not posts."""

from pyspark.sql import functions as F

from postscope.plans import questions as Q
from postscope.schema import POST


def _skewed(spark, n=30000, parts=16):
    i = F.col("id")
    hot = (i % 3) == 0
    date = F.when(hot, F.lit("2021-05-05T12:00:00+00:00")).otherwise(
        F.format_string("2021-05-%02dT10:00:00+00:00", ((i % 28) + 1).cast("int")))
    name = F.when(hot, F.lit("bot")).otherwise(F.concat(F.lit("u"), (i % 500).cast("string")))
    return spark.range(0, n, 1, parts).select(
        i.alias("id"), date.alias("date"), F.lit(None).cast("string").alias("content"),
        F.struct(i.alias("id"), name.alias("username")).cast(POST["user"].dataType).alias("user"),
        F.lit(None).cast(POST["mentionedUsers"].dataType).alias("mentionedUsers"),
    )


def _nodes(plan):
    yield plan
    kids = plan.children()
    for j in range(kids.size()):
        yield from _nodes(kids.apply(j))
    if plan.nodeName() in ("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage"):
        yield from _nodes(plan.plan())


def _partial_agg_rows(df):
    final = df._jdf.queryExecution().executedPlan().executedPlan()
    rows = []
    for node in _nodes(final):
        if node.nodeName() == "HashAggregate" and "partial_count" in node.toString():
            rows.append(node.metrics().apply("numOutputRows").value())
    return rows


def test_hot_author_and_day(spark):
    df = _skewed(spark)
    q = Q.top_days_top_user(df, 10, with_counts=True)
    rows = q.collect()
    assert rows[0].date.isoformat() == "2021-05-05" and rows[0].top_user == "bot"
    assert rows[0].day_total_tweets == 10000 + len([i for i in range(30000) if i % 3 and (i % 28) + 1 == 5])
    shipped = _partial_agg_rows(q)
    assert shipped, "partial aggregate not found"
    # 30,000 posts in 16 tasks; the 20,000 others are (nearly) distinct
    # (day, author) pairs, the 10,000 hot posts leave the map side as at
    # most one row per task.
    assert max(shipped) <= 20000 + 16


def test_adapter_join_splits_a_hot_customer(spark):
    """orders ⋈ customer with one customer holding a third of all orders: with
    broadcast off, AQE's skew join splits the hot partition (the plan says
    so) and the rows are complete."""
    from postscope.sources import adapters as A

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        i = F.col("id")
        orders = spark.range(0, n, 1, 8).select(
            i.alias("o_orderkey"),
            F.when(i % 3 == 0, F.lit(7)).otherwise(i % 1000).cast("long").alias("o_custkey"),
            F.timestamp_seconds(F.lit(1_700_000_000) + i).alias("o_orderdate"),
        )
        customer = spark.range(0, 1000, 1, 4).select(
            F.col("id").alias("c_custkey"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("c_name"))
        posts = A.orders_posts(orders, customer)
        # The order id rides along (as a real post's payload would): hot rows
        # of a bare key compress to nothing and show no skew in shuffle sizes.
        out = posts.groupBy(F.col("user.username")).agg(F.count(F.lit(1)).alias("count"), F.sum("id").alias("s"))
        rows = {r.username: r["count"] for r in out.collect()}
        assert sum(rows.values()) == n and rows["c7"] == 10000 + len([x for x in range(n) if x % 3 and x % 1000 == 7])
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_salted_join_equals_plain_join(spark):
    from postscope.operators.joins import hot_keys, salted_join

    n = 20000
    i = F.col("id")
    left = spark.range(0, n, 1, 8).select(
        i.alias("row"), F.when(i % 3 == 0, F.lit(7)).otherwise(i % 500).cast("long").alias("k"))
    right = spark.range(0, 500, 1, 2).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    assert hot_keys(left, "k", 0.1) == [7]
    many = spark.range(0, 15000).select((F.col("id") % 150).alias("k"))
    assert len(hot_keys(many, "k", 1 / 150)) == 150  # no more than 1 / share keys can be hot, and all are found
    nulls = spark.range(0, 1000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"))
    parts = salted_join(nulls.withColumn("r", F.monotonically_increasing_id()), right, "k", "left", buckets=8)
    assert parts.count() == 1000
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = left.join(right.where("k % 10 <> 3"), "k", how)
        salted = salted_join(left, right.where("k % 10 <> 3"), "k", how, buckets=8)
        assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    # the hot key's rows are spread over the salt buckets
    spread = salted_join(left, right, "k", "inner", buckets=8, hot=[7]).where("k = 7")
    per_part = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_part) > 1
