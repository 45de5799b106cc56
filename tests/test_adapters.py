"""Each Spark adapter equals its DuckDB twin row for row (sf0.001)."""

import duckdb
import pytest
from pyspark.sql import functions as F

from postscope.sources import adapters as A

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "orders", "customer", "lineitem", "supplier", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def load(spark, name):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return A.load(spark, SF, name)


def test_events_posts(spark, con):
    s = A.events_posts(load(spark, "events")).select(
        "id", "date", "content", F.col("user.id").alias("uid"), F.col("user.username").alias("name"))
    d = con.execute(f"""SELECT id, date, content, struct_extract("user", 'id'), struct_extract("user", 'username')
                        FROM ({A.EVENTS_POSTS_SQL})""").fetchall()
    assert sorted(map(tuple, s.collect()), key=repr) == sorted(d, key=repr)


def test_orders_posts(spark, con):
    s = A.orders_posts(load(spark, "orders"), load(spark, "customer")).select(
        "id", "date", F.col("user.id"), F.col("user.username"))
    d = con.execute(f"""SELECT id, date, struct_extract("user", 'id'), struct_extract("user", 'username')
                        FROM ({A.ORDERS_POSTS_SQL})""").fetchall()
    assert sorted(map(tuple, s.collect()), key=repr) == sorted(d, key=repr)


def test_mentions_per_order_and_per_line(spark, con):
    per_order = A.lineitem_posts(load(spark, "lineitem"), load(spark, "supplier"))
    per_line = A.lineitem_line_posts(load(spark, "lineitem"), load(spark, "supplier"))
    flat = [per_order, per_line]
    d = sorted(con.execute(f"SELECT l_orderkey, username FROM ({A.LISTED_MENTIONS_SQL})").fetchall(), key=repr)
    for p in flat:
        rows = p.select("id", F.explode("mentionedUsers.username")).collect()
        assert sorted(map(tuple, rows), key=repr) == d


def test_documents_posts(spark, con):
    s = A.documents_posts(load(spark, "documents")).select(
        "id", "content", F.array_sort(F.array_distinct("mentionedUsers.username")).alias("m"))
    d = con.execute(f"SELECT id, content, list_sort(meta_names) FROM ({A.DOCUMENTS_POSTS_SQL})").fetchall()
    assert sorted(((r[0], r[1], tuple(r[2])) for r in s.collect()), key=repr) == \
        sorted(((r[0], r[1], tuple(r[2])) for r in d), key=repr)


def test_json_lines(spark, con):
    s = A.events_json_lines(load(spark, "events")).collect()
    d = con.execute(f"SELECT line_no, value FROM ({A.EVENTS_LINES_SQL}) x").fetchall()
    assert sorted(map(tuple, s)) == sorted(d)


def test_salted_adapters_equal_plain(spark):
    from postscope.operators.joins import hot_keys

    o, c = load(spark, "orders"), load(spark, "customer")
    li, su = load(spark, "lineitem"), load(spark, "supplier")
    # Many shuffle partitions make every key 'hot' (share >= 1/partitions),
    # so the salted path is the one compared.
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    assert len(hot_keys(o, "o_custkey", 1 / 1000)) > 50
    try:
        pairs = [
            (A.orders_posts(o, c), A.orders_posts(o, c, salt_buckets=4)),
            (A.lineitem_posts(li, su), A.lineitem_posts(li, su, salt_buckets=4)),
            (A.lineitem_line_posts(li, su), A.lineitem_line_posts(li, su, salt_buckets=4)),
        ]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for plain, salted in pairs:
        assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
