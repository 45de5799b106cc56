"""Stored daily summaries (A12, A16, A17): one row per UTC day with mergeable
sketches, from which any range of days is answered without the posts.

A row holds the number of posts and of named posts, an HLL sketch of the
authors, a heavy-hitter state of the authors and a KLL sketch of the texts'
lengths; a second table holds Count-Min rows per day. Each is one aggregate
combined map-side, so a day with a third of all posts reaches its reducer as
one state per task. Rewriting some days replaces only their folders.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postscope.functions.days import post_day_utc
from postscope.operators import approx as X
from postscope.operators.aggregate import count_by


@dataclass(frozen=True)
class Settings:
    lg_registers: int = 12  # HLL: relative standard error 1.04 / sqrt(2 ** 12)
    max_items: int = 100_000
    kll: int = 200
    eps: float = 0.001
    delta: float = 0.01

    @property
    def distinct_error(self) -> float:
        return 1.04 / (1 << self.lg_registers) ** 0.5


def daily_summaries(posts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``date, n, n_named, users, authors, lengths`` per day."""
    rows = posts.select(post_day_utc("date").alias("date"), F.col("user.username").alias("author"), F.length("content").cast("long").alias("length"))
    out = rows.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.count("author").alias("n_named"), X.hll_sketch("author", settings.lg_registers).alias("users"),
        X.top_k_state("author", settings.max_items).alias("authors"), X.quantile_sketch("length", settings.kll).alias("lengths"),
        F.count("date").alias("_dated"))
    return out.where(F.col("_dated") > 0).drop("_dated")


def daily_count_min(posts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Count-Min rows of the authors per day: ``date, line, cell, n``."""
    rows = posts.select(post_day_utc("date").alias("date"), F.col("user.username").alias("author"))
    return X.count_min_table(count_by(rows, "date", "author", drop_null="date"), "author", ["date"], settings.eps, settings.delta)


def write_by_day(rows: DataFrame, path: str) -> None:
    rows.hint("rebalance", F.col("date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def read_days(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The rows of a range of days (both ends included); other days' folders
    aren't read."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where(F.col("date") >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col("date") <= F.lit(last))
    return rows


def distinct_users() -> Column:
    """Aggregate over rows of ``daily_summaries``: estimated distinct authors."""
    return X.hll_merge_estimate("users")


def top_authors(days: DataFrame, k: int = 10, by=(), settings: Settings = Settings()) -> DataFrame:
    """The k most active authors of the given days: ``username, n, max_error``
    (the true count is within ``max_error`` of ``n``), per group of ``by``."""
    by = list(by)
    top = X.top_k_of_states(days, "authors", k, settings.max_items, by, "username")
    bound = days.groupBy(*by).agg(X.top_k_error(F.sum("n_named"), settings.max_items).alias("max_error"))
    return top.join(bound, by) if by else top.select("*", bound.scalar().alias("max_error"))


def length_quantiles(qs=(0.5, 0.9, 0.99), settings: Settings = Settings()) -> Column:
    """Aggregate over rows of ``daily_summaries``: quantiles of the texts' lengths."""
    return X.quantiles_of_sketches("lengths", qs, settings.kll)
