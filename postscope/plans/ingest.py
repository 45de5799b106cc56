"""Ingest once, answer many times (S2 + S10 + S11 + S12 + A18 at scale).

NDJSON is row-wise: every question over raw JSON tokenises every line again.
``ingest_posts`` parses the input once, strictly, and writes columnar Parquet:

    <dest>/status=ok/year=Y/month=M/day=D/part-*.parquet        valid posts (+ parsed ``ts``)
    <dest>/status=ok/year=__HIVE_DEFAULT_PARTITION__/...        valid posts without a day
    <dest>/status=rejected/...                                  dead letters (raw line + reason)

in one pass over the input; rows are rebalanced by day before the write, so
files are neither tiny nor a hot day one task. The questions then read only the columns they
need, and ``top_days_top_user_ingested`` picks the k days from partition row
counts (no column is read) and scans only those k days for authors: the
semi-join on the partition columns becomes dynamic partition pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postscope.functions.days import parse_ts, utc_day
from postscope.operators.aggregate import best_per_group, count_by, top_k
from postscope.operators.joins import restrict_to_keys
from postscope.schema import POST
from postscope.sources.posts import partition_by_day, scan_posts_strict

DAY_KEYS = ["year", "month", "day"]


def ingest_posts(spark: SparkSession, src, dest: str, mode: str = "overwrite",
                 files_per_day: int | None = None) -> Observation:
    """Parse ``src`` strictly and write the layout above. Returns an
    ``Observation`` with ``lines``, ``rejected`` and ``without_day`` counts,
    filled by the same job."""
    parsed = scan_posts_strict(spark, src)
    ts = parse_ts(F.col("date"))
    rows = parsed.select(
        *[f.name for f in POST.fields],
        ts.alias("ts"),
        "source_file",
        F.col("_corrupt_record").alias("raw"),
        "reject_reason",
        F.when(F.col("reject_reason").isNull(), F.lit("ok")).otherwise(F.lit("rejected")).alias("status"),
    )
    obs = Observation("ingest")
    rows = rows.observe(
        obs,
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("status") == "rejected").alias("rejected"),
        F.count_if((F.col("status") == "ok") & F.col("ts").isNull()).alias("without_day"),
    )
    day = F.when(F.col("status") == "ok", utc_day(F.col("ts")))
    partition_by_day(rows, day, dest, mode=mode, files_per_day=files_per_day, keep_null_days=True,
                     extra_partitions=("status",))
    return obs


def read_ingested(spark: SparkSession, dest: str) -> DataFrame:
    """Valid posts (``status=ok``) with their partition columns."""
    return spark.read.parquet(dest).where(F.col("status") == "ok")


def read_dead_letters(spark: SparkSession, dest: str) -> DataFrame:
    return spark.read.parquet(dest).where(F.col("status") == "rejected").select("source_file", "raw", "reject_reason")


def top_days_top_user_ingested(spark: SparkSession, dest: str, k: int = 10) -> DataFrame:
    """Q1 (default rules) over the ingested layout; same rows as
    ``questions.top_days_top_user`` on the source posts."""
    posts = read_ingested(spark, dest)
    days = count_by(posts.where(F.col("year").isNotNull()), *DAY_KEYS, name="total")
    # ``total > 0`` holds for every day; it marks the k-row side as a
    # selective filter so the planner prunes partitions of the scan below.
    top = top_k(days.where(F.col("total") > 0), k, "total", DAY_KEYS, descending_keys=True)
    chosen = restrict_to_keys(posts.where(F.col("user.username").isNotNull()), top, DAY_KEYS, bound=k)
    pairs = count_by(chosen.select(*DAY_KEYS, F.col("user.username").alias("author")), *DAY_KEYS, "author")
    best = best_per_group(
        pairs.withColumn("_d", F.make_date(*[F.col(c) for c in DAY_KEYS])), "_d", "author",
        best="top_user", total="day_total_tweets",
    )
    return best.select(F.col("_d").alias("date"), "top_user", "day_total_tweets").orderBy(
        F.col("day_total_tweets").desc(), F.col("date").desc()
    ).drop("day_total_tweets")
