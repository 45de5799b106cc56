"""A18 kept up to date: counts per (day, hour, author) of arriving posts.

A Structured Streaming job adds each micro-batch's counts to a Parquet table
partitioned by day and batch id. A batch writes its own partitions only, with
dynamic partition overwrite: a batch that is run again after a failure
replaces its rows by the same rows, and posts of an hour that was counted
before (late files) simply add rows under a later batch id. Readers sum.

The stream's checkpoint lies in the table's folder (``_checkpoint``, which
Parquet readers skip), so batch ids and rows can't get out of step: a copied
or deleted table takes its checkpoint along.

Posts without a valid day are not counted; nameless posts count under a null
author, as Q1 needs them to choose the days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postscope.functions.days import parse_ts
from postscope.operators.approx import daily_rollup
from postscope.plans.questions import answer_from_summaries, summaries_of_pairs
from postscope.schema import POST
from postscope.sources.posts import JSON_OPTIONS

ROLLUP_DDL = "hour INT, author STRING, n BIGINT, date DATE, batch BIGINT"


def batch_counts(posts: DataFrame, batch_id: int) -> DataFrame:
    """One batch's rows of the table."""
    rows = posts.select("date", F.col("user.username").alias("author"))
    return daily_rollup(rows, parse_ts("date"), "author").select("hour", "author", "n", "date", F.lit(batch_id).cast("long").alias("batch"))


def start_rollup(spark: SparkSession, input_dir: str, table: str, max_files_per_trigger: int = 1000, available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    """Start the stream over NDJSON files below ``input_dir``; ``available_now``
    counts what is there and stops."""
    posts = (
        spark.readStream.schema(POST).options(**JSON_OPTIONS)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("recursiveFileLookup", "true")
        .json(input_dir)
    )

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        (
            batch_counts(batch, batch_id).hint("rebalance", F.col("date"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date", "batch")
            .parquet(table)
        )

    w = posts.writeStream.foreachBatch(per_batch).option("checkpointLocation", f"{table.rstrip('/')}/_checkpoint")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def read_counts(spark: SparkSession, table: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Merged counts ``date, hour, author, n``; a range of days reads the folders
    of these days only."""
    rows = spark.read.schema(ROLLUP_DDL).parquet(table)
    if first is not None:
        rows = rows.where(F.col("date") >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col("date") <= F.lit(last))
    return rows.groupBy("date", "hour", "author").agg(F.sum("n").alias("n"))


def top_days_top_user(spark: SparkSession, table: str, k: int = 10, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Q1 from the table, without the posts."""
    pairs = read_counts(spark, table, first, last).groupBy("date", "author").agg(F.sum("n").alias("n"))
    return answer_from_summaries(summaries_of_pairs(pairs), k)
