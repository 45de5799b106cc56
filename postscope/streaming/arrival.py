"""Answer Q1 for every NDJSON file that arrives in a folder.

Structured Streaming discovers new files itself (file source + checkpoint),
so each file is processed once per checkpoint; a rerun with nothing new does
no work. The stream carries the arrivals' paths only; a micro-batch reads its
files (``max_files_per_trigger`` at most) with the fixed schema and answers
per file, so a file without a post gets an empty answer (a file without a
byte is no arrival to Spark).

Answers are keyed by the file's path under the input folder
(``source_name=<path>``), so equal names in different sub-folders stay apart.
Each batch writes with dynamic partition overwrite: if a batch is replayed
after a failure, the same folders are rewritten with the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postscope.plans.questions import top_days_top_user
from postscope.sources.posts import scan_posts

ARRIVAL_DDL = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
ANSWER_DDL = "ARRAY<STRUCT<date: DATE, top_user: STRING, day_total_tweets: BIGINT>>"


def plain_path(uri) -> Column:
    """The path of a file URI, without scheme and host, decoded."""
    c = F.col(uri) if isinstance(uri, str) else uri
    return F.url_decode(F.replace(F.regexp_replace(c, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), F.lit("+"), F.lit("%2B")))


def root_path(spark: SparkSession, folder: str) -> str:
    """The folder as an absolute plain path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    return full.toUri().getPath().rstrip("/")


def answers_per_file(posts: DataFrame, files: DataFrame, root: str, k: int = 10, day_mode: str = "utc") -> DataFrame:
    """One row per file: ``source_name`` and ``answer``, Q1's rows in order.

    ``posts`` carry their file in ``source_file``; ``files`` (``path``) lists
    all files of the batch, with or without posts."""
    rows = top_days_top_user(posts, k, day_mode, by=["source_file"], with_counts=True, ordered=False)
    order = F.struct((-F.col("day_total_tweets")).alias("n"), (-F.unix_date("date")).alias("d"),
                     F.struct("date", "top_user", "day_total_tweets").alias("row"))
    # at most k rows per file
    found = rows.groupBy(plain_path("source_file").alias("path")).agg(
        F.transform(F.array_sort(F.collect_list(order)), lambda x: x["row"]).alias("answer"))
    named = files.select(plain_path("path").alias("path"))
    return named.join(found, "path", "left").select(
        F.substring("path", F.lit(len(root) + 2), F.length("path")).alias("source_name"),
        F.coalesce("answer", F.array().cast(ANSWER_DDL)).alias("answer"))


def start_file_arrival(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str | None = None,
                       k: int = 10, max_files_per_trigger: int = 1, available_now: bool = True,
                       processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops.

    The stream checkpoint defaults to a sub-folder of the shared folder the
    cluster names in ``spark.checkpoint.dir`` (it must survive the loss of
    any executor or of the driver host).
    """
    if checkpoint_dir is None:
        from postscope.session import shared_dir

        checkpoint_dir = shared_dir(spark, "file_arrival")
    root = root_path(spark, input_dir)
    arrivals = (
        spark.readStream.format("binaryFile").schema(ARRIVAL_DDL)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("recursiveFileLookup", "true")
        .load(input_dir).select("path")
    )

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in batch.collect()]  # max_files_per_trigger at most
        if not paths:
            return
        posts = scan_posts(batch.sparkSession, paths).select("*", F.col("_metadata.file_path").alias("source_file"))
        files = batch.sparkSession.createDataFrame([(p,) for p in paths], "path STRING")
        (
            answers_per_file(posts, files, root, k)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("source_name")
            .json(output_dir)
        )

    w = arrivals.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def read_answers(spark: SparkSession, output_dir: str, empty: bool = False) -> DataFrame:
    """``source_name, date, top_user, day_total_tweets``; with ``empty`` also
    one row of nulls for each file without an answer."""
    stored = spark.read.schema(f"answer {ANSWER_DDL}, source_name STRING").json(output_dir)
    rows = F.explode_outer("answer") if empty else F.explode("answer")
    return stored.select("source_name", rows.alias("a")).select("source_name", "a.*")
