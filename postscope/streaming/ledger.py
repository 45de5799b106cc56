"""T1 with a ledger: answer Q1 for every file that is new or has changed.

A file is known by its path, modification time and length. ``answer_arrivals``
lists the input folder, leaves out what the ledger holds, and answers the rest
in batches of ``max_files``, oldest first. So a file that is written again
under its old name gets a new answer, which replaces the old one, unlike in
the stream of ``arrival``, which remembers paths only.

The ledger (``_ledger`` in the output folder, which readers of the answers
skip) is appended to after a batch's answers are written. A run that dies in
between answers the batch again, with the same rows in the same folders.

A file that can't be read to its end doesn't stop the others: when a batch
fails, its files are read one by one, and each that fails alone gets an empty
answer and the error's text. It is tried again once it has changed. Other
failures are raised. A file without a post has an empty answer; files of zero
bytes are not listed by Spark.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postscope.sources.posts import scan_posts
from postscope.streaming.arrival import ANSWER_DDL, answers_per_file, plain_path, root_path

LEDGER_DDL = "source_name STRING, modificationTime TIMESTAMP, length BIGINT, error STRING"
RESULT_DDL = f"answer {ANSWER_DDL}, error STRING, source_name STRING"
ERROR_CHARS = 500
#: A failed job, as PySpark raises it.
FAILURES = (PySparkException, Py4JJavaError)


def listed(spark: SparkSession, input_dir: str, root: str) -> DataFrame:
    """path, source_name, modificationTime and length of the files below the
    folder; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(input_dir).select("path", "modificationTime", "length")
    plain = plain_path("path")
    return files.withColumn("source_name", F.substring(plain, F.lit(len(root) + 2), F.length(plain)))


def read_ledger(spark: SparkSession, output_dir: str) -> DataFrame:
    """Every version of a file that was answered, with its error if it had one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{output_dir}/_ledger")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER_DDL)
    return spark.read.schema(LEDGER_DDL).parquet(f"{output_dir}/_ledger")


def _write(rows: DataFrame, output_dir: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_name").json(output_dir)


def _answer(spark: SparkSession, paths: list[str], root: str, k: int, day_mode: str, output_dir: str) -> None:
    posts = scan_posts(spark, paths).select("*", F.col("_metadata.file_path").alias("source_file"))
    files = spark.createDataFrame([(p,) for p in paths], "path STRING")
    _write(answers_per_file(posts, files, root, k, day_mode), output_dir)


def _read_error(spark: SparkSession, path: str) -> str | None:
    """The error of reading one file to its end, or None."""
    try:
        spark.read.text(path).write.format("noop").mode("overwrite").save()
    except FAILURES as e:
        return str(e)[:ERROR_CHARS]
    return None


def answer_arrivals(spark: SparkSession, input_dir: str, output_dir: str, k: int = 10, max_files: int = 100,
                    day_mode: str = "utc") -> tuple[int, int]:
    """Answer all files that the ledger doesn't hold as they are now; the
    numbers of files answered and of files with an error. The driver receives
    ``max_files`` names at a time."""
    root = root_path(spark, input_dir)
    answered = failed = 0
    while True:
        files = listed(spark, input_dir, root).join(read_ledger(spark, output_dir), ["source_name", "modificationTime", "length"], "left_anti")
        batch = files.orderBy("modificationTime", "path").limit(max_files).collect()
        if not batch:
            return answered, failed
        errors = {}
        try:
            _answer(spark, [f.path for f in batch], root, k, day_mode, output_dir)
        except FAILURES:
            errors = {f.path: e for f in batch if (e := _read_error(spark, f.path)) is not None}
            if not errors:
                raise
            if good := [f.path for f in batch if f.path not in errors]:
                _answer(spark, good, root, k, day_mode, output_dir)
            bad = [([], errors[f.path], f.source_name) for f in batch if f.path in errors]
            _write(spark.createDataFrame(bad, RESULT_DDL), output_dir)
        rows = [(f.source_name, f.modificationTime, f.length, errors.get(f.path)) for f in batch]
        spark.createDataFrame(rows, LEDGER_DDL).coalesce(1).write.mode("append").parquet(f"{output_dir}/_ledger")
        answered, failed = answered + len(batch) - len(errors), failed + len(errors)


def read_results(spark: SparkSession, output_dir: str) -> DataFrame:
    """``source_name, error, date, top_user, day_total_tweets``; a file without
    an answer has one row of nulls."""
    stored = spark.read.schema(RESULT_DDL).json(output_dir)
    return stored.select("source_name", "error", F.explode_outer("answer").alias("a")).select("source_name", "error", "a.*")
