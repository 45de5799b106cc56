"""Post readers and writers.

* ``scan_posts``: fixed-schema NDJSON scan. Malformed lines become rows of
  nulls (Spark's PERMISSIVE mode); nested column pruning means only the fields
  a question touches are materialised.
* ``scan_posts_strict`` / ``parse_posts_strict``: every line is parsed once as
  a whole, whatever the caller selects later, and each row carries a
  ``reject_reason`` (null for a valid post). Validity is judged per question
  and by exact JSON types (``valid_for``). Reading the lines as text first
  makes the reject set independent of column pruning, which ``DROPMALFORMED``
  is not.
* ``scan_records``: untyped access through ``VARIANT``.
* ``dead_letter``: the rejected lines with their reason, for a side output.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postscope.schema import CORRUPT_COLUMN, POST, REQUIRED_FIELDS

# Reasons written to the dead-letter output.
REASON_MALFORMED = "malformed_json"
REASON_NOT_OBJECT = "not_an_object"
REASON_WRONG_TYPE = "wrong_type"
REASON_INVALID = "invalid_post"
# Standard JSON only: Spark's reader accepts 'single-quoted' strings and
# NaN/Infinity by default, which a JSON decoder rejects.
JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def scan_posts(spark: SparkSession, path, schema=POST) -> DataFrame:
    """NDJSON posts with the fixed schema (no inference pass)."""
    return spark.read.schema(schema).options(**JSON_OPTIONS).json(path)


def scan_posts_inferred(spark: SparkSession, path) -> DataFrame:
    """Schema inferred from every record (one extra pass over the input).

    The observed types of all objects are merged by ``schema_of_variant_agg``
    (one row); a field of several kinds reads as text. Lines that are no
    object give rows of nulls."""
    lines = scan_lines(spark, path).select("value")
    v = records_from_text(lines).where(F.schema_of_variant("v").startswith("OBJECT"))
    merged = v.agg(F.schema_of_variant_agg("v")).first()[0]
    if merged is None:  # no record, no field
        return lines.select()
    ddl = re.sub(r"\b(VARIANT|VOID)\b", "STRING", merged.replace("OBJECT<", "STRUCT<"))
    return lines.select(F.from_json("value", ddl, JSON_OPTIONS).alias("p")).select("p.*")


def scan_lines(spark: SparkSession, path) -> DataFrame:
    """Raw lines with their file, blank lines removed."""
    return skip_blank_lines(
        spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    )


def skip_blank_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Without lines of JSON white space only (null lines go too)."""
    return lines.where(F.col(column).rlike(r"[^ \t\r\n]"))


def _type(v: Column, path: str) -> Column:
    """JSON type at a path: STRING, BIGINT, OBJECT<...>, VOID (null), ...; null if absent."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _only(kind: Column, *names: str) -> Column:
    """Absent, JSON null, or of a type that starts with one of the names."""
    return kind.isNull() | (kind == "VOID") | kind.rlike("^(" + "|".join(names) + ")")


def parse_posts_strict(lines: DataFrame, column: str = "value", on_error: str = "skip",
                       question: str | None = None) -> DataFrame:
    """S2 on a DataFrame of JSON text lines, blank lines removed.

    Output: the other columns, the post columns (a field of another JSON type
    is null), ``valid`` (struct of q1, q2, q3: the typed reader of that
    question accepts the line), ``_corrupt_record`` (raw text of a rejected
    line) and ``reject_reason``.

    Each line is parsed once, as VARIANT and within brackets: text after the
    object or a second object then shows, and JSON white space around it is
    ignored. ``malformed_json`` and ``not_an_object`` hold for every
    question. With ``question`` a line that this question's reader refuses is
    ``invalid_post``, whatever the fields it doesn't read look like; without,
    a post field of another JSON type is ``wrong_type``. Of a repeated key the
    last value counts (VARIANT refuses such lines; only they are parsed again,
    with the fixed schema). ``on_error="fail"`` (V12) makes the job fail on
    the first rejected line; the check is a filter, so no later column
    selection can prune it away.
    """
    if on_error not in ("skip", "fail"):
        raise ValueError(f"on_error must be 'skip' or 'fail', not {on_error!r}")
    if question is not None and question not in REQUIRED_FIELDS:
        raise ValueError(f"unknown question {question!r}")
    raw = F.col(column)
    boxed = F.concat(F.lit("["), raw, F.lit("]"))
    again = F.when(F.col("_v").isNull(), F.from_json(boxed, T.ArrayType(POST), JSON_OPTIONS))
    base = lines.withColumn("_v", F.try_parse_json(boxed)).withColumn("_again", again)
    one = F.when(F.try_variant_get("_v", "$[1]", "variant").isNull(), F.try_variant_get("_v", "$[0]", "variant"))
    twice = F.when((F.size("_again") == 1) & raw.rlike(r"^[ \t\r\n]*\{"), F.col("_again")[0])
    base = base.select(*lines.columns, one.alias("_o"), twice.alias("_p"))
    v = F.col("_o")
    kinds = {n: _type(v, p) for n, p in (
        ("id", "$.id"), ("date", "$.date"), ("content", "$.content"), ("user", "$.user"),
        ("uid", "$.user.id"), ("username", "$.user.username"), ("mentions", "$.mentionedUsers"))}
    base = base.withColumns({"_root": F.schema_of_variant(v), **{f"_t_{n}": k for n, k in kinds.items()},
                             "_m": F.try_variant_get(v, "$.mentionedUsers", "array<variant>")})
    k = {n: F.col(f"_t_{n}") for n in kinds}
    names = F.transform("_m", lambda m: F.struct(
        F.schema_of_variant(m).alias("e"), F.schema_of_variant(F.try_variant_get(m, "$.username", "variant")).alias("t"),
        F.try_variant_get(m, "$.username", "string").alias("username")))
    base = base.withColumn("_names", names)

    def text(kind: Column, path: str) -> Column:
        return F.when(kind == "STRING", F.try_variant_get(v, path, "string"))

    def number(kind: Column, path: str) -> Column:
        return F.when(kind == "BIGINT", F.try_variant_get(v, path, "bigint"))

    user = F.when(k["user"].startswith("OBJECT"), F.struct(
        number(k["uid"], "$.user.id").alias("id"), text(k["username"], "$.user.username").alias("username")))
    mentioned = F.transform("_names", lambda m: F.struct(F.when(m["t"] == "STRING", m["username"]).alias("username")))
    typed = {"id": number(k["id"], "$.id"), "date": text(k["date"], "$.date"), "content": text(k["content"], "$.content"),
             "user": user, "mentionedUsers": mentioned}
    second = F.col("_p").isNotNull()
    posts = {f.name: F.when(second, F.col(f"_p.{f.name}")).otherwise(typed[f.name].cast(f.dataType)) for f in POST.fields}
    is_post = second | F.coalesce(F.col("_root").startswith("OBJECT"), F.lit(False))
    listed = F.coalesce(F.forall("_names", lambda m: F.coalesce(m["t"] == "STRING", F.lit(False))), F.lit(False))
    # the fixed schema can't tell an absent list from a null one: a repeated key's line counts for q3 either way
    again_listed = F.coalesce(F.forall("_p.mentionedUsers", lambda m: m["username"].isNotNull()), F.lit(True))
    ok = {
        "q1": F.when(second, F.col("_p.date").isNotNull() & F.col("_p.user.username").isNotNull()).otherwise(
            (k["date"] == "STRING") & (k["username"] == "STRING")),
        "q2": F.when(second, F.col("_p.content").isNotNull()).otherwise(k["content"] == "STRING"),
        "q3": F.when(second, again_listed).otherwise((k["mentions"] == "VOID") | (k["mentions"].startswith("ARRAY") & listed)),
    }
    valid = F.struct(*((is_post & F.coalesce(c, F.lit(False))).alias(q) for q, c in ok.items()))
    # an element is an object with a text or null name, or null
    elements = F.coalesce(F.forall("_names", lambda m: _only(m["e"], "OBJECT") & _only(m["t"], "STRING")), F.lit(True))
    right = second | (
        _only(k["id"], "BIGINT$") & _only(k["date"], "STRING") & _only(k["content"], "STRING") & _only(k["user"], "OBJECT")
        & _only(k["uid"], "BIGINT$") & _only(k["username"], "STRING") & _only(k["mentions"], "ARRAY") & elements)
    # a single value that is no object, or an array: JSON, but no post
    reason = (F.when(~is_post & F.col("_root").isNotNull(), F.lit(REASON_NOT_OBJECT))
              .when(~is_post, F.lit(REASON_MALFORMED)))
    if question is None:
        reason = reason.when(~right, F.lit(REASON_WRONG_TYPE))
    else:
        reason = reason.when(~F.coalesce(ok[question], F.lit(False)), F.lit(REASON_INVALID))
    cols = [c for c in lines.columns if c != column]
    res = base.select(*cols, raw.alias("_raw"), *(c.alias(n) for n, c in posts.items()), valid.alias("valid"), reason.alias("reject_reason"))
    res = skip_blank_lines(res, "_raw").select(
        *cols, *posts, "valid", F.when(F.col("reject_reason").isNotNull(), F.col("_raw")).alias(CORRUPT_COLUMN), "reject_reason")
    if on_error == "fail":
        res = res.where(
            F.when(
                F.col("reject_reason").isNotNull(),
                F.raise_error(F.concat(F.col("reject_reason"), F.lit(": "), F.substring(CORRUPT_COLUMN, 1, 200))),
            ).otherwise(F.lit(True))
        )
    return res


def scan_posts_strict(spark: SparkSession, path, on_error: str = "skip", question: str | None = None) -> DataFrame:
    """Text lines -> typed posts with a reject reason per line."""
    return parse_posts_strict(scan_lines(spark, path), on_error=on_error, question=question)


def valid_for(question: str) -> Column:
    """Per-question validity of a strictly parsed line (V13): q1 needs
    ``date`` and ``user.username``; q2 ``content``; q3 the ``mentionedUsers``
    key (null allowed) with no element missing its name, each as text."""
    if question not in REQUIRED_FIELDS:
        raise ValueError(f"unknown question {question!r}")
    return F.col(f"valid.{question}")


def dead_letter(parsed: DataFrame, keep=("source_file",)) -> DataFrame:
    """Rejected lines (raw text + reason), ready to be written apart."""
    keep = [c for c in keep if c in parsed.columns]
    return parsed.where(F.col("reject_reason").isNotNull()).select(
        *keep, F.col(CORRUPT_COLUMN).alias("raw"), "reject_reason"
    )


def scan_records(spark: SparkSession, path) -> DataFrame:
    """S3: one ``VARIANT`` column ``v`` per line (untyped record access)."""
    return records_from_text(scan_lines(spark, path))


@contextmanager
def repeated_keys(spark: SparkSession):
    """Frames built inside parse VARIANTs by the rule of JSON decoders: of a
    repeated key the last value counts, at any depth. By default Spark refuses
    the whole text. The setting is fixed in the parsing expression."""
    before = spark.conf.get(REPEATED_KEYS)
    spark.conf.set(REPEATED_KEYS, "true")
    try:
        yield
    finally:
        spark.conf.set(REPEATED_KEYS, before)


def records_from_text(lines: DataFrame, column: str = "value") -> DataFrame:
    """One ``VARIANT`` per line that is a single JSON value. The line is parsed
    within brackets, so text after the value shows. Of a repeated key the last
    value counts, so no valid line is lost."""
    with repeated_keys(lines.sparkSession):
        boxed = lines.select(F.try_parse_json(F.concat(F.lit("["), F.col(column), F.lit("]"))).alias("b"))
    one = F.when(F.try_variant_get("b", "$[1]", "variant").isNull(), F.try_variant_get("b", "$[0]", "variant"))
    return boxed.select(one.alias("v")).where(F.col("v").isNotNull())


def write_result_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a result as JSON lines (a top-k answer is one file)."""
    df.write.mode(mode).json(path)


def output_path_for(input_col: Column) -> Column:
    """Where the answer of an input goes. Within the same store (scheme
    and bucket) ``input/`` becomes ``output/`` and sub-folders stay; a name
    without ``input/`` goes to ``output/<basename>``."""
    store = F.regexp_extract(input_col, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*/)", 1)
    name = F.substring(input_col, F.length(store) + 1, F.length(input_col))
    moved = F.replace(name, F.lit("input/"), F.lit("output/"))
    base = F.concat(F.lit("output/"), F.regexp_extract(name, r"([^/]*)$", 1))
    return F.concat(store, F.when(moved == name, base).otherwise(moved))


def result_to_json(df: DataFrame) -> DataFrame:
    """Each row as a JSON array text; numbers stay numbers, dates become
    ISO text, missing values ``null``."""
    cells = []
    for f in df.schema.fields:
        c = F.col(f.name)
        kind = f.dataType.simpleString()
        if kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            c = F.replace(c.cast("string"), F.lit(" "), F.lit("T"))
        # the one element of a JSON array text, without the brackets
        text = F.to_json(F.array(c))
        cells.append(F.when(c.isNull(), F.lit("null")).otherwise(F.substring(text, F.lit(2), F.length(text) - 2)))
    return df.select(F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]")).alias("json"))


def to_columnar(df: DataFrame, path: str, columns=None, mode: str = "overwrite") -> None:
    """Keep only the needed columns and write compressed Parquet."""
    (df.select(*columns) if columns else df).write.mode(mode).option("compression", "zstd").parquet(path)


def with_day_columns(df: DataFrame, day: Column) -> DataFrame:
    """Add ``year``, ``month``, ``day`` partition columns from a DATE column
    (null when there is no day)."""
    out = df.withColumn("_day", day)
    return out.select(
        *[c for c in df.columns],
        F.year("_day").alias("year"),
        F.month("_day").alias("month"),
        F.dayofmonth("_day").alias("day"),
    )


def partition_by_day(df: DataFrame, day: Column, path: str, mode: str = "overwrite",
                     files_per_day: int | None = None, keep_null_days: bool = False,
                     extra_partitions=()) -> None:
    """Write with physical ``year/month/day`` folders; filters and joins
    on them prune files (static and dynamic partition pruning).

    Rows are rebalanced on the partition columns (the ``REBALANCE`` hint):
    small days share a task, so unsorted input doesn't give a file per task
    and day, and a day larger than the advisory partition size is split over
    several tasks. ``files_per_day`` instead shuffles rows to (day, salt) with
    a deterministic row-hash salt, giving about that many files per day.
    """
    out = with_day_columns(df, day)
    if not keep_null_days:
        out = out.where(F.col("year").isNotNull())
    parts = [*extra_partitions, "year", "month", "day"]
    if files_per_day:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_day))
        out = out.repartition(*[F.col(c) for c in parts], salt)
    else:
        out = out.hint("rebalance", *[F.col(c) for c in parts])
    out.write.mode(mode).partitionBy(*parts).parquet(path)


def scan_lines_partitioned(spark: SparkSession, path, partitions: int) -> DataFrame:
    """The input split into a given number of partitions of lines."""
    return scan_lines(spark, path).repartition(partitions)


def scan_line_chunks(spark: SparkSession, path, lines_per_chunk: int) -> DataFrame:
    """The lines with their place: ``file``, ``block`` (start of the input
    split in the file), ``chunk`` (of ``lines_per_chunk`` lines, counted from 0
    in each block), ``line`` (number in the block, from 0) and ``value``.

    A split is read by one task in order, so its lines are numbered as they
    come, and nothing is shuffled; (file, block, chunk) names a bounded batch
    of consecutive lines. Split sizes follow ``spark.sql.files.maxPartitionBytes``.
    Blank lines are left out (S7)."""
    if lines_per_chunk < 1:
        raise ValueError("a chunk holds at least one line")
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = skip_blank_lines(spark.read.text(path).select(*place, "value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen = None, 0  # the block of the last line, and its lines so far
        for batch in batches:
            files = batch.column("file").dictionary_encode()
            codes, starts = files.indices.to_numpy(), batch.column("block").to_numpy()
            first = np.flatnonzero(np.diff(codes, prepend=-1) | np.diff(starts, prepend=-1))
            sizes = np.diff(first, append=batch.num_rows)
            number = np.arange(batch.num_rows) - np.repeat(first, sizes)
            if batch.num_rows:
                if (files[0].as_py(), int(starts[0])) == at:
                    number[: sizes[0]] += seen
                at, seen = (files[-1].as_py(), int(starts[-1])), int(number[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(number // lines_per_chunk), pa.array(number), batch.column("value")],
                names=["file", "block", "chunk", "line", "value"])

    return lines.mapInArrow(run, "file string, block long, chunk long, line long, value string")
