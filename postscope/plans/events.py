"""Run events (O1-O3): one row per run of a question.

An event is built once, at the end of a run, from plain values: wall times
between marks, counts that ``Observation`` metrics collected during the job
(so logging adds no Spark job), and rejected lines as typed errors that don't
stop the run. It is stored by appending the row to a JSON or Parquet folder.
"""

from __future__ import annotations

import resource
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

EVENT_DDL = (
    "event STRING, status STRING, total_duration_ms DOUBLE, "
    "memory_usage STRUCT<driver_python_peak_mb: DOUBLE, driver_jvm_used_mb: DOUBLE>, "
    "context MAP<STRING, STRING>, metrics MAP<STRING, DOUBLE>, steps MAP<STRING, DOUBLE>, "
    "errors ARRAY<STRUCT<type: STRING, message: STRING, lines: BIGINT>>"
)


def driver_memory(spark: SparkSession) -> tuple[float, float | None]:
    """Peak memory of the driver's Python process and heap in use in its JVM
    (null without a JVM handle); executors report their own metrics."""
    peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return round(peak, 2), None
    runtime = jvm.java.lang.Runtime.getRuntime()
    return round(peak, 2), round((runtime.totalMemory() - runtime.freeMemory()) / 2**20, 2)


def event_frame(spark: SparkSession, name: str, status: str, context: Mapping[str, object],
                marks: Sequence[tuple[str, float]], metrics: Mapping[str, float | None] = {},
                errors: Sequence[tuple[str, str, int | None]] = ()) -> DataFrame:
    """The event as a one-row frame. ``marks`` are (name of the step that ends
    there, clock in seconds); the first one only starts the clock."""
    times = {after[0]: round((after[1] - before[1]) * 1000, 4) for before, after in zip(marks, marks[1:])}
    row = (
        name, status, round((marks[-1][1] - marks[0][1]) * 1000, 4), driver_memory(spark),
        {k: str(v) for k, v in context.items()}, {k: float(v) for k, v in metrics.items() if v is not None},
        times, [tuple(e) for e in errors],
    )
    return spark.createDataFrame([row], EVENT_DDL)


def append_event(event: DataFrame, path: str, fmt: str = "json") -> None:
    event.write.mode("append").format(fmt).save(path)
