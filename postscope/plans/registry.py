"""Run a named question with a named strategy over an input path.

``strategy="time"`` reads with the fixed schema (malformed lines become
nulls and carry nothing) and takes the UTC day. ``strategy="memory"`` keeps
the typed-reader rules: lines are parsed strictly with exact JSON types (V14),
a post must be valid for the question (V13), the question runs in its strict
form, and Q1 takes the day written in the text (its first ten characters, V1). Both are the same kind of Spark plan;
the names are kept so existing callers can switch.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postscope.operators.aggregate import top_k
from postscope.plans import questions as Q
from postscope.plans.events import append_event, event_frame
from postscope.plans.profiles import observe_integrity
from postscope.sources.posts import REASON_INVALID, REASON_MALFORMED, REASON_NOT_OBJECT, scan_posts, scan_posts_strict

QUESTIONS = {
    ("q1", "time"): lambda p, k: Q.top_days_top_user(p, k),
    ("q1", "memory"): lambda p, k: Q.top_days_top_user(p, k, day_mode="prefix", strict=True),
    ("q2", "time"): lambda p, k: Q.top_emojis(p, k, "property"),
    ("q2", "memory"): lambda p, k: Q.top_emojis(p, k, "range"),
    ("q3", "time"): lambda p, k: Q.top_mentioned(p, k),
    ("q3", "memory"): lambda p, k: Q.top_mentioned(p, k, strict=True),
}


def posts_for(spark: SparkSession, question: str, strategy: str, path) -> DataFrame:
    if strategy == "time":
        return scan_posts(spark, path)
    return scan_posts_strict(spark, path, question=question).where(F.col("reject_reason").isNull())


def run(spark: SparkSession, question: str = "q1", strategy: str = "time", path=None, k: int = 10) -> DataFrame:
    """The answer as a DataFrame; unknown names or a missing path raise."""
    fn = QUESTIONS.get((question, strategy))
    if fn is None:
        raise ValueError(
            f"unknown question/strategy {question!r}/{strategy!r}; one of {sorted(QUESTIONS)}"
        )
    if not path:
        raise ValueError("a file path is required")
    return fn(posts_for(spark, question, strategy, path), k)


def _observed(question: str, strategy: str, posts: DataFrame, k: int) -> tuple[DataFrame, Observation]:
    """The answer plus an Observation on the aggregate before the top-k (O2):
    ``total_dates`` for q1, ``unique_emojis`` for q2, ``unique_mentions`` for
    q3. Filled by the job that computes the answer."""
    strict = strategy == "memory"
    obs = Observation(f"{question}_{strategy}")
    one = F.count(F.lit(1))
    if question == "q1":
        day_mode = "prefix" if strict else "utc"
        days = Q.day_summaries(posts, day_mode, strict=strict).observe(obs, one.alias("total_dates"))
        return Q.answer_from_summaries(days, k), obs
    if question == "q2":
        counts = Q.emoji_counts(posts, "range" if strict else "property").observe(obs, one.alias("unique_emojis"))
        return top_k(counts, k, "n", ["emoji"]), obs
    if question == "q3":
        counts = Q.mention_counts(posts, strict).observe(obs, one.alias("unique_mentions"))
        return top_k(counts, k, "n", ["username"]), obs
    raise ValueError(f"unknown question {question!r}")


def run_logged(spark: SparkSession, question: str = "q1", strategy: str = "time", path=None,
               k: int = 10, log_path: str | None = None, integrity: bool = False) -> tuple[list, DataFrame]:
    """O1-O3 around T2: the answer rows and the run's event (one row): context
    (file, question, strategy), steps, metrics (output rows and the
    question's key count) and rejected lines by reason as errors. With
    ``integrity`` the metrics also hold the integrity counters (D13) of the posts
    that the question runs on; the same job counts them, but reads all fields of
    the posts for it. A failure is recorded as an error event and raised."""
    marks = [("start", time.perf_counter())]
    context = {"file_path": path, "question": question, "strategy": strategy}
    metrics, errors, rows, failure = {}, [], [], None
    try:
        if (question, strategy) not in QUESTIONS:
            raise ValueError(f"unknown question/strategy {question!r}/{strategy!r}")
        if not path:
            raise ValueError("a file path is required")
        rejects = None
        if strategy == "memory":
            rejects = Observation(f"{question}_rejects")
            parsed = scan_posts_strict(spark, path, question=question).observe(
                rejects, *(F.count_if(F.col("reject_reason") == r).alias(r) for r in (REASON_MALFORMED, REASON_NOT_OBJECT, REASON_INVALID)))
            posts = parsed.where(F.col("reject_reason").isNull())
        else:
            posts = scan_posts(spark, path)
        counters = None
        if integrity:
            posts, counters = observe_integrity(posts, f"{question}_integrity")
        frame, keys = _observed(question, strategy, posts, k)
        marks.append(("build_query_plan", time.perf_counter()))
        rows = frame.collect()
        marks.append(("execution_collect", time.perf_counter()))
        metrics = {**keys.get, "output_rows": len(rows), **(counters.get if counters else {})}
        if rejects is not None:
            errors = [(reason, f"{n} lines rejected", n) for reason, n in sorted(rejects.get.items()) if n]
    except Exception as e:  # recorded, then raised below
        failure = e
        errors.append((type(e).__name__, str(e), None))
        marks.append(("failed", time.perf_counter()))
    event = event_frame(spark, f"{question}_{strategy}_execution", "error" if failure else "success", context, marks, metrics, errors)
    if log_path:
        append_event(event, log_path)
    if failure:
        raise failure
    return rows, event


def answer(spark: SparkSession, question: str, strategy: str, path, k: int = 10) -> list[tuple]:
    """The answer as a list of tuples (dates as ``datetime.date``): the
    action at the edge, for callers that want plain values."""
    return [tuple(r) for r in run(spark, question, strategy, path, k).collect()]


def _named(question: str, strategy: str):
    def fn(spark: SparkSession, path, k: int = 10) -> list[tuple]:
        return answer(spark, question, strategy, path, k)

    fn.__name__ = f"{question}_{strategy}"
    fn.__doc__ = f"{question.upper()} with the {strategy} strategy; list of tuples."
    return fn


# One function per (question, strategy), for callers switching from the
# six-function interface: ``q1_time(spark, path)`` and so on.
q1_time, q1_memory = _named("q1", "time"), _named("q1", "memory")
q2_time, q2_memory = _named("q2", "time"), _named("q2", "memory")
q3_time, q3_memory = _named("q3", "time"), _named("q3", "memory")
