"""One thin query per operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postscope.llm import (byte_bpe, importance, language_id, line_dedup, ngram_join, periodic_runs, pii_disclosure, poisson_mix, quality_fm, quality_rules,
                           secret_scan, spotsigs, suffix_dedup)
from postscope.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary() -> tuple[str, str]:
    """Path of the byte-level vocabulary file and the splitting pattern."""
    import public_tokenizers as P

    return P.path("byte_bpe_50k.json"), P.PATTERN


@register
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def span_text(spans):
    """kind:start:end of each span, comma-joined in the given order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@register
def op2_secret_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["base"])
    return found.select(
        "doc_id",
        *(count_kind(base, k).alias(f"n_{k}") for k in secret_scan.KINDS),
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"))


@register
def op3_spotsigs_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited(table(spark, sf_dir, "documents"))


@register
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), *vocabulary())


@register
def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = poisson_mix.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.col("__n").alias("n_copies"), F.col("__copy").alias("copy"), F.col("__place").alias("place"), "text")


ORACLE_SQL["op5_poisson_mix"] = poisson_mix.SQL.strip()


@register
def op6_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@register
def op7_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.marked(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.col("__lines").cast("long").alias("n_lines"), F.size("__drops").cast("long").alias("n_dropped"),
                       line_dedup.without(F.col("text"), F.col("__drops")).alias("text"))


@register
def op8_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    judged = quality_rules.judge(docs, table(spark, sf_dir, "labels"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *(F.col(f"__q_{n}").alias(n) for n in names))


@register
def op9_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = quality_fm.train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    scored = quality_fm.score(docs, machine)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register
def op10_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_disclosure.find(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["kind"] != pii_disclosure.TERM)
    return found.select(
        "doc_id", *(count_kind(base, k).alias(f"n_{k}") for k in pii_disclosure.KINDS),
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"))


#: White space between the words of op11, as a regular expression.
_BLANKS = r"[\x20\x09-\x0D]+"


def planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and ``text``. With h the crc32 of the decimal id and g = h div
    10: where h ends in 0, every word from a = g mod n on becomes original
    word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Rows with a null
    id and texts without a word stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.when(F.pmod(h, F.lit(10)) == 0, F.filter(F.split("text", _BLANKS), lambda w: w != ""))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("__g"), chosen.alias("__words"))
    n = F.size("__words")
    rows = rows.withColumn("__a", F.when(n > 0, F.pmod("__g", F.nullif(n, F.lit(0)))).cast("int"))
    rows = rows.withColumn("__p", (F.lit(1) + F.floor((n - F.col("__a")) / (F.lit(3) + F.pmod("__g", F.lit(8))))).cast("int"))
    changed = F.transform("__words", lambda w, i: F.when(i < F.col("__a"), w).otherwise(
        F.get("__words", F.col("__a") + F.pmod(i - F.col("__a"), F.col("__p")))))
    return rows.select("doc_id", F.when(F.col("__a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


@register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(planted_repeats(table(spark, sf_dir, "documents")))
    best = periodic_runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("__best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col("__best")[c].alias(c) for c in ("start", "length", "period")),
        F.expr("(1000 * __best.length) div __best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@register
def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", suffix_dedup.n_removed(F.col("spans")).alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=("doc_id",))


ORACLE_SQL["op13_importance_resampling"] = importance.sql().strip()
