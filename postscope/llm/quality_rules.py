"""Quality rules with risk-controlled thresholds.

Simple text statistics become rejection rules whose cutoffs are chosen on
labelled documents: per stratum (language), a cutoff is admissible when the
exact (Clopper-Pearson) upper bound of the share of good documents that it
rejects stays under the rule's part of ``alpha``. The bounds hold at once for
all strata, rules and cutoffs (Bonferroni). Of the admissible cutoffs of a
rule the one with the largest margin between the lower bound of the share of
bad documents caught and that upper bound is used, if the margin is positive;
otherwise the rule stays off in that stratum, so with few labels nothing is
rejected beyond the fixed base rules.

Null text has no words and fails the base rule. Every labelled language is a
stratum, null too; where a language has no labels only the base rules act.
Repeated rows
are judged one by one (each labelled row counts once per label row; a
document with both labels counts as good). Statistics travel in columns named
``__q_*``; every other column passes through untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postscope.llm.common import Scratch, arrow_map, texts

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def q(name: str) -> Column:
    return F.col(f"__q_{name}")




def rules() -> dict[str, tuple[Column, tuple[float, ...]]]:
    """Rule -> (value, cutoffs); a document is rejected when value > cutoff."""
    words = F.greatest(q("n_words"), F.lit(1))
    return {
        "symbols_per_word": (q("n_symbols") / words, (0.02, 0.05, 0.1, 0.2, 0.4, 0.8, 1.6)),
        "duplicate_lines": (q("n_dup_lines") / F.greatest(q("n_lines"), F.lit(1)), (0.1, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9)),
        "repeated_words": (q("n_repeat_words") / words, (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.45)),
        "word_length": (q("word_chars") / words, (8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0)),
    }


@dataclass(frozen=True)
class Policy:
    alpha: float = 0.05  #: bound of the share of good documents rejected per stratum, by all rules together
    delta: float = 0.05  #: chance that any bound fails
    min_words: int = 50
    max_repeat_percent: int = 50


def statistics(text: str) -> tuple[int, ...]:
    """STATS of one text; words are runs of anything but ASCII white space."""
    words = text.encode().split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    repeated = 0
    if n >= 4:
        ids: dict[bytes, int] = {}
        code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
        k = len(ids)
        pair = code[:-1] * k + code[1:]
        if k < 2_000_000:  # k ** 3 fits 63 bits
            window = pair[:-1] * k + code[2:]
        else:
            window = np.unique(pair, return_inverse=True)[1][:-1].astype(np.int64) * k + code[2:]
        order = np.argsort(window, kind="stable")
        same = window[order][1:] == window[order][:-1]
        twice = np.zeros(n - 2, dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(n, dtype=bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= twice
        repeated = int(covered.sum())
    return n, word_chars, n_symbols, len(lines) - len(set(lines)), repeated, len(lines)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every column of ``docs`` plus ``__q_<stat>`` (long)."""
    own = [f"__q_{s}" for s in STATS]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType(), False) for c in own)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([statistics(t) for t in texts(batch, text)], dtype=np.int64).reshape(-1, len(STATS))
        columns = [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(len(STATS))]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *own])

    return arrow_map(docs, run, schema)


def base_failed(policy: Policy = Policy()) -> Column:
    return (q("n_words") < policy.min_words) | (100 * q("n_repeat_words") > policy.max_repeat_percent * q("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p)."""
    if p <= 0:
        return 1.0
    if p >= 1:
        return float(k >= n)
    i = np.arange(k + 1)
    lg = np.array([math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1) for x in i.tolist()])
    return float(min(1.0, np.exp(lg + i * math.log(p) + (n - i) * math.log1p(-p)).sum()))


def upper_bound(k: int, n: int, delta: float) -> float:
    """Exact one-sided upper confidence bound of a share, k of n seen."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(40):
        mid = (low + high) / 2
        low, high = (low, mid) if binomial_tail(k, n, mid) < delta else (mid, high)
    return high


def lower_bound(k: int, n: int, delta: float) -> float:
    return 1 - upper_bound(n - k, n, delta) if n else 0.0


def best_cutoffs(by_bin: list[np.ndarray], choices: list[tuple[float, ...]], policy: Policy, tests: int) -> list[float | None]:
    """The cutoff of each rule in one stratum, None where it stays off.
    ``by_bin``: (bad, good) labelled documents per bin of each rule."""
    out = []
    for seen, cuts in zip(by_bin, choices, strict=True):
        n_bad, n_good = seen.sum(axis=0).tolist()
        best = (0.0, None)
        for j, cut in enumerate(cuts):
            bad, good = seen[j + 1 :].sum(axis=0).tolist()
            false = upper_bound(good, n_good, policy.delta / tests)
            margin = lower_bound(bad, n_bad, policy.delta / tests) - false
            if false <= policy.alpha / len(choices) and margin >= best[0] and margin > 0:
                best = (margin, cut)
        out.append(best[1])
    return out


def cutoffs(docs: DataFrame, labels: DataFrame, policy: Policy = Policy(), text: str = "text", lang: str = "lang") -> DataFrame:
    """``__q_stratum`` and ``__q_cuts`` (per rule, null where it is off) of every
    labelled language, from all labelled documents.

    ``labels``: doc_id, quality (1 good, 0 bad). The driver receives the number
    of strata only.
    """
    scratch = Scratch(docs.sparkSession, "quality-rules")
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("__good"))
    stats = with_statistics(docs.select("doc_id", F.col(lang).alias("__lang"), F.col(text).alias("__text")), "__text")
    marked = stats.where(~base_failed(policy)).drop("__text").join(marks, "doc_id")
    named = rules()
    choices = [cuts for _, cuts in named.values()]
    bins = F.explode(F.array(*(
        F.struct(F.lit(i).alias("rule"), sum((v > c).cast("int") for c in cuts).alias("bin")) for i, (v, cuts) in enumerate(named.values())
    ))).alias("b")
    counted = (marked.select(F.col("__lang").alias("__q_stratum"), (F.col("__good") == 1).cast("int").alias("good"), bins)
               .groupBy("__q_stratum", "b.rule", "b.bin", "good").agg(F.count("*").alias("n")))
    seen = scratch.write(counted.groupBy("__q_stratum").agg(F.collect_list(F.struct("rule", "bin", "good", "n")).alias("seen")))
    tests = max(1, seen.count()) * sum(map(len, choices)) * 2  # an upper and a lower bound each

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for rows in batch.column("seen").to_pylist():
            by_bin = [np.zeros((len(cuts) + 1, 2), dtype=np.int64) for cuts in choices]
            for r in rows:
                by_bin[r["rule"]][r["bin"], r["good"]] += r["n"]
            out.append(best_cutoffs(by_bin, choices, policy, tests))
        return pa.RecordBatch.from_arrays([batch.column("__q_stratum"), pa.array(out, type=pa.list_(pa.float64()))], names=["__q_stratum", "__q_cuts"])

    found = scratch.write(arrow_map(seen, run, T.StructType([seen.schema["__q_stratum"], T.StructField("__q_cuts", T.ArrayType(T.DoubleType()))])))
    scratch.keep(found)
    return found


def calibrate(docs: DataFrame, labels: DataFrame, policy: Policy = Policy(), text: str = "text",
              lang: str = "lang") -> dict[str | None, dict[str, float]]:
    """Stratum -> rule -> cutoff, of ``cutoffs``, for inspection."""
    return {r["__q_stratum"]: {rule: cut for rule, cut in zip(rules(), r["__q_cuts"], strict=True) if cut is not None}
            for r in cutoffs(docs, labels, policy, text, lang).collect()}


def verdict(cuts: Column) -> Column:
    """True where every rule with a cutoff lets the document pass."""
    return ~F.coalesce(F.greatest(F.lit(False), *(v > F.get(cuts, F.lit(i)) for i, (v, _) in enumerate(rules().values()))), F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, policy: Policy = Policy(), text: str = "text", lang: str = "lang") -> DataFrame:
    """Every column of ``docs``, the ``__q_*`` statistics, ``__q_base_failed``
    and ``__q_kept``."""
    # only languages with a rule; the planner knows the written table's size
    found = cutoffs(docs, labels, policy, text, lang).where(F.exists("__q_cuts", lambda c: c.isNotNull()))
    judged = with_statistics(docs, text).join(found, F.col(lang).eqNullSafe(F.col("__q_stratum")), "left")
    return judged.withColumns({
        "__q_base_failed": base_failed(policy),
        "__q_kept": ~base_failed(policy) & verdict(F.col("__q_cuts")),
    }).drop("__q_stratum", "__q_cuts")


def keep_good(docs: DataFrame, labels: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    return judge(docs, labels, policy).where("__q_kept").select(*docs.columns)
