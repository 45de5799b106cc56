"""Quality classifier: a factorisation machine over hashed features.

Features of a text: hashed lower-cased words (weight sqrt(count / words)),
bucketed structure statistics and metadata (the recorded length). Besides a
weight per feature the model holds ``factors`` numbers per feature; the dot
product of two features' numbers weighs their co-occurrence, and all pairs are
summed in linear time by 1/2 * sum_f((sum v x)^2 - sum (v x)^2).

The model is fitted on at most ``Settings.sample`` labelled rows, those with
the smallest hash of their id (a documented bound). A document labelled twice
takes its smaller label; rows with a null id or label don't train. Null and
empty texts have structure features only and get a score like any other. With
labels of one class only, or none, the score is that class's share (0.5
without labels).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postscope.llm.common import WordHashes, arrow_map, texts
from postscope.llm.quality_rules import statistics


@dataclass(frozen=True)
class Settings:
    sample: int = 6000  #: most labelled rows fitted on
    bits: int = 16  #: words are hashed to 2 ** bits features
    factors: int = 4
    steps: int = 60
    rate: float = 0.05
    decay: float = 1e-4
    seed: int = 11


BUCKETS = 32  # per structure field
FIELDS = 9


@lru_cache(maxsize=1)
def hashes() -> WordHashes:
    return WordHashes()


def features(text: str, n_chars: int | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (distinct, ascending) and values."""
    words = text.encode().lower().split()
    n, word_chars, n_symbols, n_dup, n_repeat, n_lines = statistics(text)
    found = np.fromiter(map(hashes().__getitem__, words), dtype=np.uint64, count=n)
    index, counts = np.unique(found >> np.uint64(64 - bits), return_counts=True)
    some = max(n, 1)
    log = lambda x: min(BUCKETS - 1, int(x).bit_length())
    share = lambda x: min(BUCKETS - 1, int(20 * x + 0.999))  # noqa: E731  0 only for none
    fields = (
        log(n), share(n_symbols / some), share(n_repeat / some), share(n_dup / max(n_lines, 1)),
        min(BUCKETS - 1, int(word_chars / some)), share(1 - len(index) / some), log(some // max(n_lines, 1)),
        share(sum(map(text.count, "0123456789")) / max(len(text), 1)),
        BUCKETS - 1 if n_chars is None else min(BUCKETS - 2, log(max(n_chars, 0))),
    )
    own = (1 << bits) + np.arange(FIELDS) * BUCKETS + np.array(fields)
    return np.r_[index.astype(np.int64), own], np.r_[np.sqrt(counts / some), np.full(FIELDS, 1.0)].astype(np.float32)


class Machine:
    def __init__(self, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.settings, size = settings, (1 << settings.bits) + FIELDS * BUCKETS
        self.bias = np.float32(0)
        self.w = np.zeros(size, dtype=np.float32)
        self.v = rng.normal(0, 0.02, (size, settings.factors)).astype(np.float32)

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        vx = self.v[index] * value[:, None]
        z = self.bias + self.w[index] @ value + 0.5 * float((vx.sum(axis=0) ** 2 - (vx**2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
        """Full-batch Adam on the logistic loss; touches the seen features only."""
        y = labels.astype(np.float32)
        if not len(y) or y.min() == y.max():
            share = np.clip(y.mean(), 1e-6, 1 - 1e-6) if len(y) else 0.5
            self.bias, self.v = np.float32(np.log(share / (1 - share))), self.v * 0
            return self
        seen, column = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
        x = np.concatenate([r[1] for r in rows])
        sizes = np.array([len(r[0]) for r in rows])
        first, row = np.r_[0, np.cumsum(sizes)[:-1]], np.repeat(np.arange(len(rows)), sizes)
        s, k, m = self.settings, self.settings.factors, len(seen)
        theta = np.concatenate([self.w[seen, None], self.v[seen]], axis=1)
        bias = float(np.log(y.mean() / (1 - y.mean())))
        one, two, b_one, b_two = np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0
        for t in range(1, s.steps + 1):
            vx = theta[column, 1:] * x[:, None]
            sums = np.add.reduceat(vx, first, axis=0)
            z = bias + np.add.reduceat(theta[column, 0] * x, first) + 0.5 * ((sums**2).sum(1) - np.add.reduceat((vx**2).sum(1), first))
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
            gx = g[row] * x
            grad = np.empty_like(theta)
            grad[:, 0] = np.bincount(column, gx, minlength=m)
            for f in range(k):
                grad[:, f + 1] = np.bincount(column, gx * (sums[row, f] - vx[:, f]), minlength=m)
            grad += s.decay / len(y) * theta
            one, two = 0.9 * one + 0.1 * grad, 0.999 * two + 0.001 * grad**2
            theta = theta - s.rate * (one / (1 - 0.9**t)) / (np.sqrt(two / (1 - 0.999**t)) + 1e-8)
            b_one, b_two = 0.9 * b_one + 0.1 * g.sum(), 0.999 * b_two + 0.001 * g.sum() ** 2
            bias -= s.rate * (b_one / (1 - 0.9**t)) / (np.sqrt(b_two / (1 - 0.999**t)) + 1e-8)
        self.bias = np.float32(bias)
        self.v = self.v * 0  # numbers of unseen features are chance
        self.w[seen], self.v[seen] = theta[:, 0], theta[:, 1:]
        return self


def train(docs: DataFrame, labels: DataFrame, training: Column, settings: Settings = Settings(), text: str = "text") -> Machine:
    """``labels``: doc_id and quality; ``training``: condition on doc_id."""
    chosen = (labels.where("doc_id is not null and quality is not null").where(training)
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample).collect())
    marks, bits = {r.doc_id: r.quality for r in chosen}, settings.bits

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [(i, *features(t or "", c, bits)) for i, t, c in zip(
                    part.column("doc_id").to_pylist(), part.column("__text").to_pylist(), part.column("__chars").to_pylist(), strict=True)
                    if i in marks]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in rows], type=pa.int64()), pa.array([r[1] for r in rows], type=pa.list_(pa.int64())),
                    pa.array([r[2] for r in rows], type=pa.list_(pa.float32()))], names=["doc_id", "index", "value"])

    rows = docs.select("doc_id", F.col(text).alias("__text"), chars(docs)).mapInArrow(
        run, "doc_id long, index array<long>, value array<float>")
    # a repeated id trains once, so the bound on the sample holds
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("index", "value")).alias("x")).select("doc_id", "x.index", "x.value").toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    found = [(np.asarray(rows.column("index")[i].values), np.asarray(rows.column("value")[i].values)) for i in order.tolist()]
    ids = rows.column("doc_id").to_numpy()[order]
    return Machine(settings).fit(found, np.array([marks[i] == 1 for i in ids.tolist()], dtype=bool))


def chars(docs: DataFrame) -> Column:
    """The recorded length, null where the table has none."""
    return (F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)).cast("long").alias("__chars")


def score(docs: DataFrame, machine: Machine, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of every row."""
    sub = docs.select(*keep, F.col(text).alias("__text"), chars(docs))
    kept = docs.select(*keep).schema
    n, bits, held = len(kept.fields), machine.settings.bits, docs.sparkSession.sparkContext.broadcast(machine)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = held.value
        out = [m.score(*features(t, c, bits)) for t, c in zip(texts(batch, "__text"), batch.column("__chars").to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(out, type=pa.float64())], names=[*batch.schema.names[:n], "score"])

    return arrow_map(sub, run, kept.add("score", "double"))
