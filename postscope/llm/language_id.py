"""Language identification by rank-order profiles.

A language's profile is the ranking of its most frequent letter n-grams (one
to three characters, words padded with a space, counted over all training
texts). A document's own most frequent n-grams are ranked the same way; each
contributes how far its rank lies from the profile's (``size`` when missing),
and the language with the smallest out-of-place distance wins.

Ties: n-grams of equal count rank by code point, equal distances go to the
language that sorts first. Null text, text without a letter, or an empty
training set give ``und`` with score 0. Rows with a null language never train.
The score is 1 minus the distance divided by its largest possible value.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postscope.llm.common import arrow_map, texts

UNKNOWN = "und"
SPACE = 32
BITS = np.int64(21)  # of a code point


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def ngrams(text: str) -> np.ndarray:
    """Codes of all n-grams of 1 to 3 characters within space-padded words;
    empty if the text has no letter."""
    x = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = letters()[x]
    if not letter.any():
        return np.empty(0, dtype=np.int64)
    keep = letter | np.r_[True, letter[:-1]]  # one space between words
    x = np.where(letter, x, SPACE)[keep].astype(np.int64)
    space = x == SPACE
    pairs = (x[:-1] << BITS) | x[1:]
    inside = ~space[1:-1]
    triples = (pairs[:-1] << BITS) | x[2:]
    return np.concatenate((x[~space], pairs[~(space[:-1] & space[1:])], triples[inside]))


def ranked(text: str, size: int) -> np.ndarray:
    """The text's ``size`` most frequent n-grams, most frequent first."""
    codes, counts = np.unique(ngrams(text), return_counts=True)
    if len(codes) > size:  # those that can't be among the first go before the sort
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:size]


def profiles(docs: DataFrame, size: int = 300, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, gram, rank (from 0) over all rows of ``docs`` with a language.

    Tasks add up their own counts first, so a language with most of the rows
    sends one row per distinct n-gram and task."""

    def run(batches):
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                by: dict[str, list[np.ndarray]] = {}
                for t, name in zip(texts(part, "__text"), part.column("__lang").to_pylist(), strict=True):
                    by.setdefault(name, []).append(ngrams(t))
                for name, found in by.items():
                    codes, counts = np.unique(np.concatenate(found), return_counts=True)
                    if name in sums:
                        codes, where = np.unique(np.r_[sums[name][0], codes], return_inverse=True)
                        counts = np.bincount(where, weights=np.r_[sums[name][1], counts]).astype(np.int64)
                    sums[name] = codes, counts
        for name, (codes, counts) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(codes), type=pa.string()), pa.array(codes), pa.array(counts)], names=["lang", "gram", "n"])

    counted = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("__lang"), F.col(text).alias("__text")).mapInArrow(run, "lang string, gram long, n long")
    total = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return total.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size).select("lang", "gram", "rank")


class Matcher:
    """Profiles held for look-up: ``size`` rows per language."""

    def __init__(self, rows, size: int):
        self.size, by = size, {}
        for r in rows:
            by.setdefault(r.lang, []).append((r.gram, r.rank))
        self.langs = sorted(by)
        table = [np.array(sorted(by[x]), dtype=np.int64) for x in self.langs]
        self.grams, self.ranks = [t[:, 0].copy() for t in table], [t[:, 1].copy() for t in table]

    def predict(self, text: str) -> tuple[str, float]:
        own = ranked(text, self.size)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        place, distances = np.arange(len(own)), []
        for grams, ranks in zip(self.grams, self.ranks, strict=True):
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            distances.append(np.where(grams[at] == own, np.abs(ranks[at] - place), self.size).sum())
        best = int(np.argmin(distances))
        return self.langs[best], float(1 - distances[best] / (len(own) * self.size))


def identify(docs: DataFrame, training: Column, size: int = 300, text: str = "text", lang: str = "lang",
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred and score of every row; only rows where
    ``training`` holds are learned from. The driver receives the profiles:
    ``size`` rows per language."""
    matcher = Matcher(profiles(docs.where(training), size, text, lang).collect(), size)
    sub = docs.select(*keep, F.col(text).alias("__text"))
    kept = docs.select(*keep).schema
    n = len(kept.fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [matcher.predict(t) for t in texts(batch, "__text")]
        columns = [pa.array([o[0] for o in out], type=pa.string()), pa.array([o[1] for o in out], type=pa.float64())]
        return pa.RecordBatch.from_arrays([*batch.columns[:n], *columns], names=[*batch.schema.names[:n], "lang_pred", "score"])

    return arrow_map(sub, run, kept.add("lang_pred", "string").add("score", "double"))
