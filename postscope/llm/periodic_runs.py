"""Periodic runs of words by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and a length of at least ``max(Settings.shortest,
Settings.times * q)`` that no neighbouring word extends keeping period q. Each
of its words occurs at least ``times`` times within it. So words that are
rarer than that within a segment (at first the whole document) belong to no
run: they split the segment, the parts are counted anew, and so on until
nothing splits any more. Parts shorter than ``shortest`` go. The segments that
survive are scanned lag by lag.

A lag q is probed at the multiples of q only: the words of a run that repeat
q words later cover at least two neighbouring multiples. Hits are extended
both ways. So a segment of n words costs about n log n comparisons plus the
lengths of the stretches found, also where one word fills a long text.

Words are runs of bytes other than ASCII white space, compared as bytes, whole
texts. Null text reads as empty: no words, no runs, empty collapsed text.
Texts are independent of each other; repeated rows each get their own result.
Runs are in order of (start, period). Columns listed in ``keep`` pass through;
none may be called like a result column.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postscope.llm.common import arrow_map, texts

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
OWN = ("n_words", "runs", "collapsed")


@dataclass(frozen=True)
class Settings:
    shortest: int = 24
    times: int = 3

    def __post_init__(self):
        if self.times < 3:
            raise ValueError("a run repeats its period at least three times")


def segments(words: np.ndarray, text: np.ndarray, settings: Settings) -> list[tuple[int, int]]:
    """(start, end) of the stretches that survive the splitting. ``words`` are
    word numbers of several texts in a row, ``text`` the text of each."""
    out = []
    at, part = np.arange(len(words)), text.astype(np.int64)
    span = int(words.max(initial=0)) + 1
    while len(at):
        # the parts of this level: no gap, one text
        first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        first = np.union1d(first, np.flatnonzero(np.diff(part, prepend=-1)))
        sizes = np.diff(first, append=len(at))
        number = np.repeat(np.arange(len(first)), sizes)
        enough = (sizes >= settings.shortest)[number]
        at, number = at[enough], number[enough]
        if not len(at):
            break
        _, place, n = np.unique(number * span + words[at], return_inverse=True, return_counts=True)
        rare = n[place] < settings.times
        splits = np.zeros(len(first), dtype=bool)
        splits[number[rare]] = True
        for k in np.flatnonzero(~splits & (sizes >= settings.shortest)):
            lo = np.searchsorted(number, k)
            out.append((int(at[lo]), int(at[lo]) + int(sizes[k])))
        again = splits[number] & ~rare
        at, part = at[again], number[again]
    return out


def extent(x: np.ndarray, q: int, i: int) -> tuple[int, int]:
    """The stretch of positions around ``i`` whose word repeats q words later."""
    n, hi, lo, step = len(x) - q, i, i, 64
    while hi < n:
        differs = x[hi : min(hi + step, n)] != x[hi + q : min(hi + step, n) + q]
        k = int(differs.argmax())
        if differs[k]:
            hi += k
            break
        hi, step = hi + len(differs), 2 * step
    step = 64
    while lo > 0:
        low = max(lo - step, 0)
        differs = (x[low:lo] != x[low + q : lo + q])[::-1]
        k = int(differs.argmax())
        if differs[k]:
            lo -= k
            break
        lo, step = low, 2 * step
    return lo, hi


def lag_scan(x: np.ndarray, settings: Settings) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a segment of word numbers.

    Lags ascend, so a stretch is met first at its smallest period. By the
    theorem of Fine and Wilf every other period of it (at a third of its
    length or less) is a multiple of that one, and a stretch of lag q with
    2 q + 1 words inside a run whose period divides q is that run."""
    n, out, met = len(x), [], set()
    known: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
    for q in range(1, n // settings.times + 1):
        same = x[: n - q : q] == x[q::q]
        hits = (same[:-1] & same[1:]).nonzero()[0]
        if not len(hits):
            continue
        hits, k = hits * q, 0
        while k < len(hits):
            i, inside = int(hits[k]), 0
            for p, (starts, ends) in known.items():
                if q % p == 0 and (j := bisect_right(starts, i) - 1) >= 0 and ends[j] > i + 2 * q:
                    inside = ends[j]
            if inside:
                k = int(np.searchsorted(hits, inside - 2 * q))
                continue
            lo, hi = extent(x, q, i)
            k = int(np.searchsorted(hits, hi))
            length = hi + q - lo
            if length >= max(settings.shortest, settings.times * q) and (lo, length) not in met:
                met.add((lo, length))
                out.append((lo, length, q))
                known[q][0].append(lo)
                known[q][1].append(lo + length)
    return out


def runs_of(rows: list[list[bytes]], settings: Settings = Settings()) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each list of words."""
    number = defaultdict(count().__next__)
    sizes = [len(r) for r in rows]
    words = np.fromiter(map(number.__getitem__, chain.from_iterable(rows)), dtype=np.int64, count=sum(sizes))
    starts = np.cumsum([0, *sizes])
    out: list[list] = [[] for _ in rows]
    for lo, hi in segments(words, np.repeat(np.arange(len(rows)), sizes), settings):
        of = bisect_right(starts, lo) - 1
        shift = lo - int(starts[of])
        out[of] += [(s + shift, n, q) for s, n, q in lag_scan(words[lo:hi], settings)]
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False where a word lies in a run beyond that run's first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def find(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), settings: Settings = Settings()) -> DataFrame:
    """``keep`` columns, ``n_words`` long, ``runs`` array of (start, length,
    period) and ``collapsed``, the words that no run repeats, joined by one
    space."""
    if set(OWN) & set(keep):
        raise ValueError(f"column names taken by the result: {sorted(set(OWN) & set(keep))}")
    fields = docs.select(*keep).schema.fields
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)),
                           T.StructField("collapsed", T.StringType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [t.encode().split() for t in texts(batch, "__text")]
        found = runs_of(rows, settings)
        left = [b" ".join(r if not f else [w for w, k in zip(r, kept(len(r), f).tolist(), strict=True) if k])
                for r, f in zip(rows, found, strict=True)]
        offsets = pa.array(np.cumsum([0, *map(len, found)]), type=pa.int32())
        flat = np.array(list(chain.from_iterable(found)), dtype=np.int64).reshape(-1, 3)
        structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=[
            pa.field(f.name, pa.int64(), False) for f in RUN.fields])
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in range(len(fields))), pa.array(list(map(len, rows)), type=pa.int64()),
             pa.ListArray.from_arrays(offsets, structs), pa.array([b.decode() for b in left], type=pa.string())],
            names=[*(f.name for f in fields), *OWN])

    return arrow_map(docs.select(*keep, F.col(text).alias("__text")), run, schema)


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, the first by (start, period) of
    several; null where there is none."""
    better = lambda a, x: x["length"] * a["period"] > a["length"] * x["period"]
    return F.reduce(runs, F.get(runs, 0), lambda a, x: F.when(better(a, x), x).otherwise(a))


def collapse(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The rows with the repeated periods of every run cut out of ``text``.
    Texts without a run stay as they are, and so do all other columns."""
    rest = [c for c in docs.columns if c != text]
    names = {c: f"__k{i}" for i, c in enumerate(rest)}
    found = find(docs.select(F.col(text).alias("__whole"), *(F.col(c).alias(n) for c, n in names.items())), "__whole", ["__whole", *names.values()])
    new = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("__whole"))
    return found.select(*(new.alias(c) if c == text else F.col(names[c]).alias(c) for c in docs.columns))
