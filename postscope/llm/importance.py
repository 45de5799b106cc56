"""Importance resampling towards a target distribution.

Hashed n-gram features of the raw texts and of the target texts are counted by
bucket; a bucket's gain is its log ratio target / raw, in thousandths, with
one added to each count. A document's weight is the floored mean of its
features' gains, looked up in an array of all buckets; its score is the weight
plus Gumbel noise hashed from the seed and the document's id, so that the
documents with the highest scores are a sample without replacement in
proportion to exp(weight). Of the N documents with ``least_words`` or more,
``N * percent // 100`` are drawn.

The cutoff is bracketed by two quantiles of a mergeable sketch of the scores.
Exact counts above and within the bracket validate it; if the cutoff isn't
inside, the bracket is widened (at last to all scores), so the answer is exact
at any error of the sketch. Only the bracket is sorted to locate the cutoff.
Drawn documents get their rank from a range sort: their place in the
partition plus the sizes of the partitions before.

Lower-casing takes A-Z only. Words are runs of ASCII letters, digits and any
other character from U+0080 on. Null text reads as empty; without features the
weight is 0. A null id hashes as empty text and comes last among equal scores;
rows with equal score and id are ordered arbitrarily but fixed by the written
table. Repeated rows are documents of their own. Empty tables give no rows; an
empty target gives gains all the same. Columns listed in ``keep`` (all by
default) pass through; none may be called like a result column or start with
``__``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postscope.llm.common import ROWS, Scratch, texts

#: Runs of the bytes 0-9, A-Z, a-z and of all bytes beyond ASCII.
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
OWN = ("n_features", "weight", "score", "rank")


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000
    longest: int = 1  # words in a feature, at most
    least_words: int = 20
    percent: int = 10
    seed: str = "2024"


class Buckets(dict):
    """feature (bytes) -> bucket, remembered up to ``limit`` features."""

    def __init__(self, buckets: int, limit: int = 1 << 18):
        super().__init__()
        self.buckets, self.limit = buckets, limit

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[feature] = crc32(feature) % self.buckets
        return value


def features(text: str, longest: int) -> tuple[int, list[bytes]]:
    """Number of words, and all runs of 1 to ``longest`` words."""
    words = WORD.findall(text.encode().lower())  # bytes.lower() changes A-Z only
    if longest == 1:
        return len(words), words
    return len(words), [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def hashed(rows: list[str], of: Buckets, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and features per text, and the buckets of all features in a row."""
    found = [features(t, longest) for t in rows]
    n_words = np.array([n for n, _ in found], dtype=np.int64)
    n_features = np.array([len(f) for _, f in found], dtype=np.int64)
    flat = np.fromiter(map(of.__getitem__, chain.from_iterable(f for _, f in found)), dtype=np.int64, count=int(n_features.sum()))
    return n_words, n_features, flat


def bucket_counts(rows: DataFrame, settings: Settings, text: str = "text") -> DataFrame:
    """bucket int, n long: features of all texts by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = Buckets(settings.buckets), np.zeros(settings.buckets, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                total += np.bincount(hashed(texts(batch.slice(at, ROWS), "__text"), of, settings.longest)[2], minlength=settings.buckets)
        used = total.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(used, type=pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    return rows.select(F.col(text).alias("__text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Gain of every bucket, in thousandths, floored."""
    s, t = sum(raw.values()), sum(target.values())
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1) * (s + buckets) / ((raw.get(b, 0) + 1) * (t + buckets))))
                     for b in range(buckets)], dtype=np.int64)


def learn(raw: DataFrame, target: DataFrame, settings: Settings = Settings(), text: str = "text") -> np.ndarray:
    """The gains array. The driver receives a row per bucket and table."""
    one, two = ({r.bucket: r.n for r in bucket_counts(df, settings, text).collect()} for df in (raw, target))
    return gains(one, two, settings.buckets)


def weighted(docs: DataFrame, gain: np.ndarray, settings: Settings = Settings(), text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) plus n_features and weight; ``__words``
    has the number of words."""
    keep = docs.columns if keep is None else list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(settings.buckets)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n_words, n, flat = hashed(texts(part, "__text"), known, settings.longest)
                ends = np.cumsum(n)
                sums = np.concatenate([[0], np.cumsum(gain[flat])])
                weight = (sums[ends] - sums[ends - n]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(n), pa.array(weight), pa.array(n_words)],
                                                 names=[*keep, "n_features", "weight", "__words"])

    own = [T.StructField(c, T.LongType()) for c in ("n_features", "weight", "__words")]
    rows = docs.select(*keep, F.col(text).alias("__text"))
    return rows.mapInArrow(run, T.StructType([*docs.select(*keep).schema.fields, *own]))


def gumbel(doc_id: Column, seed: str) -> Column:
    """floor(-1000 ln(-ln u)), u from 32 bits of a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


ORDER = (F.desc, "score"), (F.asc_nulls_last, "doc_id"), (F.asc, "__row")


def ranked(rows: DataFrame, scratch: Scratch, name: str = "rank") -> DataFrame:
    """``rows`` with their rank by ORDER: sorted in ranges and written; the
    driver receives the size of each range."""
    order = [fn(c) for fn, c in ORDER]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the id counts the rows of a task in their order
    place = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    place = scratch.write(place)
    part, within = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(tuple(r) for r in place.groupBy(part.alias("part")).count().collect())
    before = dict(zip((p for p, _ in sizes), np.cumsum([0, *(n for _, n in sizes)]).tolist()))
    # one row per range
    offsets = rows.sparkSession.createDataFrame(list(before.items()), "__part long, __before long")
    return place.withColumn("__part", part).join(F.broadcast(offsets), "__part").withColumn(
        name, F.col("__before") + within + 1).drop("__part", "__before", "__at")


def bracket(scores: DataFrame, n_all: int, n_drawn: int, accuracy: int = 1000) -> tuple[int, int, int]:
    """Scores (low, high) around the ``n_drawn``-th highest of ``n_all``, and the
    exact number of rows above ``high``. ``scores`` may be read several times."""
    share, width = 1 - n_drawn / n_all, 2.0 / accuracy
    while True:
        ends = [max(share - width, 0.0), min(share + width, 1.0)]
        low, high = scores.agg(F.percentile_approx("score", ends, accuracy)).first()[0]
        if ends[0] == 0:
            low = scores.agg(F.min("score")).first()[0]
        if ends[1] == 1:
            high = scores.agg(F.max("score")).first()[0]
        above, inside = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if above < n_drawn <= above + inside:
            return low, high, above
        width *= 4


def resample(docs: DataFrame, target: DataFrame, settings: Settings = Settings(), text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns, doc_id among them (all by default), plus n_features,
    weight, score and rank (null where not drawn), all long."""
    keep = docs.columns if keep is None else list(keep)
    if taken := [c for c in keep if c in OWN or c.startswith("__")]:
        raise ValueError(f"column names taken by the result: {taken}")
    scratch = Scratch(docs.sparkSession, "importance")
    found = weighted(docs, learn(docs, target, settings, text), settings, text, keep)
    found = found.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), settings.seed))
    found = scratch.write(found.withColumn("__row", F.monotonically_increasing_id()))
    eligible = F.col("__words") >= settings.least_words
    scores = found.where(eligible)
    n_all = scores.count()
    n_drawn = n_all * settings.percent // 100
    columns = [*keep, *OWN[:3]]
    no_rank = F.lit(None).cast("long").alias("rank")
    if not n_drawn:
        return found.select(*columns, no_rank)
    low, high, above = bracket(scores, n_all, n_drawn)
    last = ranked(scores.where(F.col("score").between(low, high)).select("score", "doc_id", "__row"), scratch).where(
        F.col("rank") == n_drawn - above).first()
    tie = F.col("score") == last.score
    same = F.col("doc_id").eqNullSafe(F.lit(last.doc_id))
    earlier = F.coalesce(F.col("doc_id") < F.lit(last.doc_id), F.col("doc_id").isNotNull() & F.lit(last.doc_id).isNull())
    drawn = eligible & ((F.col("score") > last.score) | (tie & (earlier | (same & (F.col("__row") <= last["__row"])))))
    chosen = ranked(found.where(drawn), scratch)
    return chosen.select(*columns, "rank").unionByName(found.where(~drawn).select(*columns, no_rank))


def sql(settings: Settings = Settings()) -> str:
    """DuckDB twin over ``documents`` and ``benchmark`` (single words only)."""
    crc = """CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, octet_length(encode(w))),
    lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
    4294967295) AS BIGINT)"""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower}, '{word}') AS ws FROM documents),
dw AS (SELECT r, unnest(ws) AS w FROM d),
bw AS (SELECT unnest(regexp_extract_all({lower}, '{word}')) AS w FROM benchmark),
v AS (SELECT w, {crc} % {settings.buckets} AS b FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
s AS (SELECT b, count(*) AS n FROM dw JOIN v USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM bw JOIN v USING (w) GROUP BY b),
g AS (SELECT x.b, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + {settings.buckets}) AS DOUBLE)
    / CAST((coalesce(s.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + {settings.buckets}) AS DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT b FROM v) x LEFT JOIN s ON s.b = x.b LEFT JOIN t ON t.b = x.b),
m AS (SELECT r, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM dw JOIN v USING (w) JOIN g USING (b) GROUP BY r),
c AS (SELECT d.r, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' ||
    substr(sha256('{settings.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM d LEFT JOIN m USING (r)),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM c WHERE n_features >= {settings.least_words})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) * {settings.percent} // 100 FROM k) THEN rank END AS rank
FROM c LEFT JOIN k USING (r)"""
