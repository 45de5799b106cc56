"""Mixing sources to target weights by Poisson replication.

A source's target repetition rate is its share of the wanted total divided by
the number of its documents. Each document's number of copies inverts the
Poisson distribution with that mean at a uniform number hashed from the seed
and the document's id; the document is exploded by that count, and all copies
are dealt to partitions and ordered by a hash of (seed, id, copy).

Weights default to the square root of a source's size (sampling temperature
2); every source has a rate of its own, unless ``max_sources`` asks for the
smaller ones to be pooled. Null is a source like any other. Documents with equal ids (null
included) draw alike, so repeated rows keep equal counts. Given weights:
sources without one, or with a weight of 0, get no copy. An empty table gives
no rows. Null and empty texts are copied like others. Columns named ``__*``
are reserved; all others pass through.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postscope.llm.common import Scratch, arrow_map

HEX = 13  # digits of a hash that make a uniform number: 52 bits


def draw(seed: str, *parts: Column) -> Column:
    """Hash of the seed and the parts, as hexadecimal text."""
    return F.md5(F.concat_ws(":", F.lit(seed), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def uniform(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, HEX), 16, 10).cast("double") / F.lit(float(16**HEX))


def cumulative(rate: float) -> list[float]:
    """P(X <= k) for X ~ Poisson(rate), k = 0, 1, ... until it is 1 to double precision."""
    if rate <= 0:
        return [1.0]
    k = np.arange(math.ceil(rate + 12 * math.sqrt(rate) + 40))
    log = k * math.log(rate) - rate - np.array([math.lgamma(x + 1.0) for x in k.tolist()])
    return np.cumsum(np.exp(log)).tolist()


def rates(docs: DataFrame, weights: Mapping[str, float] | None, total: float | None, max_sources: int, source: str) -> tuple[dict, float]:
    """Source -> rate, and the rate of the pooled rest, for given weights or
    ``max_sources``, which bound what the driver receives."""
    counts = docs.groupBy(source).agg(F.count("*").alias("n"))
    n_all = counts.agg(F.sum("n")).first()[0] or 0
    if weights is not None:
        named = {r[source]: r.n for r in counts.where(F.col(source).isin(list(weights))).collect()}
        share, rest = {s: float(weights[s]) for s in named}, 0
    else:
        top = counts.orderBy(F.desc("n"), F.col(source).asc_nulls_last()).limit(max_sources).collect()
        named = {r[source]: r.n for r in top}
        rest = n_all - sum(named.values())
        share = {s: math.sqrt(n) for s, n in named.items()}
    pooled = math.sqrt(rest) if rest else 0.0
    whole = math.fsum(share.values()) + pooled
    wanted = float(n_all if total is None else total)
    per = {s: wanted * w / whole / named[s] for s, w in share.items()} if whole else {}
    return per, wanted * pooled / whole / rest if rest else 0.0


def own_rates(docs: DataFrame, total: float | None, source: str) -> tuple[DataFrame, int]:
    """__source, __rows and __cdf of every source, at default weights, and the
    number of rows. The driver receives two sums."""
    counts = docs.groupBy(F.col(source).alias("__source")).agg(F.count("*").alias("__rows"))
    scratch = Scratch(docs.sparkSession, "poisson-mix")
    counts = scratch.write(counts)
    # decimals: the sum doesn't depend on its order
    root = F.sum(F.sqrt("__rows").cast("decimal(28,15)"))
    n_all, whole = counts.agg(F.sum("__rows"), root).first()
    wanted, whole = float((n_all or 0) if total is None else total), float(whole or 0)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cdf = {n: cumulative(wanted * math.sqrt(n) / whole / n) for n in set(batch.column("__rows").to_pylist())}
        lists = pa.array([cdf[n] for n in batch.column("__rows").to_pylist()], type=pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "__cdf"])

    table = scratch.write(arrow_map(counts, run, T.StructType([*counts.schema.fields, T.StructField("__cdf", T.ArrayType(T.DoubleType()))])))
    scratch.keep(table)
    return table, n_all or 0


def with_own_rates(docs: DataFrame, total: float | None, source: str) -> DataFrame:
    """Every column of ``docs`` plus __source, __rows and __cdf."""
    table, n_all = own_rates(docs, total, source)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    same = F.col(source).eqNullSafe(F.col("__source"))
    # at most ``parts`` sources hold a partition's share of the rows each
    large = F.col("__rows") * parts >= n_all
    found = docs.join(F.broadcast(table.where(large)), same)
    if table.where(~large).isEmpty():
        return found
    rest = docs.join(F.broadcast(table.where(large).select("__source")), same, "left_anti")
    return found.unionByName(rest.join(table.where(~large), same))


def copies(docs: DataFrame, weights: Mapping[str, float] | None = None, total: float | None = None, seed: str = "mix",
           max_sources: int | None = None, source: str = "source") -> DataFrame:
    """Every column of ``docs`` plus ``__n``, the number of copies (0 possible)."""
    if weights is None and max_sources is None:
        found, cdf = with_own_rates(docs, total, source), F.col("__cdf")
    else:
        per, rest = rates(docs, weights, total, max_sources, source)
        kind = docs.schema[source].dataType.simpleString()
        rows = [(s, cumulative(r)) for s, r in per.items()]
        table = docs.sparkSession.createDataFrame(rows, f"__source {kind}, __cdf array<double>")
        # at most max_sources (or len(weights)) rows
        found = docs.join(F.broadcast(table), F.col(source).eqNullSafe(F.col("__source")), "left")
        cdf = F.coalesce("__cdf", F.array(*map(F.lit, cumulative(rest))))
    u = uniform(draw(seed, F.col("doc_id")))
    return found.withColumn("__u", u).withColumn("__n", F.size(F.filter(cdf, lambda c: c < F.col("__u"))).cast("long")).drop(
        "__source", "__rows", "__cdf", "__u")


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, total: float | None = None, seed: str = "mix",
        max_sources: int | None = None, source: str = "source") -> DataFrame:
    """Every column of ``docs`` plus ``__n`` (copies of the document), ``__copy``
    (from 0) and ``__place`` (the hash that orders the rows), one row per copy,
    shuffled globally."""
    out = copies(docs, weights, total, seed, max_sources, source).where("__n > 0")
    out = out.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    out = out.withColumn("__place", draw(seed + "/place", F.col("doc_id"), F.col("__copy")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartition(parts, "__place").sortWithinPartitions("__place")


#: DuckDB twin of ``mix`` with default weights over ``documents``.
SQL = """
WITH n AS (SELECT source, count(*) AS c FROM documents GROUP BY source),
t AS (SELECT sum(sqrt(c)) AS s, sum(c) AS total FROM n),
r AS (SELECT source, total * sqrt(c) / s / c AS rate FROM n, t),
k AS (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT))) AS k FROM r),
cdf AS (SELECT source, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p FROM k),
d AS (SELECT doc_id, source, text,
  CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM documents),
c AS (SELECT doc_id, source, text, list_filter((SELECT list(p) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM d.source), lambda p: p < u) AS l FROM d),
e AS (SELECT doc_id, source, text, CAST(len(l) AS BIGINT) AS n_copies FROM c),
x AS (SELECT doc_id, source, text, n_copies, unnest(range(n_copies)) AS copy FROM e)
SELECT doc_id, source, n_copies, copy,
  md5('mix/place:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(copy AS VARCHAR)) AS place, text
FROM x
"""
