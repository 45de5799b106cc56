"""Counting, arg-max and ranking.

All counts are built-in aggregates, so Spark combines them map-side
(``partial_count``) before the shuffle: a key that holds a third of all rows
reaches the exchange as one row per map task. Every top-k and arg-max has a
complete order (count descending, key ascending), so results never depend on
partitioning. Top-k uses ``orderBy().limit()``, which plans as
``TakeOrderedAndProject`` (a bounded heap per task, no global sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(keys):
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def count_by(df: DataFrame, *keys, name: str = "n", drop_null: str | None = None) -> DataFrame:
    """Rows per key (``count(*)``, a bigint).

    ``drop_null`` names a key whose null group is removed. The test is on an
    aggregate (``count(key) > 0``), which Catalyst cannot push below the
    aggregate: a filter on the key itself would be pushed down to the scan
    and evaluate a costly key expression (a parsed date) twice per row.
    """
    aggs = [F.count(F.lit(1)).alias(name)]
    if drop_null is None:
        return df.groupBy(*_cols(keys)).agg(*aggs)
    out = df.groupBy(*_cols(keys)).agg(*aggs, F.count(F.col(drop_null)).alias("_nonnull"))
    return out.where(F.col("_nonnull") > 0).drop("_nonnull")


def top_k(df: DataFrame, k: int, by: str = "n", keys=None, descending_keys: bool = False) -> DataFrame:
    """K1/K4: the k rows with the largest ``by``; ties broken by the keys.

    ``descending_keys`` breaks ties by the keys descending (Q1's day order).
    """
    keys = [c for c in df.columns if c != by] if keys is None else list(keys)
    tie = [F.col(c).desc_nulls_last() if descending_keys else F.col(c).asc_nulls_last() for c in keys]
    return df.orderBy(F.col(by).desc(), *tie).limit(k)


def best_per_group(pairs: DataFrame, group: str, item: str, count: str = "n",
                   best: str = "top_item", total: str = "total") -> DataFrame:
    """A3+A4: per group, the item with the largest count (tie: smallest item)
    and the sum of counts, in one partial + final aggregate. ``min_by`` keeps
    a string, so Spark plans it sort-based; it sorts the (group, item) count
    rows, not the input rows."""
    key = F.struct((-F.col(count)).alias("neg"), F.col(item).alias("item"))
    return pairs.groupBy(group).agg(
        F.min_by(F.col(item), key).alias(best),
        F.sum(count).alias(total),
    )


def top_n_per_group(df: DataFrame, group, order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group under ``order``.

    ``row_number() <= n`` is planned with a partial ``WindowGroupLimit``
    before the exchange, so each map task ships at most ``n`` rows per group:
    a huge group does not reach one task whole.
    """
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def value_at_rank(counts: DataFrame, k: int, by: str = "n", keys=None) -> DataFrame:
    """K5: the k-th largest value of ``by`` (one row, ``value``), or null if
    fewer than k rows. Only the top k rows are kept per task."""
    return top_k(counts, k, by, keys).agg(
        F.when(F.count(F.lit(1)) >= k, F.min(by)).alias("value")
    )


def ties_at_cutoff(counts: DataFrame, k: int, by: str = "n", key: str = "key") -> DataFrame:
    """Value at rank k, how many keys share it, how many of them made
    the top k, and an alert when the cut splits a tie.

    The cut-off is a scalar subquery over a k-row top list; the count of keys
    sharing it is a filter + count over all keys. No global window.
    """
    cutoff = value_at_rank(counts, k, by, [key]).scalar()
    top = top_k(counts, k, by, [key])
    in_top = top.where(F.col(by) == cutoff).agg(F.count(F.lit(1)).alias("c")).scalar()
    return counts.agg(
        F.lit(k).alias("k"),
        cutoff.alias("cutoff_value"),
        F.count_if(F.col(by) == cutoff).alias("keys_at_cutoff"),
        in_top.alias("keys_at_cutoff_in_top"),
    ).withColumn("split_tie", F.col("keys_at_cutoff") > F.col("keys_at_cutoff_in_top"))


def count_of_counts(counts: DataFrame, by: str = "n", name: str = "keys") -> DataFrame:
    """How many keys share each count value."""
    return counts.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def quantile(counts: DataFrame, q: float, by: str = "n", exact: bool = True, accuracy: int = 10000) -> Column:
    """Quantile with linear interpolation (exact), or approximate.

    The exact form keeps a map value -> frequency per task and merges them;
    for counts per user it is small (few distinct count values). For a
    column with many distinct values use ``exact=False``.
    """
    if exact:
        return F.percentile(F.col(by), F.lit(q))
    return F.percentile_approx(F.col(by), F.lit(q), F.lit(accuracy))


def ratio(numerator: Column, denominator: Column, digits: int = 6) -> Column:
    """A share, rounded so results compare across engines; null for
    an empty input (``try_divide``: no error under ANSI mode)."""
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), digits)


def head_sample(df: DataFrame, n: int, order: str = "id") -> DataFrame:
    """K6: the first ``n`` records by ``order`` (repeatable, unlike file order)."""
    return df.orderBy(F.col(order).asc_nulls_last()).limit(n)


def reservoir_sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """K7: a uniform sample of exactly ``n`` rows, repeatable for a seed.

    Rows are ranked by the MD5 of the seed and the whole row as JSON text, so
    null or repeated keys don't tie; equal rows are interchangeable. The ``n``
    smallest are kept with a bounded heap per task (``TakeOrderedAndProject``).
    """
    whole = F.to_json(F.struct(*(F.col(c) for c in df.columns)))
    h = F.md5(F.concat(F.lit(f"{seed}:"), whole))
    return df.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")
