"""Joins (J1-J4).

Broadcast is used only where the small side has a size bound known from the
plan itself (a top-k of k rows); otherwise Spark chooses, and AQE may still
switch to a broadcast from runtime statistics (``autoBroadcastJoinThreshold``
checks the measured size).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most keys that ``hot_keys`` can be asked for: the sketch holds ten counters each.
MAX_HOT = 10_000

def restrict_to_keys(df: DataFrame, keys: DataFrame, on, bound: int | None = None) -> DataFrame:
    """Keep the rows of ``df`` whose key is in ``keys`` (left semi).

    ``bound`` states that ``keys`` has at most that many rows (k of a top-k),
    so it is broadcast and ``df`` is not shuffled; without it Spark decides by
    the size of ``keys``.
    """
    on = [on] if isinstance(on, str) else list(on)
    right = keys.select(*on).distinct() if bound is None else keys.select(*on)
    if bound is not None:
        right = F.broadcast(right)
    return df.join(right, on, "left_semi")


def lookup(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Attach the columns of ``right`` by key; rows without a match are
    dropped (inner), like a dictionary lookup."""
    return left.join(right, on, how)


def latest_value_per_key(df: DataFrame, key: str, value: str, ts: str, tie: str = "id",
                         out: str = "latest") -> DataFrame:
    """Per key, the value of its latest row (ties: largest ``tie``).

    One aggregate (``max_by`` combines map-side), no window over the key.
    """
    return (
        df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.col(value), F.struct(F.col(ts), F.col(tie))).alias(out))
    )


def hot_keys(df: DataFrame, key: str, min_share: float) -> list:
    """Keys (not null) holding at least ``min_share`` of all rows.

    At most ``1 / min_share`` keys can. One bounded pass counts heavy hitters
    with a sketch of ten times that many counters, whose error is below a
    tenth of the share; a second, semi-joined pass counts those exactly.
    """
    most = min(math.ceil(1 / min_share), MAX_HOT)
    if most < 1 / min_share:
        raise ValueError(f"min_share must be at least 1/{MAX_HOT}")
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(`{key}`, {2 * most}, {max(1000, 10 * most)})").alias("t"),
    ).first()
    near = [r["item"] for r in row["t"] or [] if r["item"] is not None and r["count"] >= 0.9 * min_share * row["n"]]
    if not near:
        return []
    return [r[key] for r in df.where(F.col(key).isin(near)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_share * row["n"]).select(key).collect()]


def salted_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner", buckets: int = 16,
                hot: list | None = None, min_share: float | None = None) -> DataFrame:
    """Equi-join that splits hot keys of ``left`` over ``buckets`` tasks
    without relying on AQE.

    Rows of ``left`` with a hot key get a salt from a deterministic hash of
    the row (a retried task salts the same way); rows of ``right`` with a hot
    key are replicated once per salt, which adds at most
    ``len(hot) x buckets`` rows. Other keys join with salt 0 as usual.
    ``hot`` defaults to the keys holding more than an average shuffle
    partition's share of ``left``. Null keys match nothing, so their rows are
    always salted. Supports ``inner``, ``left``,
    ``left_semi`` and ``left_anti`` (replicating ``right`` would break the
    outer side of right and full joins).
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"salted_join supports inner/left/left_semi/left_anti, not {how!r}")
    if hot is None:
        parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot = hot_keys(left, on, min_share if min_share is not None else 1.0 / min(max(parts, 1), MAX_HOT))
    is_hot_r = F.col(on).isin(hot) if hot else F.lit(False)
    is_hot_l = is_hot_r | F.col(on).isNull()
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(buckets))
    l2 = left.withColumn("_salt", F.when(is_hot_l, salt).otherwise(F.lit(0)))
    r2 = right.withColumn(
        "_salt", F.explode(F.when(is_hot_r, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0))))
    )
    return l2.join(r2, [on, "_salt"], how).drop("_salt")
