"""Distributed exclusive prefix sums over a sorted key (no single-task window).

A window with an ORDER BY but no PARTITION BY moves every row into one task.
Here the key range is cut into quantile buckets instead:

1. ``approxQuantile`` gives at most ``buckets - 1`` cut points (the only values
   that reach the driver; ``buckets`` is the session's number of shuffle partitions, more
   where a bucket would hold over two million keys, and at most 65,536);
2. ``Bucketizer`` (binary search in the JVM) assigns each row its bucket;
3. a window partitioned by bucket gives the running sum inside the bucket;
4. the per-bucket totals (at most ``buckets`` rows) are prefix-summed in one
   small window and broadcast back; the broadcast is bounded by ``buckets``.

The key table is read three times (count, quantiles, sums); callers pass a
reduced table (one row per distinct score) built from persisted scores.

Quantile cuts keep buckets balanced even when keys crowd together (scores near
0 or 1), which a fixed-width ``floor(key * B)`` would not.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_COL = "_pbucket"
# Bucket count: at most about KEYS_PER_BUCKET keys per window task, at most MAX_BUCKETS
# buckets (so at most MAX_BUCKETS - 1 cut points ever reach the driver).
KEYS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 1 << 16


def bucket_count(df: DataFrame, keys_per_bucket: int = KEYS_PER_BUCKET) -> int:
    """Buckets so that each holds at most about ``keys_per_bucket`` keys, and as many as the
    session's shuffles have partitions at any size (one count job)."""
    n = df.count()
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return int(min(MAX_BUCKETS, max(least, -(-n // keys_per_bucket))))


def quantile_buckets(df: DataFrame, key: str, buckets: int | None = None, relative_error: float | None = None) -> DataFrame:
    """Add ``_pbucket``: the quantile bucket of ``key`` (ascending, ties in one bucket).

    ``buckets=None`` sizes the bucket count from the number of keys; the quantile
    error defaults to a quarter of a bucket's width.
    """
    if buckets is None:
        buckets = bucket_count(df)
    if relative_error is None:
        relative_error = min(1e-3, 0.25 / buckets)
    probs = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(df.approxQuantile(key, probs, relative_error))) if buckets > 1 else []
    splits = [float("-inf"), *filter(math.isfinite, cuts), float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    keyed = df.withColumn("_pkey", F.col(key).cast("double"))
    b = Bucketizer(splits=splits, inputCol="_pkey", outputCol=BUCKET_COL, handleInvalid="keep")
    return b.transform(keyed).drop("_pkey")


def exclusive_prefix_sums(
    df: DataFrame,
    key: str,
    values: Sequence[str],
    buckets: int | None = None,
    relative_error: float | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """For each row add ``<v>_before`` (sum of ``v`` over rows with a smaller ``key``) and
    ``<v>_total`` (sum over all rows). ``key`` must be unique and non-NULL (aggregate first).

    With ``by`` the sums run inside each of its groups (NULL is a group), where ``key`` must
    be unique. The buckets are cut over all groups' keys together, so no window holds more
    than one bucket's keys however unlike the groups are; the table of totals has at most
    groups x ``buckets`` rows and is joined without a hint.
    """
    b = quantile_buckets(df, key, buckets, relative_error)
    w_in = Window.partitionBy(*by, BUCKET_COL).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    inner = b.select(
        "*", *[F.coalesce(F.sum(v).over(w_in), F.lit(0)).alias(f"_{v}_in") for v in values]
    )
    totals = b.groupBy(*by, BUCKET_COL).agg(*[F.sum(v).alias(f"_{v}_tot") for v in values])
    w_off = Window.partitionBy(*by).orderBy(BUCKET_COL).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*by)
    offsets = totals.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col(BUCKET_COL).alias("_off_bucket"),
        *[F.coalesce(F.sum(f"_{v}_tot").over(w_off), F.lit(0)).alias(f"_{v}_off") for v in values],
        *[F.sum(f"_{v}_tot").over(w_all).alias(f"{v}_total") for v in values],
    )
    same = F.col(BUCKET_COL) == F.col("_off_bucket")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    out = inner.join(offsets if by else F.broadcast(offsets), same)
    return out.select(
        *df.columns,
        *[(F.col(f"_{v}_in") + F.col(f"_{v}_off")).alias(f"{v}_before") for v in values],
        *[F.col(f"{v}_total") for v in values],
    )


def previous_values(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    buckets: int | None = None,
) -> DataFrame:
    """Add ``prev_<c>`` for each column: the value in the row with the next smaller
    ``key`` (NULL for the smallest key). ``key`` must be unique and non-NULL.

    A ``lag`` inside each quantile bucket, and for a bucket's first row the last
    row of the nearest non-empty lower bucket, taken from a table of at most
    ``buckets`` rows (a small window, then a bounded broadcast).
    """
    b = quantile_buckets(df, key, buckets)
    w = Window.partitionBy(BUCKET_COL).orderBy(key)
    inner = b.select(
        "*",
        *[F.lag(c).over(w).alias(f"_lag_{c}") for c in columns],
        F.row_number().over(w).alias("_rn"),
    )
    last = b.groupBy(BUCKET_COL).agg(F.max_by(F.struct(*[F.col(c) for c in columns]), F.col(key)).alias("_last"))
    edges = last.select(BUCKET_COL, F.lag("_last").over(Window.orderBy(BUCKET_COL)).alias("_edge"))
    out = inner.join(F.broadcast(edges), BUCKET_COL)
    return out.select(
        *df.columns,
        *[
            F.when(F.col("_rn") == F.lit(1), F.col("_edge").getField(c)).otherwise(F.col(f"_lag_{c}")).alias(f"prev_{c}")
            for c in columns
        ],
    )
