"""Profiling aggregates. Each is a single pass with map-side partial aggregation.

Hot keys (one rating or label holding a third of the rows) are harmless here:
every grouping is a hash aggregate whose partial step collapses a key to one
row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlab.functions.text import percent_text


def _null_or_empty(c: str) -> Column:
    return F.count_if(F.col(c).isNull() | (F.col(c) == F.lit("")))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows that are NULL or exactly '' (whitespace is not empty), and their percent.

    One aggregate over the table (row count included), then an unpivot of the
    single result row: ``column_name, null_or_empty, total_rows, pct_null_or_empty``.
    """
    agg = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[_null_or_empty(c).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_or_empty"))
            for i, c in enumerate(columns)
        ]
    )
    out = agg.select("total_rows", F.inline(rows))
    pct = F.coalesce(F.try_divide(F.col("null_or_empty") * F.lit(100.0), F.col("total_rows")), F.lit(0.0))
    return out.select(
        "column_name",
        F.col("null_or_empty").cast("bigint").alias("null_or_empty"),
        F.col("total_rows").cast("bigint").alias("total_rows"),
        F.round(pct, 4).alias("pct_null_or_empty"),
    )


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """``groupBy(column).count()`` ascending with the NULL group first (raw rating distribution)."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
        .orderBy(F.col(column).asc_nulls_first())
    )


def drop_reasons(df: DataFrame, label: str = "label", text: str = "review_combined", min_length: int = 5) -> DataFrame:
    """Why rows leave the training set, in one pass instead of a before/after count pair."""
    no_label = F.col(label).isNull()
    short = F.length(F.col(text)) <= F.lit(min_length)
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
        F.count_if(no_label).cast("bigint").alias("null_label"),
        F.count_if(short).cast("bigint").alias("short_text"),
        F.count_if(no_label & short).cast("bigint").alias("both"),
        F.count_if(no_label | short).cast("bigint").alias("dropped"),
        F.count_if(~(no_label | short)).cast("bigint").alias("kept"),
    )


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Count and percent per label. The percent window runs over the few per-label rows only."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return per.select(
        label, "n", F.round(F.col("n") * F.lit(100.0) / total, 4).alias("pct")
    )


def group_sizes(df: DataFrame, *keys: str) -> DataFrame:
    """Row count per key combination (split sizes by split x label, fold sizes, ...)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def country_rollup(df: DataFrame, label: str = "label") -> DataFrame:
    """Breakdown by country and rating with subtotals (ROLLUP), positive rate per group."""
    return df.rollup("country", "rating_numeric").agg(
        F.grouping_id().cast("int").alias("gid"),
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.round(F.avg(F.col(label)), 6).alias("positive_rate"),
    )


def batch_summary(scored: DataFrame, label: str = "prediction", group_by: Sequence[str] = ()) -> DataFrame:
    """Scored-batch summary: total, positives, negatives (= total - positives), ratio to 4 places."""
    pos = F.count_if(F.col(label) == F.lit(1))
    out = scored.groupBy(*group_by).agg(
        F.count(F.lit(1)).cast("bigint").alias("total"), pos.cast("bigint").alias("positive_count")
    )
    return out.select(
        *group_by,
        "total",
        "positive_count",
        (F.col("total") - F.col("positive_count")).alias("negative_count"),
        F.round(F.try_divide(F.col("positive_count"), F.col("total")), 4).alias("positive_ratio"),
    )


def percent_summary(scored: DataFrame, label: str = "prediction") -> DataFrame:
    """Batch summary with whole-number percent texts ('67%')."""
    s = batch_summary(scored, label)
    return s.select(
        "total",
        "positive_count",
        "negative_count",
        percent_text(F.try_divide(F.col("positive_count"), F.col("total")), 0).alias("positive_pct"),
        percent_text(F.try_divide(F.col("negative_count"), F.col("total")), 0).alias("negative_pct"),
    )


def label_domain(df: DataFrame, label: str = "label") -> DataFrame:
    """Distinct non-NULL labels (expected to be a subset of {0, 1})."""
    return df.select(label).where(F.col(label).isNotNull()).distinct()
