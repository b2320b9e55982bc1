"""Rating -> label -> clean -> combine -> filter -> project: the flagship transform.

All steps are ``Column`` expressions, so Catalyst collapses them into one
projection inside one whole-stage-codegen span, with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.config import LabelConfig
from textlab.functions.text import (
    clean_text,
    combine_exact,
    combine_trimmed,
    parse_rating,
    sentiment_label,
)


def with_rating_label(df: DataFrame, cfg: LabelConfig = LabelConfig()) -> DataFrame:
    """Add ``rating_numeric`` and int ``label`` from the raw ``rating`` text."""
    r = parse_rating(F.col("rating"), cfg.zero_is_null)
    return df.withColumns({"rating_numeric": r, "label": sentiment_label(r, cfg)})


def with_clean_text(df: DataFrame) -> DataFrame:
    """Add ``title_clean`` and ``text_clean``."""
    return df.withColumns(
        {"title_clean": clean_text(F.col("title")), "text_clean": clean_text(F.col("body"))}
    )


def combined_reviews(df: DataFrame, cfg: LabelConfig = LabelConfig(), trimmed: bool = False) -> DataFrame:
    """Labelled and cleaned rows before the validity filter (``review_combined`` added)."""
    out = with_clean_text(with_rating_label(df, cfg))
    combine = combine_trimmed if trimmed else combine_exact
    return out.withColumn("review_combined", combine(F.col("title_clean"), F.col("text_clean")))


def keep_rows(df: DataFrame, keep: Column, columns: list[str]) -> DataFrame:
    """Keep rows where ``keep`` holds, without letting the optimizer push ``keep`` down.

    A plain ``filter`` on a computed column is pushed below the projection that
    computes it, with the expression copied: the regex cleaning would then run
    twice per row (once for the predicate, once for the output), and the first
    copy would run in the scan stage, before any repartition. Emitting a
    zero-or-one element array and ``inline``-ing it evaluates the cleaned text
    once, after the columns it depends on are computed.
    """
    row = F.struct(*[F.col(c) for c in columns])
    kept = F.when(keep, F.array(row)).otherwise(F.array().cast(T.ArrayType(row_type(df, columns))))
    return df.select(F.inline(kept))


def row_type(df: DataFrame, columns: list[str]) -> T.StructType:
    fields = {f.name: f for f in df.schema.fields}
    return T.StructType([fields[c] for c in columns])


def clean_reviews(df: DataFrame, cfg: LabelConfig = LabelConfig(), trimmed: bool = False) -> DataFrame:
    """The whole training transform: ``review_id, review_combined, label (double), rating_numeric, country``.

    The label test runs before any regular expression: rows without a label are
    dropped first (a cheap filter that may run in the scan), so the cleaning work
    is spent only on rows that can be kept, and it is done once per row.
    """
    r = parse_rating(F.col("rating"), cfg.zero_is_null)
    labelled = df.select(
        "review_id", "title", "body", "country", r.alias("rating_numeric"),
        sentiment_label(r, cfg).alias("label"),
    ).filter(F.col("label").isNotNull())
    combine = combine_trimmed if trimmed else combine_exact
    combined = labelled.select(
        "review_id", "label", "rating_numeric", "country",
        combine(clean_text(F.col("title")), clean_text(F.col("body"))).alias("review_combined"),
    )
    cols = ["review_id", "review_combined", "label", "rating_numeric", "country"]
    kept = keep_rows(combined, F.length(F.col("review_combined")) > F.lit(cfg.min_text_length), cols)
    return kept.select(
        "review_id",
        "review_combined",
        F.col("label").cast("double").alias("label"),
        "rating_numeric",
        "country",
    )


def clean_documents(docs: DataFrame, text: str = "text", min_length: int = 5) -> DataFrame:
    """Labelled documents (``review_id, text, label``) to the training shape:
    ``review_combined`` = cleaned text (no title), rows with a label and more than
    ``min_length`` characters."""
    combined = combine_exact(F.lit(None).cast("string"), clean_text(F.col(text)))
    out = docs.filter(F.col("label").isNotNull()).withColumn("review_combined", combined)
    return keep_rows(out, F.length(F.col("review_combined")) > F.lit(min_length), out.columns)
