"""Registered queries: one per operator family of the survey, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the provided tables (or views Spark derives from them, see
``textlab.sources.views``) in full. Column names equal those of the SQL oracles
in ``textlab.plans.oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.config import LabelConfig
from textlab.functions.text import clean_text, parse_rating, sentiment_label
from textlab.operators import profile
from textlab.plans.transform import clean_reviews, combined_reviews
from textlab.session import scratch_path
from textlab.sources import views
from textlab.sources.readers import (
    canonical_reviews,
    quarantine_ledger,
    quarantine_reason,
    read_reviews_csv,
    read_table,
    split_quarantine,
    write_reviews_csv,
)
from textlab.sources.schema import CORRUPT_COLUMN, RAW_TO_CANONICAL

MIRROR = LabelConfig(zero_is_null=False)

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    # import for side effects: modules below register more queries
    from textlab.plans import catalog_features, catalog_model, catalog_scoring, catalog_streaming  # noqa: F401

    return dict(_REGISTRY)


# --- A / B / C: ingest-shaped profiling and the clean transform ------------


@register("clean_reviews")
def q_clean_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12 flagship: rating -> label -> clean -> combine -> filter -> project."""
    return clean_reviews(views.reviews(spark, sf_dir))


@register("null_profile")
def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and NULL-or-empty counts of rating, title, body in one pass."""
    return profile.null_profile(views.reviews(spark, sf_dir), ["rating", "title", "body"])


@register("rating_distribution")
def q_rating_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rating text distribution, NULL group first."""
    return profile.value_distribution(views.reviews(spark, sf_dir), "rating")


@register("drop_reasons")
def q_drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows dropped by the validity filter, by reason, in one pass."""
    return profile.drop_reasons(combined_reviews(views.reviews(spark, sf_dir)))


@register("parse_label")
def q_parse_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-digit rating, zero to NULL, thresholds 4 / 2."""
    r = parse_rating(F.col("rating"))
    return views.reviews(spark, sf_dir).select(
        "review_id", "rating", r.alias("rating_numeric"), sentiment_label(r).alias("label")
    )


@register("parse_label_mirror")
def q_parse_label_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mirror's rule keeps rating 0, which is then labelled 0."""
    r = parse_rating(F.col("rating"), zero_is_null=False)
    return views.reviews(spark, sf_dir).select(
        "review_id", r.alias("rating_numeric"), sentiment_label(r, MIRROR).alias("label")
    )


@register("clean_text")
def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4-C6 on title and body (whole texts)."""
    return views.reviews(spark, sf_dir).select(
        "review_id", clean_text(F.col("title")).alias("title_clean"), clean_text(F.col("body")).alias("text_clean")
    )


@register("clean_pages")
def q_clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5-C6 on raw web pages: real tags; script and style contents stay as words."""
    pages = read_table(spark, sf_dir, "pages")
    c = clean_text(F.col("html"))
    return pages.select("page_id", c.alias("html_clean"), F.length(c).cast("bigint").alias("n_chars"))


@register("combine_exact")
def q_combine_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """concat_ws keeps empty parts (leading space), skips NULLs."""
    df = combined_reviews(views.reviews(spark, sf_dir))
    return df.select("review_id", "review_combined", F.length("review_combined").alias("n_chars"))


@register("combine_trimmed")
def q_combine_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mirror's combine (NULL as '', trimmed) and its filter outcome."""
    df = combined_reviews(views.reviews(spark, sf_dir), MIRROR, trimmed=True)
    keep = F.col("label").isNotNull() & (F.length("review_combined") > F.lit(5))
    return df.select("review_id", "review_combined", keep.alias("kept"))


@register("class_balance")
def q_class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and percent per label of the clean table."""
    return profile.class_balance(clean_reviews(views.reviews(spark, sf_dir)))


@register("country_rollup")
def q_country_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROLLUP(country, rating_numeric) with counts and positive rates."""
    return profile.country_rollup(clean_reviews(views.reviews(spark, sf_dir)))


@register("label_domain")
def q_label_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct non-NULL labels of the clean table."""
    return profile.label_domain(clean_reviews(views.reviews(spark, sf_dir)))


@register("csv_roundtrip")
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A4: the review rows written as a CSV file (header, quoted multi-line texts,
    doubled quotes) to the shared scratch folder, read back with the explicit schema
    in PERMISSIVE mode, quarantine split off, columns renamed. CSV keeps no
    difference between NULL and '': empty fields read back as NULL."""
    path = scratch_path(spark, "reviews-csv")
    write_reviews_csv(views.reviews(spark, sf_dir), path)
    good, _ = split_quarantine(read_reviews_csv(spark, path))
    return canonical_reviews(good).select("review_id", "rating", "title", "body", "country")


def _damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line`` of each document as a row of a review file; of every ten ids one is short of
    fields, one has too many and one never closes its quote."""
    text = F.substring(F.regexp_replace(F.coalesce("text", F.lit("")), '[\\r\\n",\\\\]', " "), 1, 1 << 30)
    kind = F.pmod(F.col("doc_id"), F.lit(10))
    quoted = F.concat(F.lit('"'), text, F.lit('"'))
    return read_table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(kind == 1, F.concat(F.lit("5,"), quoted))
        .when(kind == 2, F.concat(F.lit("5,t,"), quoted, F.lit(",EN,more,x")))
        .when(kind == 3, F.concat(F.lit('5,t,"'), text, F.lit(",EN")))
        .otherwise(F.concat(F.lit("5,t,"), quoted, F.lit(",EN")))
        .alias("line"),
    )


def _damaged_file(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = scratch_path(spark, "damaged-csv")
    header = ",".join(RAW_TO_CANONICAL)
    # one column under the whole header, as it stands: separator and quote never occur
    (
        _damaged_lines(spark, sf_dir).select(F.col("line").alias(header))
        .write.option("header", True).option("sep", "\x01").option("quote", "\x02")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return split_quarantine(read_reviews_csv(spark, path, multiline=False))


@register("quarantine_ledger")
def q_quarantine_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: damaged rows written among good ones and read back: rows by reason, and all."""
    return quarantine_ledger(*_damaged_file(spark, sf_dir))


@register("quarantined_lines")
def q_quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: the raw lines in quarantine with their reason."""
    _, bad = _damaged_file(spark, sf_dir)
    raw = F.col(CORRUPT_COLUMN)
    return bad.select(raw.alias("raw_line"), quarantine_reason(raw).alias("reason"))
