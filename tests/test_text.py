"""Literal-row cases for rating parse, labels, cleaning, combining, filtering and requests."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.config import LabelConfig
from textlab.functions.text import (
    clean_text,
    combine_exact,
    combine_trimmed,
    display_text,
    fold_accents,
    parse_rating,
    percent_text,
    request_reject_reason,
    scoring_text,
    sentiment_label,
)
from textlab.plans.transform import clean_reviews

S = T.StringType()


def one_col(spark, values, name="x", dtype=S):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(name, dtype, True)]))


RATINGS = [
    ("Rated 4 out of 5 stars", 4, 1, 1),
    ("Rated 3 out of 5 stars", 3, None, None),
    ("Rated 2 out of 5 stars", 2, 0, 0),
    ("4.5", 4, 1, 1),
    ("10 out of 10", 1, 0, 0),
    ("7", 7, 1, 1),
    ("0 stars", None, None, 0),
    ("", None, None, None),
    ("no rating", None, None, None),
    (None, None, None, None),
]


def test_rating_and_labels(spark):
    df = one_col(spark, [r[0] for r in RATINGS], "rating")
    r = parse_rating(F.col("rating"))
    rm = parse_rating(F.col("rating"), zero_is_null=False)
    out = df.select(
        "rating", r.alias("n"), sentiment_label(r).alias("label"),
        sentiment_label(rm, LabelConfig(zero_is_null=False)).alias("mirror"),
    ).collect()
    got = {row["rating"]: (row["n"], row["label"], row["mirror"]) for row in out}
    for rating, n, label, mirror in RATINGS:
        assert got[rating] == (n, label, mirror), rating


def test_overlapping_thresholds_favour_positive(spark):
    df = one_col(spark, ["3"], "rating")
    cfg = LabelConfig(positive_threshold=3, negative_threshold=3)
    assert df.select(sentiment_label(parse_rating("rating"), cfg)).first()[0] == 1


CLEAN = [
    ("GREAT Product!!!", "great product"),
    ("Works <br>perfectly <p>every</p> day.", "works perfectly every day"),
    ("  Bad   quality  ", "bad quality"),
    ("a < b > c", "a c"),
    ("I <3 it", "i 3 it"),
    ("Café déjà", "caf d j"),
    ("don't\tstop\n", "don t stop"),
    ("", ""),
    (None, None),
]


def test_clean_text(spark):
    df = one_col(spark, [c[0] for c in CLEAN])
    got = [r[0] for r in df.select(clean_text(F.col("x"))).collect()]
    assert got == [c[1] for c in CLEAN]


def test_fold_accents_keeps_words(spark):
    df = one_col(spark, ["Café déjà Straße"])
    assert df.select(clean_text(fold_accents(F.col("x")))).first()[0] == "cafe deja stra e"


COMBINE = [
    ("good", "happy", "good happy", "good happy"),
    ("", "body", " body", "body"),
    ("", "abcde", " abcde", "abcde"),
    (None, "abcdef", "abcdef", "abcdef"),
    (None, "abcde", "abcde", "abcde"),
    (None, None, "", ""),
]


def test_combine_variants(spark):
    schema = T.StructType([T.StructField("t", S), T.StructField("b", S)])
    df = spark.createDataFrame([(c[0], c[1]) for c in COMBINE], schema)
    got = df.select(combine_exact("t", "b"), combine_trimmed("t", "b")).collect()
    assert [(r[0], r[1]) for r in got] == [(c[2], c[3]) for c in COMBINE]


def test_length_filter_is_strictly_greater_than_five(spark):
    rows = [(1, "Rated 5 out of 5 stars", "", "abcde", "US"),     # ' abcde' has 6 chars: kept
            (2, "Rated 5 out of 5 stars", "", "body", "US"),      # ' body' has 5: dropped
            (3, "Rated 5 out of 5 stars", None, "abcde", "US"),   # 'abcde' has 5: dropped
            (4, "Rated 3 out of 5 stars", "great", "product", "US"),  # neutral: dropped
            (5, "Rated 1 out of 5 stars", "bad", "thing here", "DE")]
    schema = "review_id bigint, rating string, title string, body string, country string"
    out = clean_reviews(spark.createDataFrame(rows, schema)).orderBy("review_id").collect()
    assert [(r.review_id, r.review_combined, r.label) for r in out] == [(1, " abcde", 1.0), (5, "bad thing here", 0.0)]
    assert out[0].rating_numeric == 5 and out[1].country == "DE"


def test_clean_reviews_plan_cleans_once(spark):
    """The length predicate must not be pushed below the cleaning projection (no duplicated regex)."""
    rows = [(1, "Rated 5 out of 5 stars", "t", "some body text", "US")]
    schema = "review_id bigint, rating string, title string, body string, country string"
    plan = clean_reviews(spark.createDataFrame(rows, schema))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert all("regexp_replace" not in line for line in filters), plan


REQUESTS = [
    (None, "missing_text", None),
    ("bad", "too_short", None),
    ("   ", "too_short", None),
    ("     ", "blank", None),
    ("    a", None, "a"),
    ("  good product 　", None, "good product"),
]


def test_request_validation_and_scoring_text(spark):
    df = one_col(spark, [r[0] for r in REQUESTS], "text")
    out = df.select(
        request_reject_reason(F.col("text")).alias("why"),
        scoring_text(F.lit(""), F.col("text")).alias("txt"),
    ).collect()
    for (text, why, txt), row in zip(REQUESTS, out):
        assert row["why"] == why, text
        if why is None:
            assert row["txt"] == txt


def test_scoring_text_joins_stripped_parts(spark):
    schema = T.StructType([T.StructField("t", S), T.StructField("b", S)])
    df = spark.createDataFrame([("  Title ", " body  "), ("", "body"), (None, "body")], schema)
    assert [r[0] for r in df.select(scoring_text("t", "b")).collect()] == ["Title body", "body", "body"]


@pytest.mark.parametrize("n,expected_suffix", [(120, ""), (121, "…")])
def test_display_truncation(spark, n, expected_suffix):
    out = one_col(spark, ["x" * n]).select(display_text(F.col("x"))).first()[0]
    assert out == "x" * min(n, 120) + expected_suffix


def test_percent_text_matches_python_formatting(spark):
    values = [0.125, 0.135, 0.8765, 2 / 3, 0.5, 0.0, 1.0, 0.0625]
    df = spark.createDataFrame([(v,) for v in values], "f double")
    for decimals in (0, 1):
        out = [r[0] for r in df.select(percent_text(F.col("f"), decimals)).collect()]
        assert out == [f"{v * 100:.{decimals}f}%" for v in values]
