"""Schemas and the required-column contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

# Raw review file: every field read as string (no inference pass, no ANSI cast
# surprises), plus the corrupt-record column so malformed rows are captured.
RAW_REVIEW_FIELDS = ("Rating", "Review Title", "Review Text", "Country")
RAW_REVIEW_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in RAW_REVIEW_FIELDS]
    + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

# Columns the pipeline needs. Country is used by the final projection, so it is
# part of the contract here.
REQUIRED_COLUMNS = frozenset({"Rating", "Review Title", "Review Text", "Country"})

# Rename on read to identifier-friendly names.
RAW_TO_CANONICAL = {
    "Rating": "rating",
    "Review Title": "title",
    "Review Text": "body",
    "Country": "country",
}

# Canonical review table used by every operator.
REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.LongType(), True),
        T.StructField("rating", T.StringType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("body", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
    ]
)

# Clean, labelled table produced by the transform.
CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.LongType(), True),
        T.StructField("review_combined", T.StringType(), False),
        T.StructField("label", T.DoubleType(), True),
        T.StructField("rating_numeric", T.IntegerType(), True),
        T.StructField("country", T.StringType(), True),
    ]
)

# Golden review set (JSON array of objects).
GOLDEN_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
        T.StructField("expected_label", T.IntegerType(), True),
        T.StructField("category", T.StringType(), True),
    ]
)

# Scoring requests (title defaults to '').
REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
    ]
)


def check_contract(df: DataFrame, source: str, required=REQUIRED_COLUMNS) -> None:
    """Fail fast when required columns are missing; no Spark job is run.

    The message lists the missing names and, sorted, the names that are present.
    """
    present = set(df.columns)
    missing = set(required) - present
    if missing:
        raise ValueError(
            f"{source} lacks required columns {sorted(missing)}; "
            f"present columns: {sorted(present)}"
        )
