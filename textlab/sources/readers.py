"""Readers: review CSV with quarantine, golden JSON, one-review-per-line text, parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.functions.text import py_strip
from textlab.sources.schema import (
    CORRUPT_COLUMN,
    GOLDEN_SCHEMA,
    RAW_REVIEW_SCHEMA,
    RAW_TO_CANONICAL,
    check_contract,
)


def _missing_path(err: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (err.getCondition() or "") or "Path does not exist" in str(err)


def read_reviews_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = RAW_REVIEW_SCHEMA,
    multiline: bool = True,
) -> DataFrame:
    """Read a review CSV: header row, quoted multi-line fields, ``""`` as escape, PERMISSIVE.

    With the default explicit schema (all strings + ``_corrupt_record``) short and
    long rows are kept with their raw line in ``_corrupt_record``. Pass
    ``schema=None`` to infer types (an extra pass over the file; inferred frames
    carry no corrupt-record column).

    ``multiLine`` makes each file one task; land large inputs as Parquet first
    (:func:`land_as_parquet`). Missing paths raise ``FileNotFoundError`` on any
    Hadoop file system (the check is Spark's, not the local disk's).
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    try:
        df = reader.csv(path)
    except AnalysisException as err:
        if _missing_path(err):
            raise FileNotFoundError(f"review file not found: {path}") from err
        raise
    check_contract(df, path)
    return df


def split_quarantine(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a PERMISSIVE read into (good rows, quarantined rows with the raw line).

    Both halves keep every column, so the CSV parser sees the full schema and
    decides corruption the same way whatever the caller selects later. Spark
    refuses a raw CSV/JSON scan that needs nothing but the corrupt-record column;
    the quarantine filter always needs a data column as well, so counting or
    selecting the raw lines works directly.
    """
    if CORRUPT_COLUMN not in raw.columns:
        return raw, raw.limit(0)
    # Spark rejects a raw-file scan whose only needed column is the corrupt-record
    # column (e.g. ``good.count()`` or ``bad.count()``), and its CSV parser judges only the
    # columns that a query needs. A predicate on all data columns that the optimizer cannot
    # fold away keeps every query on either half legal, and the verdict on a row the same.
    data = [F.col(f"`{c}`").cast("string") for c in raw.columns if c != CORRUPT_COLUMN]
    keeps_a_data_column = F.length(F.concat_ws("", *data)) >= F.lit(0)
    good = raw.filter(F.col(CORRUPT_COLUMN).isNull() & keeps_a_data_column).drop(CORRUPT_COLUMN)
    bad = raw.filter(F.col(CORRUPT_COLUMN).isNotNull() & keeps_a_data_column)
    return good, bad


def write_quarantine(bad: DataFrame, path: str) -> None:
    """Sink for quarantined rows (all parsed columns plus the raw line), overwrite."""
    bad.write.mode("overwrite").parquet(path)


def content_text(columns: list[str]) -> Column:
    """One text that tells apart any two rows with different ``columns``: each value with its
    length in bytes before it, NULL as a letter of its own."""

    def one(name: str) -> Column:
        value = F.col(f"`{name}`").cast("string")
        marked = F.concat(F.lit("V"), F.octet_length(value).cast("string"), F.lit(":"), value)
        return F.coalesce(marked, F.lit("N"))

    return F.concat(*[one(c) for c in columns])


def with_content_key(df: DataFrame, name: str = "review_id", step: int = 1 << 16) -> DataFrame:
    """Add a key that depends on the row alone: the MD5 of its columns (in name order) and a dense
    ordinal among equal rows, as text.

    Equal rows are counted, with map-side pre-aggregation, and made again from their count, so
    that no window or task gathers them: a row found more often than ``step`` times is dealt
    out in steps first. The input's splits and order play no part.
    """
    columns = df.columns
    own = [F.col(f"`{c}`") for c in columns]
    counted = df.groupBy(*own).agg(F.count(F.lit(1)).alias("_n"))
    dealt = (
        counted.filter(F.col("_n") > step)
        .select(*own, "_n", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / step))).alias("_part"))
        .repartition(F.xxhash64(*own), F.col("_part"))
        .select(
            *own, (F.col("_part") * step).alias("_from"),
            F.least(F.col("_n"), (F.col("_part") + 1) * step).alias("_to"),
        )
    )
    few = counted.filter(F.col("_n") <= step).select(*own, F.lit(0).cast("long").alias("_from"), F.col("_n").alias("_to"))
    key = F.md5(content_text(sorted(columns)).cast("binary"))
    return few.unionByName(dealt).select(
        *own, key.alias("_key"), F.explode(F.sequence(F.col("_from"), F.col("_to") - 1)).alias("_no")
    ).select(*own, F.concat_ws("-", "_key", F.col("_no").cast("string")).alias(name))


def canonical_reviews(good: DataFrame) -> DataFrame:
    """Rename raw columns to ``rating, title, body, country`` and add ``review_id``.

    The raw file has no key; :func:`with_content_key` gives each row one that any
    reading of the same rows gives again. Other columns are kept unmodified.
    """
    out = good
    for raw_name, name in RAW_TO_CANONICAL.items():
        if raw_name in out.columns:
            out = out.withColumnRenamed(raw_name, name)
    if "country" not in out.columns:
        out = out.withColumn("country", F.lit(None).cast("string"))
    return with_content_key(out)


#: Why a raw line is in quarantine.
UNCLOSED, SHORT, SURPLUS, OTHER = "unclosed_quote", "short", "surplus", "other"


def quarantine_reason(raw: Column, fields: int = len(RAW_TO_CANONICAL)) -> Column:
    """The reason as the raw line shows it: an odd number of quotes, else the number of fields
    that commas outside quotes make."""
    quotes = F.length(raw) - F.length(F.replace(raw, F.lit('"'), F.lit("")))
    found = F.size(F.split(F.regexp_replace(raw, '"[^"]*"', ""), ","))
    return (
        F.when(quotes % 2 == 1, F.lit(UNCLOSED)).when(found < fields, F.lit(SHORT))
        .when(found > fields, F.lit(SURPLUS)).otherwise(F.lit(OTHER))
    )


def quarantine_ledger(good: DataFrame, bad: DataFrame) -> DataFrame:
    """``reason, rows``: the rows read as good, those in quarantine by reason, and all that were read."""
    kinds = bad.select(quarantine_reason(F.col(CORRUPT_COLUMN)).alias("reason")).unionByName(
        good.select(F.lit("good").alias("reason"))
    )
    return (
        kinds.groupBy("reason").agg(F.count(F.lit(1)).alias("_n"))
        .rollup("reason").agg(F.sum("_n").alias("rows"))
        .select(F.coalesce("reason", F.lit("all")).alias("reason"), "rows")
    )


def land_as_parquet(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write a (multi-line CSV) read as Parquet once so later passes are splittable and pruned."""
    out = df.repartition(partitions) if partitions else df
    out.write.mode("overwrite").parquet(path)


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """Golden review set: a JSON array of ``{id, title, text, expected_label, category}``."""
    return spark.read.schema(GOLDEN_SCHEMA).option("multiLine", True).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One review per line: strip each line (Python ``strip`` semantics), drop blank lines."""
    return (
        spark.read.text(path)
        .select(py_strip(F.col("value")).alias("text"))
        .filter(F.col("text") != F.lit(""))
    )


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores.

    A file written as one row group is one task, which would run all text work
    on one core. Such a scan is spread into ``spark.sql.shuffle.partitions``
    parts by a hash of the row's position (``monotonically_increasing_id``):
    never by a data key, so a key or a group of copies shared by many rows cannot
    land in one task, and without the per-partition sort a round-robin
    repartition needs for deterministic retries. Large inputs already arrive in
    many splits and pass through untouched: this never adds a shuffle at scale.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    n = max(cores, int(spark.conf.get("spark.sql.shuffle.partitions", str(cores))))
    return df.repartition(n, F.monotonically_increasing_id())


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """One of the provided parquet tables, e.g. ``read_table(spark, d, "documents")``.

    With ``spread`` (default), narrow scans are spread by :func:`ensure_parallelism`.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return ensure_parallelism(df) if spread else df


def rows_to_frame(spark: SparkSession, rows: list, schema: T.StructType | None = None) -> DataFrame:
    """In-memory rows (e.g. a handful of scoring requests) as a DataFrame with a fixed schema.

    For small, caller-held inputs only; bulk inputs are read as tables.
    """
    from textlab.sources.schema import REQUEST_SCHEMA

    return spark.createDataFrame(rows, schema or REQUEST_SCHEMA)


def write_reviews_csv(reviews: DataFrame, path: str) -> None:
    """Write canonical reviews as a review CSV (raw header names) that the reader
    accepts: quotes doubled, whitespace kept, NULL as an empty field and '' as ``""``."""
    raw = reviews.select(*[F.col(c).alias(raw_name) for raw_name, c in RAW_TO_CANONICAL.items()])
    (
        raw.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .mode("overwrite")
        .csv(path)
    )
