"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.session import scratch_path

#: What separates words everywhere in this package: space, tab, LF, VT, FF, CR.
WORD_GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by a path that only Spark needs to understand."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; NULL and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it in lambdas."""
    return F.transform(F.array(value), body)[0]


_recorders: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that ``materialise`` writes meanwhile."""
    made: list[str] = []
    _recorders.append(made)
    try:
        yield made
    finally:
        _recorders.remove(made)


def drop_scratch(spark: SparkSession, paths: list[str], reader: DataFrame) -> list[str]:
    """Delete written tables that ``reader`` does not read; returns those that stay."""
    used = reader.inputFiles()
    stay = []
    for path in paths:
        if any(path.rstrip("/").rsplit("/", 1)[1] in f for f in used):
            stay.append(path)
        else:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return stay


def materialise(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write to a fresh shared scratch folder and read it back: later branches don't
    repeat the work, and a lost executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    for made in _recorders:
        made.append(path)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
