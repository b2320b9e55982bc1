"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.common import materialise

MAX_ROUNDS = 64


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
    return (
        both.join(least, F.col("u") == F.col("_u")).filter("v > u")
        .select(F.least("_m", "u").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    """``edges`` with a < b: each b's smaller neighbours and b itself point to the least of them."""
    least = edges.groupBy(F.col("b").alias("_u")).agg(F.min("a").alias("_m"))
    moved = edges.join(least, F.col("b") == F.col("_u"))
    return (
        moved.select(F.col("_m").alias("a"), F.col("a").alias("b")).filter("a <> b")
        .unionByName(least.select(F.col("_m").alias("a"), F.col("_u").alias("b")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``vertex, least`` for every vertex of ``edges(a, b)`` but the least of its component.

    Each round is written to the shared folder; only a count and a checksum reach
    the driver. Rounds grow with the logarithm of a component's size.
    """
    smaller, larger = F.least("a", "b"), F.greatest("a", "b")
    now = materialise(
        edges.select(smaller.alias("a"), larger.alias("b")).filter("a <> b").distinct(), "edges"
    )
    check = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
    seen = check(now)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        now = materialise(_small(_large(now)), "edges")
        if (new := check(now)) == seen:
            break
        seen = new
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("b").alias("vertex"), F.col("a").alias("least"))
