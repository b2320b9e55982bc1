"""Operator 10: weighted fair queueing of sources to target sizes, DataFrame functions only.

Sources in code-point order (NULL last) weigh ``weights`` in turn and share
``budget_percent`` of all words; a source's target stops at ``max_epochs`` times
its size and the excess is shared again by weight among the others (the level at
which no target is above its limit is found from sorted prefix sums, over one row
a source). Documents stand in a seeded md5 order within their source, once per
epoch; a document's virtual finish time is the source's words up to its end
divided by the source's target. The queue is sorted by finish time over the whole
corpus and cut where its words would exceed the budget.

No window spans a source or the corpus: rows are range-sorted into as many ranges as hold
``RANGE_ROWS`` rows each, first by source and place, then by finish time; prefix sums run
inside a range and the ranges' totals are summed up before. Ties go by size, text hash and
last by row, so ranges cut through the rows of one id too. One row a source, or a range, meets in one
task; rows never do.

Defined cases: a NULL or blank text has size 0 and is never taken. NULL is a
source of its own. Every input row is queued, also rows equal to others (they
stand side by side and may differ in ``taken``); rows that share an id but not the text
are told apart by the text, so the result doesn't depend on how the input is split. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlab.llm.common import materialise, words


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    budget_percent: int = 150
    max_epochs: int = 2
    seed: str = "mix:"


#: Mean rows of a range.
RANGE_ROWS = 1 << 15


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def source_targets(base: DataFrame, mix: Mix) -> DataFrame:
    """``source, source_size, source_no, target``: one row a source of ``base(source, size)``."""
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in mix.weights]),
        ((F.col("source_no") - 1) % len(mix.weights) + 1).cast("int"),
    )
    limit = F.col("source_size") * mix.max_epochs
    ranked = (
        sizes.withColumn("source_no", F.row_number().over(by_name))
        .withColumn("_w", weight.cast("double"))
        .withColumn("_limit", limit.cast("double"))
        .withColumn("_level", F.col("_limit") / F.col("_w"))
    )
    by_level = Window.orderBy("_level", "source_no")
    everything = Window.partitionBy()
    # were all sources before this one at their limit, the rest would share at this level
    levels = (
        ranked.withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_before", F.sum("_limit").over(by_level) - F.col("_limit"))
        .withColumn("_w_left", F.sum("_w").over(everything) - F.sum("_w").over(by_level) + F.col("_w"))
        .withColumn(
            "_share",
            (F.col("_total") * mix.budget_percent / F.lit(100.0) - F.col("_before")) / F.col("_w_left"),
        )
    )
    level = F.min(F.when(F.col("_share") <= F.col("_level"), F.struct("_level", "_share"))).over(everything)
    return levels.withColumn("_cut", F.coalesce(level["_share"], F.max("_level").over(everything))).select(
        "source",
        "source_size",
        "source_no",
        F.least(F.col("_limit"), F.col("_cut") * F.col("_w")).alias("target"),
    )


def _running(df: DataFrame, order: list[str], name: str, ranges: int) -> DataFrame:
    """``df`` with the running sum of ``size`` in ``order``, its last column unique."""
    # the ranges' numbers are written down: what follows must not deal the rows anew
    ranged = materialise(
        df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "mix-ranges"
    )
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(F.col("_range").alias("_r")).agg(F.sum("size").alias("_sum"))
        .select("_r", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_in", F.sum("size").over(inside))
        .join(offsets, F.col("_range") == F.col("_r"))
        .withColumn(name, F.col("_offset") + F.col("_in"))
        .drop("_in", "_range", "_r", "_offset")
    )


def queue(base: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``base(uid, doc_id, source, size, text_hash)`` with ``source_size``, ``target`` and ``taken``.

    ``uid`` tells rows apart; ``base`` is read more than once, so it has to be a
    written table.
    """
    key = F.md5(F.concat(F.lit(mix.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    targets = source_targets(base, mix)
    start = F.sum("source_size").over(Window.orderBy("source_no")) - F.col("source_size")
    sources = targets.withColumn("_start", start).withColumnRenamed("source", "_source")
    ranges = -(-base.count() // RANGE_ROWS) or 1
    rows = (
        base.withColumn("_key", key).join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    )
    ties = ["source_no", "_key", "doc_id", "size", "text_hash", "uid"]
    placed = materialise(
        _running(rows, ties, "_cum", ranges).withColumn("_cum", F.col("_cum") - F.col("_start")).drop("_start"),
        "mix-places",
    )
    epochs = F.sequence(F.lit(0), F.lit(mix.max_epochs - 1))
    finish = (F.col("_cum") + F.col("_epoch") * F.col("source_size")) / F.col("target")
    queued = (
        placed.filter((F.col("size") > 0) & (F.col("target") > 0))
        .select(*ties, "_cum", "source_size", "target", F.explode(epochs).alias("_epoch"))
        .select(*ties, finish.alias("_finish"), "_epoch")
    )
    budget = base.agg((F.sum("size") * mix.budget_percent).alias("_budget_100")).scalar()
    taken = (
        _running(queued, ["_finish", *ties, "_epoch"], "_total", ranges * mix.max_epochs)
        .filter(F.col("_total") * 100 <= budget)
        .groupBy(F.col("uid").alias("_uid"))
        .agg(F.sum("size").alias("_taken"))
    )
    return placed.join(taken, F.col("uid") == F.col("_uid"), "left").select(
        "uid", "doc_id", "source", "size", "source_size", "target",
        F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"),
    )


def sized(docs: DataFrame) -> DataFrame:
    """``uid, doc_id, source, size, text_hash``, written once: texts are read a single time."""
    return materialise(_sizes(docs), "mix-sizes")


def _sizes(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", "source",
        word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"), *more,
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: documents as often as they are taken, with the columns they came with."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    numbered = materialise(_sizes(docs, row), "mix-docs")
    taken = queue(numbered.drop("_row"), mix).filter("taken > 0")
    times = taken.select(F.col("uid").alias("_u"), (F.col("taken") / F.col("size")).cast("int").alias("_n"))
    return (
        numbered.select("uid", "_row")
        .join(times.hint("shuffle_hash"), F.col("uid") == F.col("_u"))
        .select("_row", F.explode(F.array_repeat(F.lit(1), F.col("_n"))))
        .select("_row.*")
    )
