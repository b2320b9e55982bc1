"""Reproducible splits keyed by a hash of the row id.

``randomSplit`` depends on the physical layout (the same seed after a
repartition gives a different test set), so every split here is a pure
function of ``(seed, id)``: recomputing a lost partition, re-reading the data
in another layout, or running the SQL oracle all give the same assignment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlab.config import SplitConfig

# --- fixed values -------------------------------------------------------------
SPLIT_MODULUS = 10_000  # split bucket = key % 10000; test when bucket < ratio * 10000
KEY_HEX_DIGITS = 8  # a 32-bit key from 8 hex digits of md5('<seed>:<id>')
# ------------------------------------------------------------------------------


def hash_key(id_col: Column | str, seed: int, part: int = 0) -> Column:
    """32-bit key from hex digits ``8*part+1 .. 8*part+8`` of ``md5('<seed>:<id>')``.

    ``part=0`` drives the train/test split, ``part=1`` the fold assignment, so
    the two are independent.
    """
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))
    hexpart = F.substring(digest, KEY_HEX_DIGITS * part + 1, KEY_HEX_DIGITS)
    return F.conv(hexpart, 16, 10).cast("bigint")


def with_hash_split(df: DataFrame, id_col: str = "review_id", cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """Add ``split`` ('test' / 'train'); about ``test_ratio`` of rows land in test, no shuffle."""
    cut = int(round(cfg.test_ratio * SPLIT_MODULUS))
    bucket = hash_key(id_col, cfg.seed) % F.lit(SPLIT_MODULUS)
    return df.withColumn(
        "split", F.when(bucket < F.lit(cut), F.lit("test")).otherwise(F.lit("train"))
    )


def hash_split(df: DataFrame, id_col: str = "review_id", cfg: SplitConfig = SplitConfig()) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash; the partition layout of ``df`` does not matter."""
    s = with_hash_split(df, id_col, cfg)
    return (
        s.filter(F.col("split") == F.lit("train")).drop("split"),
        s.filter(F.col("split") == F.lit("test")).drop("split"),
    )


def with_folds(df: DataFrame, id_col: str = "review_id", cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """Add ``fold`` in ``0 .. folds-1`` from an independent part of the key."""
    return df.withColumn("fold", (hash_key(id_col, cfg.seed, part=1) % F.lit(cfg.folds)).cast("int"))


def with_stratified_split(
    df: DataFrame,
    id_col: str = "review_id",
    label_col: str = "label",
    cfg: SplitConfig = SplitConfig(),
    exact: bool = True,
) -> DataFrame:
    """Stratified split. ``exact=False`` is the per-row key-hash cut, which gives each
    label about ``test_ratio`` of its rows with no shuffle at all.

    Exact stratified split: in each label, the ``round(ratio * n_label)`` ids with the
    smallest ``(key, id)`` go to test, where ``n_label`` counts distinct ids. All
    copies of an id follow it, so duplicates never straddle train and test.

    A window partitioned by label alone would put a whole class (possibly a
    third of all rows) into one task. Instead:

    1. ids are de-duplicated first (partial aggregation collapses copies, however
       many share one id);
    2. the key's top ``bucket_bits`` bits cut every label into many buckets; ids
       per (label, bucket) are counted (at most labels x 2^bucket_bits rows) and
       prefix-summed over buckets within each label, a window over that small
       table only;
    3. ids are ranked inside their (label, bucket) and compared with the
       bucket's offset; the assignment is joined back to the rows on (id, label),
       a join whose hot keys AQE splits.
    """
    if not exact:
        return with_hash_split(df, id_col, cfg)
    key = hash_key(id_col, cfg.seed)
    shift = 32 - cfg.bucket_bits
    ids = df.select(id_col, label_col).distinct()
    ids = ids.withColumns({"_key": key, "_bucket": F.shiftright(key, shift)})
    per = ids.groupBy(label_col, "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    wl = Window.partitionBy(label_col)
    offsets = per.select(
        label_col,
        "_bucket",
        F.coalesce(
            F.sum("_c").over(wl.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_before"),
        F.round(F.lit(cfg.test_ratio) * F.sum("_c").over(wl)).cast("bigint").alias("_n_test"),
    )
    ranked = ids.withColumn(
        "_rn",
        F.row_number().over(Window.partitionBy(label_col, "_bucket").orderBy("_key", id_col)),
    )
    is_test = (F.col("_before") + F.col("_rn")) <= F.col("_n_test")
    assign = ranked.join(offsets, [label_col, "_bucket"]).select(
        F.col(id_col).alias("_id"),
        F.col(label_col).alias("_label"),
        F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias("split"),
    )
    cond = (F.col(id_col) == F.col("_id")) & F.col(label_col).eqNullSafe(F.col("_label"))
    return df.join(assign, cond).drop("_id", "_label")
