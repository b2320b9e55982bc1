"""Key-hash splits: layout independence, exact stratified counts, folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlab.config import SplitConfig
from textlab.operators.split import with_folds, with_hash_split, with_stratified_split
from textlab.sources import views

from .conftest import SF_MEDIUM


def _labelled(spark):
    return views.labelled_documents(spark, SF_MEDIUM).select("review_id", "label")


def test_hash_split_is_layout_independent(spark):
    df = _labelled(spark)
    a = {r.review_id: r.split for r in with_hash_split(df).collect()}
    b = {r.review_id: r.split for r in with_hash_split(df.repartition(7)).collect()}
    assert a == b
    share = sum(v == "test" for v in a.values()) / len(a)
    assert 0.1 < share < 0.3


def test_stratified_split_exact_counts(spark):
    df = _labelled(spark)
    for bits in (1, 4, 16):
        out = with_stratified_split(df, cfg=SplitConfig(bucket_bits=bits))
        sizes = {(r.label, r.split): r.n for r in out.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
        for label in (0.0, 1.0):
            n = sizes.get((label, "test"), 0) + sizes.get((label, "train"), 0)
            assert sizes.get((label, "test"), 0) == int(round(0.2 * n + 1e-9))
    a = {r.review_id: r.split for r in with_stratified_split(df, cfg=SplitConfig(bucket_bits=1)).collect()}
    b = {r.review_id: r.split for r in with_stratified_split(df.repartition(5), cfg=SplitConfig(bucket_bits=12)).collect()}
    assert a == b


def test_folds_cover_all_rows(spark):
    df = with_folds(_labelled(spark))
    folds = {r.fold: r.n for r in df.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert set(folds) == {0, 1, 2} and sum(folds.values()) == df.count()


def test_approximate_stratified_is_the_hash_cut(spark):
    df = _labelled(spark)
    a = {r.review_id: r.split for r in with_stratified_split(df, exact=False).collect()}
    b = {r.review_id: r.split for r in with_hash_split(df).collect()}
    assert a == b
