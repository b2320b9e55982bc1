"""Whole texts in the derived views, AUC at large counts, gates on rows without a score."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlab.operators.evaluate import summary_from_prefixed
from textlab.operators.gate import golden_failures, golden_gate
from textlab.sources import views
from textlab.sources.readers import read_table

from .conftest import SF_MEDIUM


def test_reviews_hold_the_whole_text(spark):
    docs = read_table(spark, SF_MEDIUM, "documents").select(F.col("doc_id").alias("review_id"), "text")
    bare = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"^(<b>|<br>)|</b>$", "")
    both = views.reviews(spark, SF_MEDIUM).join(docs, "review_id")
    assert both.filter(F.concat(bare("title"), bare("body")) != F.col("text")).count() == 0
    assert both.filter("title IS NULL").count() and both.filter("body IS NULL").count() and both.filter("title = ''").count()


def test_auc_of_many_rows(spark):
    n = 4_000_000_000
    rows = [(0.2, 0, n, 0, 0, 0, n, 0), (0.8, n, 0, n, 0, 0, 0, n)]
    p = spark.createDataFrame(
        rows, "score double, pos long, neg long, tp long, fp long, fn long, tn long, neg_before long"
    )
    assert summary_from_prefixed(p).first().auc_roc == 1.0


def test_gate_fails_rows_without_a_score(spark):
    rows = [(1, "clear_positive", 1, None, None), (2, "clear_negative", 0, 0, 0.9), (3, "clear_positive", 1, 1, 0.9)]
    df = spark.createDataFrame(rows, "id long, category string, expected_label int, prediction int, confidence double")
    gate = {r.rule: r for r in golden_gate(df).collect()}
    assert not gate["clear_positive_all_positive"].passed and gate["clear_positive_all_positive"].failing == 1
    assert not gate["clear_confidence_floor"].passed
    assert [(r.id, r.reason) for r in golden_failures(df).collect()] == [(1, "not_scored")]
