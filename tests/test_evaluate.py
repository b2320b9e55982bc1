"""Metrics, AUC, ROC, histograms and sweeps against hand values and brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlab.operators import evaluate as ev
from textlab.operators.prefix import exclusive_prefix_sums
from textlab.sources import views

from .conftest import SF_MEDIUM

SCHEMA = "label int, prediction int, score double"
FIVE = [(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.2), (0, 1, 0.6), (1, 1, 0.6)]


def test_metrics_hand_example(spark):
    df = spark.createDataFrame(FIVE, SCHEMA)
    m = ev.binary_metrics(df).first()
    assert (m.tp, m.fn, m.fp, m.tn) == (2, 1, 1, 1)
    assert m.accuracy == 0.6 and m.precision == 0.6667 and m.recall == 0.6667 and m.f1_score == 0.6667
    assert ev.auc_exact(df).first().auc_roc == 0.75
    s = ev.evaluation_summary(df).first()
    assert s.auc_roc == 0.75 and s.test_samples == 5 and s.verdict == "deficient"


def test_zero_division_and_single_class(spark):
    df = spark.createDataFrame([(1, 0, 0.3), (1, 0, 0.2)], SCHEMA)
    m = ev.binary_metrics(df).first()
    assert m.precision == 0.0 and m.recall == 0.0 and m.f1_score == 0.0
    assert ev.auc_exact(df).first().auc_roc is None
    cells = {(r.actual, r.predicted): r.n for r in ev.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 2, (1, 1): 0}


def _brute_auc(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [1, 3, 64, 1024])
def test_auc_and_roc_match_brute_force(spark, buckets):
    df = views.scores(spark, SF_MEDIUM)
    rows = df.collect()
    labels, scores = [r.label for r in rows], [r.score for r in rows]
    auc = ev.auc_exact(df, buckets=buckets).first().auc_roc
    assert abs(auc - _brute_auc(labels, scores)) < 1e-6
    roc = {r.threshold: (r.tp, r.fp) for r in ev.roc_points(df, buckets=buckets).collect()}
    for t in sorted(set(scores))[::17]:
        tp = sum(1 for l, s in zip(labels, scores) if l == 1 and s >= t)
        fp = sum(1 for l, s in zip(labels, scores) if l == 0 and s >= t)
        assert roc[t] == (tp, fp)
    assert roc[float("inf")] == (0, 0)


def test_prefix_sums_match_sequential(spark):
    df = spark.range(0, 500).select(
        (F.col("id") * 37 % 1000).cast("double").alias("k"), (F.col("id") % 7).alias("v")
    ).dropDuplicates(["k"])
    out = sorted((r.k, r.v, r.v_before, r.v_total) for r in exclusive_prefix_sums(df, "k", ["v"], buckets=16).collect())
    run = 0
    total = sum(r[1] for r in out)
    for k, v, before, tot in out:
        assert before == run and tot == total
        run += v


def test_histogram_matches_numpy(spark):
    df = views.scores(spark, SF_MEDIUM)
    rows = df.collect()
    got = {}
    for r in ev.probability_histogram(df).collect():
        got.setdefault(r.label, [0] * 50)[r.bin] = r.n
    for label in (0, 1):
        xs = np.array([r.score for r in rows if r.label == label])
        counts, _ = np.histogram(xs, bins=50)
        assert got[label] == counts.tolist()


def test_histogram_single_value_class(spark):
    df = spark.createDataFrame([(1, 1, 0.7), (1, 1, 0.7), (0, 0, 0.1), (0, 0, 0.3)], SCHEMA)
    got = {(r.label, r.bin): r.n for r in ev.probability_histogram(df).collect() if r.n}
    counts, _ = np.histogram(np.array([0.7, 0.7]), bins=50)
    assert got[(1, int(np.argmax(counts)))] == 2


def test_threshold_sweep_matches_brute_force(spark):
    df = views.scores(spark, SF_MEDIUM)
    rows = df.collect()
    ts = [0.0, 0.25, 0.5, 0.505, 0.9, 1.0]
    for r in ev.threshold_sweep(df, ts).collect():
        tp = sum(1 for x in rows if x.label == 1 and x.score > r.threshold)
        fp = sum(1 for x in rows if x.label == 0 and x.score > r.threshold)
        assert (r.tp, r.fp) == (tp, fp)


def test_verdict_rules(spark):
    df = spark.createDataFrame([(0.95, 0.97), (0.85, 0.9), (0.85, 0.5), (0.75, None), (0.5, 0.99)], "f1 double, auc double")
    got = [r[0] for r in df.select(ev.verdict(F.col("f1"), F.col("auc"))).collect()]
    assert got == ["excellent", "good", "acceptable", "acceptable", "deficient"]


@pytest.mark.parametrize("buckets", [1, 5, 64])
def test_roc_drop_intermediate_matches_reference_rule(spark, buckets):
    """Kept points equal the rule 'first, last, or a non-zero second difference' computed
    sequentially over thresholds in descending order."""
    df = views.scores(spark, SF_MEDIUM)
    rows = df.collect()
    thr = sorted({r.score for r in rows}, reverse=True)
    tps = [sum(1 for r in rows if r.label == 1 and r.score >= t) for t in thr]
    fps = [sum(1 for r in rows if r.label == 0 and r.score >= t) for t in thr]
    keep = [0] + [i for i in range(1, len(thr) - 1)
                  if (tps[i + 1] - 2 * tps[i] + tps[i - 1]) or (fps[i + 1] - 2 * fps[i] + fps[i - 1])] + [len(thr) - 1]
    want = {(thr[i], tps[i], fps[i]) for i in keep} | {(float("inf"), 0, 0)}
    got = {(r.threshold, r.tp, r.fp) for r in ev.roc_points(df, buckets=buckets, drop_intermediate=True).collect()}
    assert got == want


def test_evaluation_independent_of_partitioning(spark):
    df = views.scores(spark, SF_MEDIUM)
    a = ev.evaluation_summary(df).first().asDict()
    b = ev.evaluation_summary(df.repartition(7)).first().asDict()
    c = ev.evaluation_summary(df.coalesce(1), buckets=3).first().asDict()
    assert a == b == c
    ra = sorted(map(tuple, ev.roc_points(df).collect()))
    rb = sorted(map(tuple, ev.roc_points(df.repartition(5), buckets=9).collect()))
    assert ra == rb


@pytest.mark.parametrize("buckets", [None, 3])
def test_record_counts_rows_without_a_score(spark, buckets):
    rows = [*FIVE, (1, 1, None), (0, 1, None), (None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = ev.evaluation_summary(spark.createDataFrame(FIVE, SCHEMA), buckets=buckets).first().asDict()
    got = ev.evaluation_summary(df, buckets=buckets).first().asDict()
    assert plain["null_scores"] == 0 and got == plain | {"null_scores": 3}
    assert ev.evaluation_summary(df.limit(0), buckets=buckets).first().null_scores == 0
    counts = ev.with_score(ev.score_counts_with_nulls(df))
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, ev.score_counts(df).collect()))
