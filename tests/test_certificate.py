"""The optimality certificate, areas of many curves at once, and the CV table they fill."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from textlab.config import TrainConfig
from textlab.operators import evaluate as ev
from textlab.plans import train as tr
from textlab.plans.certificate import INTERCEPT, certificate, gradient, vector_entries
from textlab.plans.transform import clean_documents
from textlab.sources import views


def _rows(n=240, d=6, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.array([1.0, 5.0, 0.2, 1.0, 3.0, 0.0])
    x[rng.random((n, d)) < 0.4] = 0.0
    y = (x[:, 0] - 0.3 * x[:, 1] + rng.normal(size=n) > 0.2).astype(float)
    return x, y


def _expected(x, y, model, reg, l1, standardised):
    p = 1.0 / (1.0 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    s = x.std(axis=0, ddof=1)
    out = {INTERCEPT: abs(float(np.mean(p - y)))}
    for j, b in enumerate(model.coefficients.toArray()):
        if s[j] == 0:
            out[j] = abs(b)
            continue
        pull = 1.0 if standardised else 1.0 / s[j]
        g = float(np.mean((p - y) * x[:, j])) / s[j] + reg * (1 - l1) * b * s[j] * pull * pull
        out[j] = abs(g + reg * l1 * pull * np.sign(b)) if b else max(0.0, abs(g) - reg * l1 * pull)
    return out


@pytest.mark.parametrize("reg,l1,standardised", [(0.05, 0.0, True), (0.05, 0.5, True), (0.05, 0.0, False), (0.02, 1.0, False), (0.0, 0.0, True)])
def test_gradient_equals_brute_force_and_vanishes_at_the_optimum(spark, reg, l1, standardised):
    x, y = _rows()
    # every third vector is stored dense
    data = [
        (float(y[i]), Vectors.dense(x[i]) if i % 3 == 0 else Vectors.sparse(x.shape[1], [(j, v) for j, v in enumerate(x[i]) if v]))
        for i in range(len(y))
    ]
    df = spark.createDataFrame(data, ["label", "features"]).repartition(5)

    def fit(steps):
        lr = LogisticRegression(maxIter=steps, regParam=reg, elasticNetParam=l1, standardization=standardised, tol=1e-12)
        return lr.fit(df)

    model = fit(500)
    per = gradient(model.transform(df), model)
    got = {r.feature: r.violation for r in per.collect()}
    want = _expected(x, y, model, reg, l1, standardised)
    assert got.keys() >= {INTERCEPT, 0, 1, 2, 3, 4}
    for j, v in got.items():
        assert v == pytest.approx(want[j], abs=1e-9)
    whole = certificate(per, 1e-5).first()
    assert whole.optimal and whole.train_rows == 240 and whole.features == 5
    # a fit that was stopped early holds no certificate
    early = fit(1)
    first = gradient(early.transform(df), early)
    assert {r.feature: pytest.approx(r.violation, abs=1e-9) for r in first.collect()} == {
        k: v for k, v in _expected(x, y, early, reg, l1, standardised).items() if k in got
    }
    assert not certificate(first, 1e-5).first().optimal


def test_certificate_of_nothing_and_of_a_wrong_weight(spark):
    x, y = _rows()
    cols = [f"x{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame([(float(b), *map(float, a)) for a, b in zip(x, y, strict=True)], ["label", *cols])
    df = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    model = LogisticRegression(maxIter=200, regParam=0.1, tol=1e-12).fit(df)
    none = certificate(gradient(model.transform(df.limit(0)), model)).first()
    assert none.train_rows == 0 and not none.optimal
    # the same model on rows it was not fitted on is off its optimum
    other = df.withColumn("label", F.lit(1.0) - F.col("label"))
    assert not certificate(gradient(model.transform(other), model)).first().optimal


def test_vector_entries(spark):
    df = spark.createDataFrame([(Vectors.sparse(4, [(1, 2.0), (3, 0.5)]),), (Vectors.dense([0.0, 7.0]),), (Vectors.sparse(3, []),)], ["v"])
    got = [[tuple(e) for e in r.e] for r in df.select(vector_entries("v").alias("e")).collect()]
    assert got == [[(1, 2.0), (3, 0.5)], [(0, 0.0), (1, 7.0)], []]


@pytest.mark.parametrize("buckets", [1, 3, 64, None])
def test_areas_of_groups_equal_each_groups_own(spark, buckets):
    rng = np.random.default_rng(11)
    rows = [("hot", int(rng.random() < 0.3), float(np.round(rng.random(), 2))) for _ in range(900)]
    rows += [(g, int(rng.random() < 0.5), float(rng.normal() * 50 + i * 1000)) for i, g in enumerate("abc") for _ in range(60)]
    rows += [(None, 1, 0.5), (None, 0, 0.5), (None, 1, 0.9), ("one class", 1, 0.2), ("one class", 1, 0.4)]
    rows += [("a", 1, None), ("no score", 0, None)]
    df = spark.createDataFrame(rows, "g string, label int, score double").repartition(7)
    got = {r.g: r for r in ev.auc_by(df, ["g"], buckets=buckets).collect()}
    assert got.keys() == {"hot", "a", "b", "c", None, "one class"}
    for g, r in got.items():
        one = ev.auc_exact(df.filter(F.col("g").eqNullSafe(F.lit(g)))).first()
        assert (r.positive_samples, r.negative_samples, r.n_scores) == (one.positive_samples, one.negative_samples, one.n_scores)
        assert one.auc_roc is None if r.auc_roc is None else round(r.auc_roc, 6) == one.auc_roc
    assert got["one class"].auc_roc is None and got[None].auc_roc == 0.75


def test_areas_of_an_empty_table(spark):
    assert ev.auc_by(spark.createDataFrame([], "g int, label int, score double"), ["g"]).count() == 0


def test_cross_validation_equals_an_evaluator_a_curve(spark, monkeypatch):
    cfg = TrainConfig(max_iter=8, reg_params=(0.01, 0.1), elastic_net_params=(0.0,))
    clean = clean_documents(views.labelled_documents(spark, SF_SMALL, "quality"))
    seen = {}

    def by_evaluator(cells, scored, _cfg, areas=tr._areas):
        one = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", numBins=0)
        seen.update({c[:3]: one.evaluate(s) for c, s in zip(cells, scored, strict=True)})
        return areas(cells, scored, _cfg)

    monkeypatch.setattr(tr, "_areas", by_evaluator)
    rows = {(r.reg_param, r.elastic_net, r.fold): r for r in tr.cross_validate(spark, clean, cfg).collect()}
    assert rows.keys() == seen.keys() and len(rows) == 6
    for k, r in rows.items():
        assert r.auc == pytest.approx(seen[k], abs=1e-12)
    n = clean.count()
    assert all(r.train_rows + r.validation_rows == n for r in rows.values())
