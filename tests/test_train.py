"""Training, CV table, save/load, model info, scoring paths, gates."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from textlab.config import TrainConfig
from textlab.operators import evaluate as ev
from textlab.operators import gate
from textlab.operators.score import output_checks, score, shape_predictions
from textlab.plans.evaluate import evaluate_model, release, save_metrics_json
from textlab.plans.train import cv_table, load_model, model_info, save_model, train_model
from textlab.plans.transform import clean_documents
from textlab.sources import views

from .conftest import SF_SMALL

CFG = TrainConfig(max_iter=20)


@pytest.fixture(scope="module")
def trained(spark):
    docs = clean_documents(views.language_documents(spark, SF_SMALL))
    return train_model(spark, docs, CFG, tune=True)


def test_cv_and_refit(spark, trained):
    t = cv_table(trained.cv).collect()
    assert len(t) == 4 and sum(r.is_best for r in t) >= 1
    assert [type(s).__name__ for s in trained.model.stages] == [
        "Tokenizer", "StopWordsRemover", "HashingTF", "IDFModel", "LogisticRegressionModel"
    ]
    reports = evaluate_model(trained.model, trained.test)
    try:
        s = reports["summary"].first()
        assert s.auc_roc > 0.9 and s.test_samples == trained.test.count()
        assert reports["roc"].count() >= 2
    finally:
        release(reports)


def test_save_load_and_info(spark, trained, workdir):
    path = os.path.join(workdir, "model")
    save_model(trained.model, path)
    save_model(trained.model, path)  # overwrite is idempotent
    again = load_model(path)
    a = trained.model.transform(trained.test).select("review_id", "prediction").orderBy("review_id").collect()
    b = again.transform(trained.test).select("review_id", "prediction").orderBy("review_id").collect()
    assert a == b
    info = model_info(spark, again, path).orderBy("position").collect()
    assert [r.stage for r in info][0] == "Tokenizer" and info[0].training_metrics == "{}"
    with pytest.raises(FileNotFoundError):
        load_model(os.path.join(workdir, "missing"))


def test_metrics_json_sink(spark, trained, workdir):
    from textlab.plans.evaluate import predictions

    summary = ev.evaluation_summary(predictions(trained.model, trained.test))
    out = os.path.join(workdir, "metrics")
    save_metrics_json(summary, out)
    back = spark.read.json(out).first().asDict()
    assert set(back) == {"accuracy", "precision", "recall", "f1_score", "auc_roc", "test_samples",
                         "positive_samples", "negative_samples"}


def test_scoring_paths_and_checks(spark, trained):
    g = views.golden(spark, SF_SMALL)
    raw = score(g, trained.model, id_col="id", preprocess="raw", keep=("expected_label", "category"))
    clean = score(g, trained.model, id_col="id", preprocess="train", keep=("expected_label", "category"))
    assert raw.count() == clean.count() == g.count()
    checks = output_checks(shape_predictions(clean, id_col="id")).first()
    assert checks.bad_probability_sum == 0 and checks.bad_confidence == 0 and checks.bad_label == 0
    assert checks.ratio_in_range
    shaped = shape_predictions(clean, id_col="id").select("id", F.col("label").alias("prediction"), "confidence")
    rules = {r.rule: r for r in gate.golden_gate(g.select("id", "expected_label", "category").join(shaped, "id")).collect()}
    assert rules["accuracy"].observed > 0.8 and rules["clear_positive_present"].passed


def test_run_compare_flags_regressions(spark):
    hist = spark.createDataFrame(
        [(1, "f1_score", 0.80), (2, "f1_score", 0.85), (3, "f1_score", 0.70), (1, "loss", 0.5), (2, "loss", 0.7)],
        "run_id int, metric string, value double",
    )
    out = {(r.run_id, r.metric): r.regressed for r in gate.run_compare(hist, lower_is_better=["loss"]).collect()}
    assert out[(3, "f1_score")] and not out[(2, "f1_score")] and out[(2, "loss")] and not out[(1, "f1_score")]


def test_threshold_and_rows_to_frame(spark):
    from textlab.operators.score import with_threshold
    from textlab.sources.readers import rows_to_frame

    df = spark.createDataFrame([(1, 0.3), (2, 0.7)], "review_id long, score double")
    assert [r.prediction for r in with_threshold(df, 0.25).orderBy("review_id").collect()] == [1, 1]
    assert [r.prediction for r in with_threshold(df, 0.5).orderBy("review_id").collect()] == [0, 1]
    req = rows_to_frame(spark, [(1, "Title", "Some text here"), (2, None, "Other")])
    assert req.columns == ["request_id", "title", "text"] and req.count() == 2


def test_fit_pipeline_equals_plain_pipeline_fit(spark):
    from textlab.plans.train import fit_pipeline, sentiment_pipeline

    docs = clean_documents(views.language_documents(spark, SF_SMALL))
    a = fit_pipeline(docs, CFG, 0.01, 0.0)
    b = sentiment_pipeline(CFG, 0.01, 0.0).fit(docs)
    pa = {r.review_id: (r.prediction, r.probability[1]) for r in a.transform(docs).collect()}
    pb = {r.review_id: (r.prediction, r.probability[1]) for r in b.transform(docs).collect()}
    assert pa.keys() == pb.keys()
    assert all(pa[k][0] == pb[k][0] and abs(pa[k][1] - pb[k][1]) < 1e-4 for k in pa)


def test_run_history_append_is_idempotent(spark, workdir):
    from textlab.plans.evaluate import append_run

    path = os.path.join(workdir, "history")
    m1 = spark.createDataFrame([(0.8, 0.7, 0.6, 0.65, 0.9, 10, 5, 5)],
                               "accuracy double, precision double, recall double, f1_score double, auc_roc double, "
                               "test_samples long, positive_samples long, negative_samples long")
    m2 = m1.withColumn("f1_score", F.lit(0.5))
    append_run(m1, path, 1)
    append_run(m2, path, 2)
    append_run(m2, path, 2)  # retry of run 2 replaces it
    hist = spark.read.parquet(path)
    assert hist.count() == 16
    out = {(r.run_id, r.metric): r.regressed for r in gate.run_compare(hist).collect()}
    assert out[(2, "f1_score")] and not out[(2, "accuracy")]


def test_exact_mirror_features_equal_term_keyed_weights(spark):
    """The exact mirror's vectors carry the sublinear / smooth-idf / L2 weights of the
    term-keyed operator, index for index."""
    from textlab.operators import features as fe
    from textlab.plans import mirror

    docs = clean_documents(views.language_documents(spark, SF_SMALL))
    model = mirror.fit_exact_mirror(docs)
    terms = docs.select("review_id", mirror.mirror_terms(F.col("review_combined")).alias("terms"))
    want = {(r.review_id, r.term): r.weight for r in fe.tfidf_sublinear_l2(terms, "review_id", "terms").collect()}
    vocab = {r["index"]: r["term"] for r in model.vocab.collect()}
    got = {}
    for r in model.features(docs).collect():
        for i, v in zip(r.features.indices, r.features.values):
            got[(r.review_id, vocab[int(i)])] = round(float(v), 6)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 2e-6 for k in want)
    pred = model.transform(docs)
    assert pred.count() == docs.count() and "probability" in pred.columns


def test_refit_on_same_split_is_identical(spark):
    from textlab.operators.split import hash_split
    from textlab.plans.train import fit_pipeline

    docs = clean_documents(views.language_documents(spark, SF_SMALL))
    train, _ = hash_split(docs)
    a = fit_pipeline(train, CFG, 0.01, 0.0).stages[-1].coefficients.toArray()
    b = fit_pipeline(train.repartition(3), CFG, 0.01, 0.0).stages[-1].coefficients.toArray()
    assert abs(a - b).max() < 1e-6


def test_keep_negations_reaches_the_pipeline(spark):
    from textlab.plans.train import featurizer_stages

    plain = featurizer_stages(TrainConfig())[1].getStopWords()
    kept = featurizer_stages(TrainConfig(keep_negations=True))[1].getStopWords()
    assert "not" in plain and "not" not in kept and "the" in kept


def test_model_info_reads_training_metrics(spark, trained, workdir):
    import json as _json

    path = os.path.join(workdir, "metrics.json")
    with open(path, "w") as f:
        f.write(_json.dumps({"accuracy": 0.9, "f1_score": 0.8}))
    info = model_info(spark, trained.model, "somewhere", path).first()
    assert _json.loads(info.training_metrics) == {"accuracy": 0.9, "f1_score": 0.8}
