"""The exact mirror as a table of terms: same scores as its vectors, saved, read, edge cases."""

from __future__ import annotations

import math
import os

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from textlab.plans import mirror
from textlab.plans.term_model import TermModel, from_mirror, load_term_model, shape_probabilities
from textlab.plans.transform import clean_documents
from textlab.sources import views


def test_a_reloaded_model_scores_like_the_fitted_one(spark, workdir):
    docs = clean_documents(views.language_documents(spark, SF_SMALL)).select("review_id", "review_combined", "label")
    fitted = mirror.fit_exact_mirror(docs)
    path = os.path.join(workdir, "model")
    from_mirror(fitted).save(path)
    from_mirror(fitted).save(path)  # a second save replaces the first
    got = {r.review_id: r for r in load_term_model(spark, path).score(docs).collect()}
    want = fitted.transform(docs).select("review_id", "prediction", vector_to_array("probability")[1].alias("p")).collect()
    assert got.keys() == {r.review_id for r in want} and len(got) == len(want)
    for r in want:
        assert got[r.review_id].score == pytest.approx(r.p, abs=1e-9)
        assert got[r.review_id].prediction == int(r.prediction)


def _model(spark, intercept=-0.25):
    rows = [("good", 1.5, 2.0), ("bad", 1.25, -3.0), ("good film", 2.0, 0.5), ("film", 1.0, 0.0)]
    return TermModel(spark.createDataFrame(rows, "term string, idf double, coefficient double"), intercept)


def _brute(text, intercept=-0.25):
    idf = {"good": 1.5, "bad": 1.25, "good film": 2.0, "film": 1.0}
    coef = {"good": 2.0, "bad": -3.0, "good film": 0.5, "film": 0.0}
    words = [w for w in (text or "").split() if len(w) > 1]
    terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    w = {t: (1 + math.log(terms.count(t))) * idf[t] for t in set(terms) & idf.keys()}
    norm = math.sqrt(sum(x * x for x in w.values()))
    return 1 / (1 + math.exp(-((sum(w[t] * coef[t] for t in w) / norm if norm else 0.0) + intercept)))


def test_repeated_rows_null_ids_and_empty_texts(spark):
    texts = [
        (1, "good film good film"), (1, "bad bad bad film"),  # one id, two texts
        (2, "good bad"), (2, "good bad"), (2, "good bad"),  # copies
        (None, "good"), (None, "bad"), (3, None), (4, ""), (5, "nothing known"), (6, "good " * 30000 + "bad"),
    ]
    df = spark.createDataFrame(texts, "review_id long, review_combined string")
    # columns of the input that are named like the operator's own
    df = df.withColumns({c: F.lit("x") for c in ("term", "idf", "tf", "copies", "_text", "n", "score")})
    got = _model(spark).score(df.repartition(4)).collect()
    assert len(got) == len(texts)
    key = lambda i, s: (i is None, i or 0, round(s, 9))
    assert sorted(key(r.review_id, r.score) for r in got) == sorted(key(i, _brute(t)) for i, t in texts)
    assert all(r.prediction == int(r.score > 0.5) for r in got)
    assert _model(spark).score(df.limit(0)).count() == 0


def test_probabilities_are_rounded_on_their_own(spark):
    rows = [(1, 1, 0.50005), (2, 0, 0.123449), (3, 1, 1.0)]
    got = [tuple(r) for r in shape_probabilities(spark.createDataFrame(rows, "review_id long, prediction int, score double")).collect()]
    assert got == [
        (1, "positive", 1, 0.5001, 0.5001, 0.5), (2, "negative", 0, 0.8766, 0.1234, 0.8766), (3, "positive", 1, 1.0, 1.0, 0.0)
    ]


def test_a_missing_or_half_saved_model_is_named(spark, workdir):
    with pytest.raises(FileNotFoundError, match="save one first"):
        load_term_model(spark, os.path.join(workdir, "none"))
    path = os.path.join(workdir, "half")
    _model(spark).save(path)
    _model(spark).terms.limit(2).write.mode("overwrite").parquet(f"{path}/terms")  # a save that stopped in between
    with pytest.raises(FileNotFoundError, match="not whole"):
        load_term_model(spark, path)


def test_scoring_shuffles_nothing(spark):
    df = spark.range(5).selectExpr("id as review_id", "'good film' as review_combined")
    assert "Exchange" not in _model(spark).score(df)._jdf.queryExecution().executedPlan().toString()


def test_the_exact_mirror_weighs_rows_with_their_own_id_in_place(spark):
    texts = [(1, "good film", 1.0), (2, "bad film", 0.0), (3, "good good bad film", 1.0), (None, "good film", 1.0)]
    docs = spark.createDataFrame(texts, "review_id long, review_combined string, label double")
    model = mirror.fit_exact_mirror(docs)
    plan = model.with_features(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert sorted(r.review_id for r in model.transform(docs).collect()) == [1, 2, 3]
    again = docs.unionByName(docs.filter("review_id = 2"))
    assert sorted(r.review_id for r in model.transform(again).collect()) == [1, 2, 2, 2, 2, 3]
    assert model.features(again).count() == 5


def test_the_pipeline_mirror_has_a_stable_vocabulary(spark):
    texts = [(0.0, "aa bb"), (1.0, "bb aa"), (1.0, "cc aa"), (0.0, "cc dd")]
    docs = spark.createDataFrame(texts, "label double, review_combined string")
    model = mirror.fit_mirror(docs.repartition(3))
    assert next(s for s in model.stages if hasattr(s, "vocabulary")).vocabulary == ["aa", "bb", "cc"]
    assert model.transform(docs).count() == 4
