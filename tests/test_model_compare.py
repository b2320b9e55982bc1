"""Model comparison: counts made once for all fits and predictions equal the stages' own."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from textlab.operators import features
from textlab.plans import catalog_model, mirror, train
from textlab.plans.evaluate import predictions
from textlab.plans.transform import clean_documents

TEXTS = [
    "Good film, a GOOD film; the plot is 2 good", "bad film!", "A b c d e", "the the the", "un beau film été",
    "good plot and bad actors 007 007", "   spaced    out   text   ", "bad bad bad plot of the film", "plot film good", "bon film",
]


def _rows(n: int, shared: bool = False) -> list[tuple]:
    return [(i // 2 if shared else i, f"{TEXTS[i % 10]} {TEXTS[(i * 7 + 3) % 10]}", "en" if i % 10 in (0, 1, 2, 3, 5, 7, 8) else "fr") for i in range(n)]


def _clean(spark, rows):
    docs = spark.createDataFrame(rows, "review_id long, text string, lang string")
    docs = docs.withColumn("label", (F.col("lang") == F.lit("en")).cast("double"))
    return clean_documents(docs).select("review_id", "review_combined", "label")


def test_hashed_counts_are_those_of_the_stages(spark):
    docs = _clean(spark, _rows(60))
    odd = spark.createDataFrame([(100, "", 0.0), (101, "   ", 1.0), (102, None, 0.0), (103, " the a ", 1.0)], docs.schema)
    docs = docs.unionByName(odd.filter("review_combined is not null"))
    want = Pipeline(stages=train.featurizer_stages()).fit(docs).transform(docs)
    got = {r.review_id: r.raw_features for r in train.with_hashed_counts(docs).collect()}
    assert got == {r.review_id: r.raw_features for r in want.collect()}
    assert train.with_hashed_counts(odd.filter("review_id = 102")).first().raw_features.numNonzeros() == 0


def test_counts_made_once_give_the_models_that_texts_give(spark, monkeypatch):
    monkeypatch.setattr(features, "SLICE_TEXT", 100)  # several slices a batch
    docs = features.materialized(_clean(spark, [*_rows(80), (None, "good film of no id", "en")]))
    counted = mirror.count_terms(docs, docs)
    for own, shared, rest in (
        (mirror.fit_mirror(docs), mirror.fit_mirror(counted.rows, counted), mirror.after_counts),
        (mirror.fit_exact_mirror(docs), mirror.fit_exact_mirror(counted.rows, counted=counted), lambda m: m),
    ):
        want = {r.review_id: r for r in predictions(own, docs).collect()}
        got = {r.review_id: r for r in predictions(rest(shared), counted.rows).collect()}
        assert want.keys() == got.keys() and len(got) >= 80
        for i, r in got.items():
            assert (r.label, r.prediction) == (want[i].label, want[i].prediction) and abs(r.score - want[i].score) < 1e-6
    assert counted.n == 81 and counted.terms == mirror.fit_mirror(docs).stages[4].vocabulary


def test_model_compare_counts_and_scores_once(spark, workdir, monkeypatch):
    calls = []
    for module, name in ((features, "row_term_counts"), (mirror, "mirror_vocabulary")):
        monkeypatch.setattr(module, name, lambda *a, f=getattr(module, name), n=name, **b: calls.append(n) or f(*a, **b))
    scored = []
    monkeypatch.setattr(catalog_model, "predictions", lambda *a: scored.append(predictions(*a)) or scored[-1])
    rows = spark.createDataFrame(_rows(400), "doc_id long, text string, lang string")
    rows.write.parquet(f"{workdir}/documents.parquet")
    out = catalog_model.q_model_compare(spark, workdir).orderBy("position").collect()
    assert [r.model for r in out] == ["hashed_tfidf_lr", "ngram_vocab_lr", "ngram_exact_lr"]
    assert all(r.accuracy > 0.9 and r.auc_roc > 0.9 for r in out)
    assert calls == ["row_term_counts"]  # by both mirrors together
    # rows are cut and counted before any model scores them
    plans = [s._jdf.queryExecution().executedPlan().toString() for s in scored]
    assert len(plans) == 3 and all("review_combined" not in p and "Exchange" not in p for p in plans)


def test_model_compare_merges_rows_that_share_an_id(spark, workdir, monkeypatch):
    fits = []
    fit = mirror.fit_exact_mirror
    monkeypatch.setattr(mirror, "fit_exact_mirror", lambda t, **b: fits.append((t.columns, b)) or fit(t, **b))
    rows = spark.createDataFrame(_rows(200, shared=True), "doc_id long, text string, lang string")
    rows.write.parquet(f"{workdir}/documents.parquet")
    out = catalog_model.q_model_compare(spark, workdir).collect()
    assert len(out) == 3 and fits == [(["review_id", "review_combined", "label"], {})]
