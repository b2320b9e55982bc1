"""Registered queries: splits and folds (E1, E2, E7, B8), training and cross-validation
(E3-E8), the n-gram vocabulary model, model comparison and term weights (E9-E11),
model-based scoring and gates (F1, F4, G10, G11)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.config import LabelConfig, TrainConfig
from textlab.operators import evaluate as ev
from textlab.operators import features, gate, profile
from textlab.operators.score import score, shape_predictions
from textlab.operators.split import hash_split, with_folds, with_hash_split, with_stratified_split
from textlab.plans import certificate, ledger, mirror, term_model
from textlab.plans.catalog import register
from textlab.plans.evaluate import predictions
from textlab.plans.train import cross_validate, cv_table, fit_pipeline, with_hashed_counts
from textlab.plans.transform import clean_documents, clean_reviews
from textlab.session import scratch_path
from textlab.sources import views


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.labelled_documents(spark, sf_dir).select("review_id", "label")


@register("hash_split")
def q_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test when md5-derived key % 10000 < 2000; layout independent."""
    return with_hash_split(_labelled(spark, sf_dir))


@register("hash_split_sizes")
def q_hash_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split sizes by split and label in one job."""
    return profile.group_sizes(with_hash_split(_labelled(spark, sf_dir)), "split", "label")


@register("stratified_split")
def q_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 exact: per label, the round(0.2 * n) smallest keys are test."""
    return with_stratified_split(_labelled(spark, sf_dir))


@register("stratified_split_sizes")
def q_stratified_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 on the exact stratified split."""
    return profile.group_sizes(with_stratified_split(_labelled(spark, sf_dir)), "split", "label")


@register("fold_sizes")
def q_fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3 hash folds of the training part, sizes by fold and label."""
    train = with_hash_split(_labelled(spark, sf_dir)).filter(F.col("split") == F.lit("train"))
    return profile.group_sizes(with_folds(train), "fold", "label")


# --- training, scoring with a fitted model, model comparison


FIXED = TrainConfig()
GIVEN_INTERCEPT = 0.125  # of the model with given coefficients


def _quality_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_documents(views.labelled_documents(spark, sf_dir, "quality"))


def _language_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_documents(views.language_documents(spark, sf_dir))


@register("train_predict")
def q_train_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 + E8 + F1: fit the 5-stage pipeline on the hash-split training part of
    documents x labels (label = quality), score the test part."""
    train, test = hash_split(_quality_docs(spark, sf_dir))
    model = fit_pipeline(train, FIXED, FIXED.reg_params[0], FIXED.elastic_net_params[0])
    return predictions(model, test)


@register("cv_table")
def q_cv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-fold CV of the 2 x 2 grid with features shared per fold; mean / std AUC, rank."""
    train, _ = hash_split(_quality_docs(spark, sf_dir))
    return cv_table(cross_validate(spark, train, FIXED))


@register("train_certificate")
def q_train_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The certificate of ``train_predict``'s fit beside every document it scores: rows
    learned from, hashed features that vary in them, and whether no entry of the loss's
    gradient is above the tolerance."""
    train, test = hash_split(_quality_docs(spark, sf_dir))
    model = fit_pipeline(train, FIXED, FIXED.reg_params[0], FIXED.elastic_net_params[0])
    fit = certificate.certificate(certificate.gradient(model.transform(train), model.stages[-1]))
    fact = fit.select(F.struct("train_rows", "features", "optimal").alias("fit")).scalar()
    scored = predictions(model, test).withColumn("fit", fact)
    return scored.select(
        "review_id", "label", F.col("score").between(0, 1).alias("scored"), "fit.train_rows", "fit.features", "fit.optimal"
    )


@register("cv_auc_grid")
def q_cv_auc_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 + G3 on given scores: the exact area of every (fold, parameters) curve from one job."""
    out = ev.auc_by(views.grid_scores(spark, sf_dir), ("reg_param", "elastic_net", "fold"))
    return out.withColumn("auc_roc", F.round("auc_roc", 6))


@register("cv_table_scores")
def q_cv_table_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 + E6 on given scores: mean and deviation of the folds' areas, rank, best pair."""
    cells = ev.auc_by(views.grid_scores(spark, sf_dir), ("reg_param", "elastic_net", "fold"))
    return cv_table(cells.withColumnRenamed("auc_roc", "auc"))


@register("recorded_run")
def q_recorded_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8 + G9 + A9-A12 + G12: split, CV, refit, evaluation, metrics file and metadata on record
    under one run id; the record read back, its counts and consistency checks."""
    return ledger.audit_run(ledger.record_run(spark, _quality_docs(spark, sf_dir), scratch_path(spark, "runs"), FIXED))


@register("top_terms")
def q_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 + E11: the n-gram vocabulary model on the language label; 20 strongest terms each way."""
    train, _ = hash_split(_language_docs(spark, sf_dir))
    return mirror.top_terms(spark, mirror.fit_mirror(train), 20)


@register("model_compare")
def q_model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed TF-IDF model vs n-gram vocabulary model on the same split.

    Texts are cleaned once, n-grams counted once for both mirrors, and every row's counts made
    once for its fits and its predictions. The fits run one after another, so that each has the
    memory for its blocks, which every L-BFGS iteration reads; each model scores once."""
    docs = features.materialized(_language_docs(spark, sf_dir).select("review_id", "review_combined", "label"))
    train, test = hash_split(docs)
    # all text work comes before the fits: their blocks and its Python workers share no memory
    hashed_train, hashed_test = hash_split(with_hashed_counts(docs, FIXED))
    counted = mirror.count_terms(docs, train)
    counted_train, counted_test = hash_split(counted.rows)
    merged = features.repeated_ids(docs.select("review_id"), "review_id") is not None
    scored = {}
    hashed = fit_pipeline(hashed_train, FIXED, FIXED.reg_params[0], FIXED.elastic_net_params[0])
    scored["hashed_tfidf_lr"] = predictions(PipelineModel(stages=hashed.stages[-2:]), hashed_test)
    ngram = mirror.fit_mirror(counted_train, counted)
    scored["ngram_vocab_lr"] = predictions(mirror.after_counts(ngram), counted_test)
    if merged:  # rows that share an id are one document of the exact mirror
        scored["ngram_exact_lr"] = predictions(mirror.fit_exact_mirror(train), test)
    else:
        exact = mirror.fit_exact_mirror(counted_train, counted=counted)
        scored["ngram_exact_lr"] = predictions(exact, counted_test)
    return mirror.compare_models({k: ev.evaluation_summary(features.materialized(s)) for k, s in scored.items()})


@register("mirror_scores")
def q_mirror_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 on given coefficients: the mirror's vocabulary of the clean reviews, a coefficient made
    from each term, the model saved and read again, every review scored with it."""
    docs = clean_reviews(views.reviews(spark, sf_dir), LabelConfig(zero_is_null=False), trimmed=True)
    docs = features.materialized(docs.select("review_id", "review_combined"))
    coefficient = ((F.length("term") * F.lit(37) + F.ascii("term") * F.lit(11)) % F.lit(21) - F.lit(10)) / F.lit(4.0)
    terms = mirror.mirror_vocabulary(docs).select("term", "idf", coefficient.alias("coefficient"))
    path = scratch_path(spark, "term-model")
    term_model.TermModel(terms, GIVEN_INTERCEPT).save(path)
    return term_model.shape_probabilities(term_model.load_term_model(spark, path).score(docs))


@register("exact_top_terms")
def q_exact_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 + E11 with the mirror's exact features (sublinear tf, smooth idf, L2 rows):
    the 20 strongest terms each way."""
    train, _ = hash_split(_language_docs(spark, sf_dir))
    return mirror.exact_top_terms(mirror.fit_exact_mirror(train), 20)


def _language_model(spark: SparkSession, sf_dir: str):
    train, _ = hash_split(_language_docs(spark, sf_dir))
    return fit_pipeline(train, FIXED, FIXED.reg_params[0], FIXED.elastic_net_params[0])


@register("model_golden_gate")
def q_model_golden_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G10 with a trained model: the golden set's documents (English = positive) that the model
    did not learn from, each scored once by bulk scoring (F4)."""
    model = _language_model(spark, sf_dir)
    _, held_out = hash_split(views.golden(spark, sf_dir), "id")
    keep = ("expected_label", "category")
    s = score(held_out, model, id_col="id", keep=keep)
    return gate.golden_gate(shape_predictions(s, id_col="id", keep=keep).withColumnRenamed("label", "prediction"))


@register("edge_gate")
def q_edge_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing titles, repeated texts, other languages and the mixed batch all score, held
    against what was sent."""
    model = _language_model(spark, sf_dir)
    inputs = views.edge_inputs(spark, sf_dir)
    scored = score(inputs, model, id_col="id", keep=("case",))
    return gate.reconciled_edge_gate(inputs, scored)


@register("edge_gate_scores")
def q_edge_gate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G11 on given scores: labelled documents have one, so the inputs of the others are lost."""
    inputs = views.edge_inputs(spark, sf_dir).select("id", "case")
    given = views.scores(spark, sf_dir).select(F.col("review_id").alias("id"), "prediction", "score")
    return gate.reconciled_edge_gate(inputs, inputs.join(given, "id"))


@register("hashed_top_terms")
def q_hashed_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E11 for the 5-stage hashed model (language label): the strongest terms each way,
    found by hashing the corpus terms with the model's HashingTF."""
    from textlab.functions.tokens import ml_tokens, remove_stop_words

    docs = _language_docs(spark, sf_dir)
    train, _ = hash_split(docs)
    model = fit_pipeline(train, FIXED, FIXED.reg_params[0], FIXED.elastic_net_params[0])
    terms = train.select(F.explode(remove_stop_words(ml_tokens(F.col("review_combined")))).alias("term"))
    return mirror.hashed_top_terms(spark, model, terms, 20)
