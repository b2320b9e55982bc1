"""Scoring: request validation, model application, result shaping and self-checks.

The positive-class probability is read with ``vector_to_array`` (JVM), not a
Python UDF. Rows carry their id through scoring instead of relying on order.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import HashingTF, IDFModel, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.functions.text import (
    clean_text,
    combine_exact,
    display_text,
    percent_text,
    py_strip,
    request_reject_reason,
    scoring_text,
)
from textlab.operators.features import hashed_sums

# --- fixed values -------------------------------------------------------------
SENTIMENT_POSITIVE = "positive"
SENTIMENT_NEGATIVE = "negative"
PROBABILITY_SUM_TOLERANCE = 0.01
# ------------------------------------------------------------------------------


def positive_probability(probability: Column | str = "probability") -> Column:
    """P(class 1) from MLlib's probability vector, as a double."""
    c = F.col(probability) if isinstance(probability, str) else probability
    return vector_to_array(c).getItem(1)


def validate_requests(requests: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """Add ``reject_reason`` (NULL when accepted) and the stripped ``title_s`` / ``text_s``.

    Rules in order: text present, at least 5 characters before stripping, not
    blank after stripping. A missing title is ''.
    """
    return requests.withColumns(
        {
            "reject_reason": request_reject_reason(F.col(text)),
            "title_s": py_strip(F.coalesce(F.col(title), F.lit(""))),
            "text_s": py_strip(F.col(text)),
        }
    )


def split_requests(requests: DataFrame, title: str = "title", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) requests."""
    v = validate_requests(requests, title, text)
    return v.filter(F.col("reject_reason").isNull()), v.filter(F.col("reject_reason").isNotNull())


def model_input(df: DataFrame, title: str = "title", text: str = "text", preprocess: str = "train") -> DataFrame:
    """Add ``review_combined`` as the model expects it.

    ``preprocess="train"`` applies the training-time cleaning and combine (no
    train/serve skew); ``"raw"`` only strips and joins the parts, as a plain
    scoring service would.
    """
    if preprocess == "train":
        combined = combine_exact(clean_text(F.col(title)), clean_text(F.col(text)))
    elif preprocess == "raw":
        combined = scoring_text(F.col(title), F.col(text))
    else:
        raise ValueError(f"preprocess must be 'train' or 'raw', not {preprocess!r}")
    return df.withColumn("review_combined", combined)


def _linear(model: PipelineModel) -> tuple | None:
    """(weight of each hashed bucket, intercept, margin above which a row is positive, stop words) of
    the 5-stage pipeline as ``fit_pipeline`` makes it, or None."""
    five = [Tokenizer, StopWordsRemover, HashingTF, IDFModel, LogisticRegressionModel]
    if not isinstance(model, PipelineModel) or [type(s) for s in model.stages] != five:
        return None
    token, stop, tf, idf, lr = model.stages
    chain = [token.getInputCol(), token.getOutputCol(), stop.getOutputCol(), tf.getOutputCol(), idf.getOutputCol()]
    if chain != ["review_combined", stop.getInputCol(), tf.getInputCol(), idf.getInputCol(), lr.getFeaturesCol()]:
        return None
    if stop.getCaseSensitive() or tf.getBinary() or lr.numClasses != 2 or lr.isSet("thresholds"):
        return None
    t = lr.getThreshold()
    cut = -math.inf if t == 0.0 else math.inf if t == 1.0 else math.log(t / (1.0 - t))
    words = [w.lower() for w in stop.getStopWords()]
    return idf.idf.toArray() * lr.coefficients.toArray(), float(lr.intercept), cut, words


def score(
    df: DataFrame,
    model: PipelineModel,
    id_col: str = "review_id",
    title: str = "title",
    text: str = "text",
    preprocess: str = "train",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Bulk scoring: ``(id, *keep, prediction, score)`` with ``score`` = P(positive).

    For the 5-stage pipeline on cleaned texts, each batch's distinct tokens are hashed and weighed
    once and a row's margin is the sum over its tokens, without token lists and vectors of
    every row; other models and texts go through ``model.transform``.
    """
    if preprocess == "train" and (linear := _linear(model)):
        weights, intercept, cut, stop_words = linear
        combined = combine_exact(clean_text(F.col(title)), clean_text(F.col(text)))
        sums = hashed_sums(df, combined, weights, stop_words, [F.col(c) for c in (id_col, *keep)])
        margin = F.col("_sum") + F.lit(intercept)
        return sums.select(
            id_col,
            *keep,
            F.when(margin > F.lit(cut), F.lit(1)).otherwise(F.lit(0)).alias("prediction"),
            (F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.exp(margin))).alias("score"),
        )
    pred = model.transform(model_input(df, title, text, preprocess))
    return pred.select(
        id_col,
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        positive_probability("probability").alias("score"),
    )


def with_threshold(scored: DataFrame, threshold: float, score: str = "score", out: str = "prediction") -> DataFrame:
    """Re-decide predictions at another threshold without retraining: 1 when score > threshold."""
    return scored.withColumn(out, F.when(F.col(score) > F.lit(float(threshold)), F.lit(1)).otherwise(F.lit(0)))


def shape_predictions(
    scored: DataFrame,
    id_col: str = "review_id",
    prediction: str = "prediction",
    score: str = "score",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Response fields: sentiment, label, P(pos) and P(neg) to 4 places, and the
    confidence of the predicted class (``keep`` columns are carried through)."""
    label = F.col(prediction).cast("int")
    pos = F.round(F.col(score), 4)
    neg = F.round(F.lit(1.0) - pos, 4)
    return scored.select(
        id_col,
        *keep,
        F.when(label == F.lit(1), F.lit(SENTIMENT_POSITIVE)).otherwise(F.lit(SENTIMENT_NEGATIVE)).alias("sentiment"),
        label.alias("label"),
        F.round(F.when(label == F.lit(1), pos).otherwise(neg), 4).alias("confidence"),
        pos.alias("prob_positive"),
        neg.alias("prob_negative"),
    )


def output_checks(shaped: DataFrame) -> DataFrame:
    """Violation counts over any shaped table (all zero when healthy) plus the summary invariants."""
    pos, neg, conf, label = (F.col(c) for c in ("prob_positive", "prob_negative", "confidence", "label"))
    chosen = F.when(label == F.lit(1), pos).otherwise(neg)
    total = F.count(F.lit(1))
    positives = F.count_if(label == F.lit(1))
    out = shaped.agg(
        total.cast("bigint").alias("total"),
        F.count_if(F.abs(pos + neg - F.lit(1.0)) > F.lit(PROBABILITY_SUM_TOLERANCE)).cast("bigint").alias("bad_probability_sum"),
        F.count_if(F.abs(conf - chosen) > F.lit(1e-9)).cast("bigint").alias("bad_confidence"),
        F.count_if(~label.isin(0, 1) | label.isNull()).cast("bigint").alias("bad_label"),
        F.count_if((conf < F.lit(0.0)) | (conf > F.lit(1.0))).cast("bigint").alias("bad_confidence_range"),
        positives.cast("bigint").alias("positive_count"),
    )
    ratio = F.try_divide(F.col("positive_count"), F.col("total"))
    return out.withColumn(
        "ratio_in_range", F.coalesce((ratio >= F.lit(0.0)) & (ratio <= F.lit(1.0)), F.lit(True))
    )


def display_rows(shaped_with_text: DataFrame, text: str = "text") -> DataFrame:
    """Demo table rows: text cut to 120 characters, sentiment, confidence as '87.6%'."""
    return shaped_with_text.select(
        *[c for c in shaped_with_text.columns if c == "review_id"],
        display_text(F.col(text)).alias("review"),
        F.col("sentiment"),
        percent_text(F.col("confidence"), 1).alias("confidence_text"),
    )
