"""Registered queries: evaluation on deterministic scores (G1-G8), response shaping and
self-checks (F3, F5, F7), batch summaries (B10, B11), request validation and display
rows (C13-C15), the line source (A8), the golden gate and run comparison (G10, G12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.functions.text import py_strip, scoring_text
from textlab.operators import evaluate, gate, profile
from textlab.operators.score import display_rows, output_checks, shape_predictions, validate_requests
from textlab.operators.split import with_folds
from textlab.plans.catalog import register
from textlab.sources import views
from textlab.sources.readers import read_table


@register("binary_metrics")
def q_binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: accuracy, precision, recall, F1 of class 1, zero-division 0, plus counts."""
    return evaluate.binary_metrics(views.scores(spark, sf_dir))


@register("confusion")
def q_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2x2 confusion matrix with zero cells."""
    return evaluate.confusion_matrix(views.scores(spark, sf_dir))


@register("auc_exact")
def q_auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact AUC via per-score counts and bucketed prefix sums."""
    return evaluate.auc_exact(views.scores(spark, sf_dir))


@register("roc_points")
def q_roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ROC point per distinct score plus the origin."""
    return evaluate.roc_points(views.scores(spark, sf_dir))


@register("prob_histogram")
def q_prob_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50-bin histogram per actual class over that class's own range."""
    return evaluate.probability_histogram(views.scores(spark, sf_dir))


@register("threshold_sweep")
def q_threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics at thresholds 0.1 .. 0.9 from one pass."""
    return evaluate.threshold_sweep(views.scores(spark, sf_dir))


@register("evaluation_summary")
def q_evaluation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + G2 + G7: the metrics record with AUC and verdict from one reduction, in the
    columns of its SQL (the view has no NULL scores)."""
    return evaluate.evaluation_summary(views.scores(spark, sf_dir)).drop("null_scores")


# --- scoring shapes, request validation, line source, gate


# --- fixed values: line boundaries of Python's str.splitlines() -----------------
LINE_BREAK_PATTERN = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
# ---------------------------------------------------------------------------------


@register("score_shape")
def q_score_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sentiment, label, confidence and both probabilities to 4 places."""
    return shape_predictions(views.scores(spark, sf_dir))


@register("batch_summary")
def q_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total, positives, negatives, positive ratio of a scored batch."""
    return profile.batch_summary(views.scores(spark, sf_dir), "prediction")


@register("percent_summary")
def q_percent_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch summary with whole-number percent texts."""
    return profile.percent_summary(views.scores(spark, sf_dir), "prediction")


@register("score_checks")
def q_score_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """violation counts of the response invariants (all 0 when healthy)."""
    return output_checks(shape_predictions(views.scores(spark, sf_dir)))


@register("display_rows")
def q_display_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demo rows: document text cut at 120 characters, sentiment, '87.6%' confidence."""
    shaped = shape_predictions(views.scores(spark, sf_dir))
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("review_id"), "text")
    return display_rows(shaped.join(docs, "review_id"), "text")


@register("validate_requests")
def q_validate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C13 + C14: request rules (missing / too short / blank) and the scoring-time text."""
    req = views.reviews(spark, sf_dir).select("review_id", "title", F.col("body").alias("text"))
    v = validate_requests(req)
    return v.select(
        "review_id",
        "reject_reason",
        F.when(F.col("reject_reason").isNull(), scoring_text(F.col("title_s"), F.col("text_s"))).alias("review_text"),
    )


@register("line_source")
def q_line_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per line: split on line boundaries, strip, drop blank lines."""
    d = read_table(spark, sf_dir, "documents")
    lines = d.select("doc_id", F.posexplode(F.split(F.col("text"), LINE_BREAK_PATTERN)).alias("line_no", "raw"))
    return lines.select("doc_id", "line_no", py_strip(F.col("raw")).alias("line")).filter(F.col("line") != F.lit(""))


def _golden_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = shape_predictions(views.scores(spark, sf_dir))
    g = views.golden(spark, sf_dir)
    return g.join(shaped.withColumnRenamed("review_id", "id"), "id", "left").select(
        "id", "category", "expected_label", F.col("label").alias("prediction"), "confidence"
    )


@register("golden_gate")
def q_golden_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden-set rules over given scores, one row per rule."""
    return gate.golden_gate(_golden_scored(spark, sf_dir))


@register("golden_failures")
def q_golden_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The golden rows that break a rule, with the reason."""
    return gate.golden_failures(_golden_scored(spark, sf_dir))


@register("run_compare")
def q_run_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics per run (hash fold as the run id) compared with the previous run."""
    s = with_folds(views.scores(spark, sf_dir))
    pos, neg = F.col("label") == F.lit(1), F.col("label") == F.lit(0)
    pp, pn = F.col("prediction") == F.lit(1), F.col("prediction") == F.lit(0)
    c = s.groupBy("fold").agg(
        F.count_if(pos & pp).alias("tp"), F.count_if(neg & pp).alias("fp"),
        F.count_if(pos & pn).alias("fn"), F.count_if(neg & pn).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    m = c.select("fold", *evaluate._metric_columns(tp, fp, fn, tn))
    hist = gate.metrics_long(m, "fold", ["accuracy", "precision", "recall", "f1_score"])
    return gate.run_compare(hist)


@register("roc_compact")
def q_roc_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC points without collinear intermediate points (the usual roc_curve default)."""
    return evaluate.roc_points(views.scores(spark, sf_dir), drop_intermediate=True)
