"""Evaluate driver: score a test table once, then derive every report from it."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.operators import evaluate as ev
from textlab.operators.score import positive_probability

METRIC_FIELDS = (
    "accuracy",
    "precision",
    "recall",
    "f1_score",
    "auc_roc",
    "test_samples",
    "positive_samples",
    "negative_samples",
)


def predictions(model: PipelineModel, test: DataFrame, id_col: str = "review_id", label: str = "label") -> DataFrame:
    """``(id, label, prediction, score)`` with score = P(positive), no Python UDF."""
    return model.transform(test).select(
        id_col,
        F.col(label).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        positive_probability("probability").alias("score"),
    )


def evaluate_model(model: PipelineModel, test: DataFrame, id_col: str = "review_id", buckets: int | None = None) -> dict[str, DataFrame]:
    """Score the test table once, reduce it once to one row per distinct score, prefix-sum
    that once, and derive every report from those (all persisted; call ``release``).

    Returns the scored rows, the metrics record, confusion matrix, ROC points,
    histograms and threshold sweep.
    """
    scored = predictions(model, test, id_col).persist(StorageLevel.MEMORY_AND_DISK)
    reduced = ev.score_counts_with_nulls(scored).persist(StorageLevel.MEMORY_AND_DISK)
    counts = ev.with_score(reduced)
    prefixed = ev.exclusive_prefix_sums(reduced, "score", ["pos", "neg"], buckets=buckets).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    return {
        "scored": scored,
        "_counts": reduced,
        "_prefixed": prefixed,
        "summary": ev.summary_from_prefixed(prefixed),
        "confusion": ev.confusion_from_counts(counts),
        "roc": ev.roc_from_prefixed(ev.with_score(prefixed)),
        "histogram": ev.histogram_from_counts(counts),
        "sweep": ev.sweep_from_counts(counts),
    }


def release(reports: dict[str, DataFrame]) -> None:
    for key in ("_prefixed", "_counts", "scored"):
        reports[key].unpersist()


def save_metrics_json(summary: DataFrame, path: str) -> None:
    """The 8-field metrics record as one JSON object (floats already at 4 places)."""
    summary.select(*METRIC_FIELDS).coalesce(1).write.mode("overwrite").json(path)


def append_run(summary: DataFrame, history_path: str, run_id: int) -> None:
    """Add one run's metrics record to a run-history table (``run_id, metric, value``).

    Partitioned by ``run_id`` with dynamic partition overwrite: writing the same
    run again replaces that run's rows (idempotent retries), other runs stay.
    Compare runs with ``operators.gate.run_compare(spark.read.parquet(history_path))``.
    """
    from textlab.operators.gate import metrics_long

    numeric = [c for c in METRIC_FIELDS if c in summary.columns]
    long = metrics_long(summary.withColumn("_run", F.lit(int(run_id))), "_run", numeric)
    (
        long.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(history_path)
    )
