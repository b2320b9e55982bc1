"""Model quality gate as batch jobs: golden-set rules, edge-case rules, run comparison.

Each gate returns one row per rule ``(rule, observed, threshold, passed, failing)``
computed from a single aggregate over the scored set; failing rows can be listed
with :func:`golden_failures`. The thresholds are arguments; set them from a run
on your data, not from another project's numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: default gate floors ------------------------------------------
MIN_ACCURACY = 0.80
MIN_CONFIDENCE = 0.65
CLEAR_POSITIVE = "clear_positive"
CLEAR_NEGATIVE = "clear_negative"
# --------------------------------------------------------------------------------


def _rule(name: str, observed: Column, threshold: float, passed: Column, failing: Column) -> Column:
    return F.struct(
        F.lit(name).alias("rule"),
        F.round(observed.cast("double"), 4).alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        failing.cast("bigint").alias("failing"),
    )


def golden_gate(
    scored: DataFrame,
    min_accuracy: float = MIN_ACCURACY,
    min_confidence: float = MIN_CONFIDENCE,
    expected: str = "expected_label",
    prediction: str = "prediction",
    confidence: str = "confidence",
    category: str = "category",
) -> DataFrame:
    """Golden-set rules: overall accuracy; every clear positive predicted 1; every clear
    negative predicted 0; confidence floor on clear cases; both clear categories present.
    A row without a prediction or confidence fails its rules."""
    exp, pred, conf, cat = F.col(expected), F.col(prediction), F.col(confidence), F.col(category)
    is_pos, is_neg = cat == F.lit(CLEAR_POSITIVE), cat == F.lit(CLEAR_NEGATIVE)
    clear = is_pos | is_neg
    a = scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(exp == pred).alias("correct"),
        F.count_if(is_pos).alias("n_pos"),
        F.count_if(is_neg).alias("n_neg"),
        F.count_if(is_pos & F.coalesce(pred != F.lit(1), F.lit(True))).alias("bad_pos"),
        F.count_if(is_neg & F.coalesce(pred != F.lit(0), F.lit(True))).alias("bad_neg"),
        F.min(F.when(clear, conf)).alias("min_conf"),
        F.count_if(clear & F.coalesce(conf < F.lit(min_confidence), F.lit(True))).alias("low_conf"),
    )
    acc = F.try_divide(F.col("correct"), F.col("n"))
    rules = F.array(
        _rule("accuracy", acc, min_accuracy, acc >= F.lit(min_accuracy), F.col("n") - F.col("correct")),
        _rule(
            "clear_positive_all_positive",
            F.lit(1.0) - F.try_divide(F.col("bad_pos"), F.col("n_pos")),
            1.0,
            F.col("bad_pos") == F.lit(0),
            F.col("bad_pos"),
        ),
        _rule(
            "clear_negative_all_negative",
            F.lit(1.0) - F.try_divide(F.col("bad_neg"), F.col("n_neg")),
            1.0,
            F.col("bad_neg") == F.lit(0),
            F.col("bad_neg"),
        ),
        _rule(
            "clear_confidence_floor",
            F.col("min_conf"),
            min_confidence,
            F.col("low_conf") == F.lit(0),
            F.col("low_conf"),
        ),
        _rule("clear_positive_present", F.col("n_pos"), 1.0, F.col("n_pos") >= F.lit(1), F.lit(0)),
        _rule("clear_negative_present", F.col("n_neg"), 1.0, F.col("n_neg") >= F.lit(1), F.lit(0)),
    )
    return a.select(F.inline(rules))


def golden_failures(
    scored: DataFrame,
    min_confidence: float = MIN_CONFIDENCE,
    id_col: str = "id",
    expected: str = "expected_label",
    prediction: str = "prediction",
    confidence: str = "confidence",
    category: str = "category",
) -> DataFrame:
    """Rows breaking a golden rule, with the reason: not scored, a wrong label or a
    low-confidence clear case."""
    exp, pred, conf, cat = F.col(expected), F.col(prediction), F.col(confidence), F.col(category)
    clear = cat.isin(CLEAR_POSITIVE, CLEAR_NEGATIVE)
    reason = (
        F.when(pred.isNull() | conf.isNull(), F.lit("not_scored"))
        .when(exp != pred, F.lit("wrong_label"))
        .when(clear & (conf < F.lit(min_confidence)), F.lit("low_confidence"))
    )
    return scored.select(id_col, category, expected, prediction, confidence, reason.alias("reason")).filter(
        F.col("reason").isNotNull()
    )


def reconciled_edge_gate(
    inputs: DataFrame,
    scored: DataFrame,
    id_col: str = "id",
    case: str = "case",
    prediction: str = "prediction",
    score: str = "score",
) -> DataFrame:
    """The edge-case rules held against what was sent: ``(rule, observed, threshold, passed, failing)``.

    Inputs and scored rows are counted per (case, id) and joined, NULL ids included, so a lost
    input, a row returned too often, one that nobody sent and one without a prediction or a
    probability in [0, 1] each fail. ``scores_<case>`` shows the case's inputs and how many
    of them fail, ``no_extra_rows`` the surplus, ``mixed_batch_ratio`` the share of positives
    among all scored rows, which has to lie strictly inside (0, 1). A case that has scored
    rows only shows 0 inputs and fails; without any row only the two last rules are left.
    """
    pred, sc = F.col(prediction), F.col(score)
    bad = pred.isNull() | ~F.coalesce(sc.between(0.0, 1.0), F.lit(False))
    key = [F.col(case).alias("_case"), F.col(id_col).alias("_id")]
    zero = F.lit(0).cast("bigint")
    sent = inputs.select(*key, F.lit(1).cast("bigint").alias("sent"), *[zero.alias(c) for c in ("back", "bad", "pos")])
    back = scored.select(
        *key,
        zero.alias("sent"),
        F.lit(1).cast("bigint").alias("back"),
        F.when(bad, 1).otherwise(0).cast("bigint").alias("bad"),
        F.when(pred == F.lit(1), 1).otherwise(0).cast("bigint").alias("pos"),
    )
    # both sides in one aggregate: partial sums before the only shuffle of the rows
    per_id = sent.unionByName(back).groupBy("_case", "_id").agg(*[F.sum(c).alias(c) for c in ("sent", "back", "bad", "pos")])
    lost = F.greatest(F.col("sent") - F.col("back"), zero)
    surplus = F.greatest(F.col("back") - F.col("sent"), zero)
    per_case = per_id.groupBy("_case").agg(
        F.sum("sent").alias("sent"), F.sum("back").alias("back"), F.sum("pos").alias("pos"),
        F.sum(lost + F.least(F.col("bad"), F.col("sent"))).alias("failing"), F.sum(surplus).alias("surplus"),
    )
    # the cases and their total from one plan: two branches over the cases would score every row twice
    sums, no_case = ("sent", "back", "pos", "failing", "surplus"), F.lit(None).cast(per_case.schema["_case"].dataType).alias("_case")
    cells = per_case.select(
        F.inline(F.array(*[F.struct(F.lit(whole).alias("_whole"), of, *sums) for whole, of in ((False, F.col("_case")), (True, no_case))]))
    )
    none = inputs.sparkSession.range(1).select(F.lit(True).alias("_whole"), no_case, *[zero.alias(c) for c in sums])
    counted = cells.unionByName(none).groupBy("_whole", "_case").agg(*[F.sum(c).alias(c) for c in sums])
    counted = counted.withColumn("ratio", F.try_divide(F.col("pos"), F.col("back")))
    one = F.struct(
        F.concat(F.lit("scores_"), F.coalesce(F.col("_case").cast("string"), F.lit("no_case"))).alias("rule"),
        F.col("sent").cast("double").alias("observed"),
        F.lit(1.0).alias("threshold"),
        ((F.col("sent") >= F.lit(1)) & (F.col("failing") == F.lit(0))).alias("passed"),
        F.col("failing").alias("failing"),
    )
    inside = F.coalesce((F.col("ratio") > F.lit(0.0)) & (F.col("ratio") < F.lit(1.0)), F.lit(False))
    last = F.array(
        F.struct(
            F.lit("no_extra_rows").alias("rule"), F.col("surplus").cast("double").alias("observed"),
            F.lit(0.0).alias("threshold"), (F.col("surplus") == F.lit(0)).alias("passed"), F.col("surplus").alias("failing"),
        ),
        F.struct(
            F.lit("mixed_batch_ratio").alias("rule"), F.round("ratio", 4).alias("observed"),
            F.lit(0.5).alias("threshold"), inside.alias("passed"), zero.alias("failing"),
        ),
    )
    return counted.select(F.inline(F.when(F.col("_whole"), last).otherwise(F.array(one))))


def metrics_long(metrics: DataFrame, run_col: str, names: Sequence[str]) -> DataFrame:
    """Wide metric rows ``(run, m1, m2, ...)`` to long ``(run, metric, value)``."""
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    return metrics.select(F.col(run_col).alias("run_id"), F.inline(cells))


def run_compare(history: DataFrame, tolerance: float = 0.01, lower_is_better: Sequence[str] = ()) -> DataFrame:
    """Compare each run's metrics with the previous run: delta and a regression flag.

    The window is partitioned by metric and ordered by run id; it spans the run
    history of one metric (one row per run), not the scored data.
    """
    w = Window.partitionBy("metric").orderBy("run_id")
    prev = F.lag("value").over(w)
    delta = F.col("value") - prev
    worse = F.when(F.col("metric").isin(list(lower_is_better)) if lower_is_better else F.lit(False), delta).otherwise(-delta)
    return history.select(
        "run_id",
        "metric",
        F.round("value", 4).alias("value"),
        F.round(prev, 4).alias("previous"),
        F.round(delta, 4).alias("delta"),
        F.coalesce(worse > F.lit(tolerance), F.lit(False)).alias("regressed"),
    )
