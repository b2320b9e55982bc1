"""Whether a fitted logistic regression is at its optimum.

The regularised loss of a logistic regression is convex, so the coefficients are optimal
exactly where no entry of its (sub)gradient is off zero. The gradient is one aggregate per
feature over the training rows: residual times feature value, summed with map-side partial
aggregation, with the feature's sum and sum of squares for its scale. A marker entry a row
carries the intercept's gradient and the row count, so one pass gives everything; the table
of results has at most ``numFeatures + 1`` rows.

Entries are those of the optimiser's own coordinates, where each feature is divided by its
standard deviation. With ``s`` that deviation, ``g`` the mean of residual times value,
``l`` the regularisation and ``a`` its L1 share, a coefficient ``b`` is off by

    |g/s + l(1-a)s b + l a sign(b)|   where b is not 0,
    max(0, |g/s| - l a)               where it is 0,

with the penalty on standardised coefficients; without standardisation its terms are
divided by ``s`` once more, twice for the L2 term. A feature that never varies stays at 0.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.plans.train import LABEL_COL

INTERCEPT = -1
#: MLlib stops on the loss's relative improvement (1e-6), not on single entries.
TOLERANCE = 1e-3


def vector_entries(vector: Column | str) -> Column:
    """``array<struct<index,value>>`` of an ML vector's stored entries (all of a dense one)."""
    v = F.unwrap_udt(vector)
    sparse = F.zip_with(v["indices"], v["values"], lambda i, x: F.struct(i.alias("index"), x.alias("value")))
    dense = F.transform(v["values"], lambda x, i: F.struct(i.alias("index"), x.alias("value")))
    return F.when(v["type"] == F.lit(0), sparse).otherwise(dense)


def gradient(scored: DataFrame, lr: LogisticRegressionModel, label: str = LABEL_COL) -> DataFrame:
    """``(feature, coefficient, gradient, violation, varies, train_rows)``, one row for every
    feature that the rows hold or the model weighs, and one for the intercept (feature -1).

    ``scored`` is the training table transformed by the model (features, probability, label).
    """
    spark = scored.sparkSession
    residual = vector_to_array(lr.getProbabilityCol())[1] - F.col(label)
    marker = F.array(F.struct(F.lit(INTERCEPT).alias("index"), F.lit(1.0).alias("value")))
    rows = scored.select(
        residual.alias("r"), F.inline(F.concat(marker, vector_entries(lr.getFeaturesCol())))
    )
    sums = rows.groupBy(F.col("index").alias("feature")).agg(
        F.sum(F.col("r") * F.col("value")).alias("g"),
        F.sum("value").alias("s1"),
        F.sum(F.col("value") * F.col("value")).alias("s2"),
    )
    n = sums.agg(F.max(F.when(F.col("feature") == F.lit(INTERCEPT), F.col("s1")))).scalar()
    weights = [(INTERCEPT, float(lr.intercept)), *((i, float(c)) for i, c in enumerate(lr.coefficients.toArray()) if c != 0.0)]
    coef = spark.createDataFrame(weights, "feature int, coefficient double")
    every = sums.join(coef, "feature", "full").select(
        "feature", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("coefficient", "g", "s1", "s2")], n.alias("n")
    )
    var = (F.col("s2") - F.col("s1") * F.col("s1") / F.col("n")) / F.greatest(F.col("n") - F.lit(1.0), F.lit(1.0))
    every = every.withColumn("s", F.sqrt(F.greatest(var, F.lit(0.0))))

    reg, l1 = lr.getRegParam(), lr.getElasticNetParam()
    s, b = F.col("s"), F.col("coefficient")
    pull = F.lit(1.0) if lr.getStandardization() else F.try_divide(F.lit(1.0), s)
    g = F.try_divide(F.col("g"), F.col("n") * s)
    smooth = g + F.lit(reg * (1.0 - l1)) * b * s * pull * pull
    edge = F.lit(reg * l1) * pull
    off = F.when(b != F.lit(0.0), F.abs(smooth + edge * F.signum(b))).otherwise(F.greatest(F.abs(smooth) - edge, F.lit(0.0)))
    is_intercept = F.col("feature") == F.lit(INTERCEPT)
    mean_residual = F.col("g") / F.col("n")
    varies = ~is_intercept & (s > F.lit(0.0))
    return every.select(
        "feature",
        "coefficient",
        F.when(is_intercept, mean_residual).when(varies, smooth).otherwise(F.lit(0.0)).alias("gradient"),
        F.when(is_intercept, F.abs(mean_residual) if lr.getFitIntercept() else F.lit(0.0))
        .when(varies, off)
        .otherwise(F.abs(b))
        .alias("violation"),
        varies.alias("varies"),
        F.col("n").cast("bigint").alias("train_rows"),
    )


def certificate(gradients: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """One row: ``train_rows, features`` (that vary), ``weighted`` (coefficient not 0),
    ``max_violation`` and ``optimal`` (at most ``tolerance``; false for an empty table)."""
    worst = F.max("violation")
    return gradients.agg(
        F.coalesce(F.max("train_rows"), F.lit(0)).cast("bigint").alias("train_rows"),
        F.count_if("varies").alias("features"),
        F.count_if((F.col("feature") != F.lit(INTERCEPT)) & (F.col("coefficient") != F.lit(0.0))).alias("weighted"),
        worst.alias("max_violation"),
        F.coalesce(worst <= F.lit(tolerance), F.lit(False)).alias("optimal"),
    )
