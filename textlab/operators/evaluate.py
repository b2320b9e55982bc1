"""Evaluation on the executors: metrics, confusion matrix, exact AUC / ROC,
per-class probability histograms, threshold sweeps and the verdict.

Every operator accepts any table with ``label`` (0/1), ``prediction`` (0/1) and
``score`` (positive-class probability). Nothing is collected: the score table is
first reduced to one row per distinct score (partial aggregation, so a score
shared by a third of the rows costs nothing extra), and ordered quantities use
the bucketed prefix sums of :mod:`textlab.operators.prefix`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlab.operators.prefix import exclusive_prefix_sums, previous_values

# --- fixed values: verdict rule (F1 and AUC floors) and histogram bins --------
VERDICT_RULES = (
    # (name, minimum F1, minimum AUC or None)
    ("excellent", 0.90, 0.95),
    ("good", 0.80, 0.85),
    ("acceptable", 0.70, None),
)
VERDICT_OTHERWISE = "deficient"
HISTOGRAM_BINS = 50
DEFAULT_SWEEP = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
# ------------------------------------------------------------------------------


def _is(col: str, v: int) -> Column:
    return F.col(col) == F.lit(v)


def score_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score") -> DataFrame:
    """One row per distinct score: positives, negatives and the four confusion cells."""
    pos, neg = _is(label, 1), _is(label, 0)
    pp, pn = _is(prediction, 1), _is(prediction, 0)
    return (
        scored.filter(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(
            F.count_if(pos).alias("pos"),
            F.count_if(neg).alias("neg"),
            F.count_if(pos & pp).alias("tp"),
            F.count_if(neg & pp).alias("fp"),
            F.count_if(pos & pn).alias("fn"),
            F.count_if(neg & pn).alias("tn"),
        )
    )


def score_counts_with_nulls(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    """``score_counts`` plus, from the same aggregate, ``n_rows`` (rows with the score) and
    ``null_scores``. Rows without a score are counted at -inf, with all cells zero;
    ``with_score`` drops a row that holds nothing else."""
    known = F.col(score).isNotNull()
    pos, neg = _is(label, 1) & known, _is(label, 0) & known
    pp, pn = _is(prediction, 1), _is(prediction, 0)
    return scored.groupBy(
        F.coalesce(F.col(score).cast("double"), F.lit(float("-inf"))).alias("score")
    ).agg(
        F.count_if(pos).alias("pos"),
        F.count_if(neg).alias("neg"),
        F.count_if(pos & pp).alias("tp"),
        F.count_if(neg & pp).alias("fp"),
        F.count_if(pos & pn).alias("fn"),
        F.count_if(neg & pn).alias("tn"),
        F.count_if(known).alias("n_rows"),
        F.count_if(~known).alias("null_scores"),
    )


def with_score(counts: DataFrame) -> DataFrame:
    """The rows of ``score_counts_with_nulls``, prefix-summed or not, that hold a score."""
    return counts.filter(F.col("n_rows") > F.lit(0)).drop("n_rows", "null_scores")


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (the zero_division=0 convention)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _metric_columns(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    n = tp + fp + fn + tn
    return [
        F.round(_ratio(tp + tn, n), 4).alias("accuracy"),
        F.round(_ratio(tp, tp + fp), 4).alias("precision"),
        F.round(_ratio(tp, tp + fn), 4).alias("recall"),
        F.round(_ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn), 4).alias("f1_score"),
    ]


def binary_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class (4 places) plus counts, one pass."""
    pos, neg = _is(label, 1), _is(label, 0)
    pp, pn = _is(prediction, 1), _is(prediction, 0)
    c = scored.agg(
        F.count_if(pos & pp).alias("tp"),
        F.count_if(neg & pp).alias("fp"),
        F.count_if(pos & pn).alias("fn"),
        F.count_if(neg & pn).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(
        *_metric_columns(tp, fp, fn, tn),
        (tp + fp + fn + tn).cast("bigint").alias("test_samples"),
        (tp + fn).cast("bigint").alias("positive_samples"),
        (fp + tn).cast("bigint").alias("negative_samples"),
        *[F.col(x).cast("bigint").alias(x) for x in ("tp", "fp", "fn", "tn")],
    )


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows ``(actual, predicted, n)`` for all four cells, zero cells included."""
    return _cells(binary_metrics(scored, label, prediction))


def confusion_from_counts(counts: DataFrame) -> DataFrame:
    """The confusion matrix from a per-score count table."""
    return _cells(counts.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]))


def _cells(m: DataFrame) -> DataFrame:
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
            for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    return m.select(F.inline(cells))


def _with_prefix(counts: DataFrame, buckets: int | None) -> DataFrame:
    return exclusive_prefix_sums(counts, "score", ["pos", "neg"], buckets=buckets)


def _auc_terms(p: DataFrame) -> Column:
    # positives at this score beat every lower-scored negative and tie half of the equal ones
    return F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))


def auc_exact(scored: DataFrame, label: str = "label", score: str = "score", buckets: int | None = None) -> DataFrame:
    """Exact area under the ROC curve (trapezoid over all distinct scores, ties count half).

    NULL when one class is absent.
    """
    p = _with_prefix(score_counts(scored, label, label, score), buckets)
    a = p.agg(
        F.sum(_auc_terms(p)).alias("s"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
        F.count(F.lit(1)).alias("n_scores"),
    )
    return a.select(
        F.round(F.try_divide(F.try_divide(F.col("s"), F.col("P")), F.col("N")), 6).alias("auc_roc"),
        F.col("P").cast("bigint").alias("positive_samples"),
        F.col("N").cast("bigint").alias("negative_samples"),
        F.col("n_scores").cast("bigint").alias("n_scores"),
    )


def auc_by(
    scored: DataFrame, by: Sequence[str], label: str = "label", score: str = "score", buckets: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve of every group of ``by`` from one job:
    ``(*by, auc_roc, positive_samples, negative_samples, n_scores)``.

    Rows are first counted per group and distinct score; the prefix sums are those of all
    groups at once. Rows without a score are left out, so a group with none is not in the
    result. ``auc_roc`` is not rounded and NULL where a group lacks a class.
    """
    counts = (
        scored.filter(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("score"))
        .agg(F.count_if(_is(label, 1)).alias("pos"), F.count_if(_is(label, 0)).alias("neg"))
    )
    p = exclusive_prefix_sums(counts, "score", ["pos", "neg"], buckets=buckets, by=by)
    a = p.groupBy(*by).agg(
        F.sum(_auc_terms(p)).alias("s"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
        F.count(F.lit(1)).alias("n_scores"),
    )
    return a.select(
        *by,
        F.try_divide(F.try_divide(F.col("s"), F.col("P")), F.col("N")).alias("auc_roc"),
        F.col("P").cast("bigint").alias("positive_samples"),
        F.col("N").cast("bigint").alias("negative_samples"),
        F.col("n_scores").cast("bigint").alias("n_scores"),
    )


def evaluation_summary(
    scored: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
    buckets: int | None = None,
) -> DataFrame:
    """The metrics record: accuracy, precision, recall, F1, AUC (4 places), sample
    counts, the number of rows without a score (``null_scores``, in no other count) and the
    verdict, from one reduction of the score table."""
    return summary_from_prefixed(_with_prefix(score_counts_with_nulls(scored, label, prediction, score), buckets))


def summary_from_prefixed(p: DataFrame) -> DataFrame:
    """The metrics record from a prefix-summed per-score table; ``null_scores`` where it has them."""
    nulls = [c for c in ("null_scores",) if c in p.columns]
    a = p.agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn", "pos", "neg", *nulls)],
        F.sum(_auc_terms(p)).alias("s"),
    )
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    out = a.select(
        *_metric_columns(tp, fp, fn, tn),
        F.round(F.try_divide(F.try_divide(F.col("s"), F.col("pos")), F.col("neg")), 4).alias("auc_roc"),
        (F.col("pos") + F.col("neg")).cast("bigint").alias("test_samples"),
        F.col("pos").cast("bigint").alias("positive_samples"),
        F.col("neg").cast("bigint").alias("negative_samples"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in nulls],
    )
    return out.withColumn("verdict", verdict(F.col("f1_score"), F.col("auc_roc")))


def verdict(f1: Column, auc: Column) -> Column:
    """Quality verdict from F1 and AUC floors (first rule that holds)."""
    expr = None
    for name, f1_min, auc_min in VERDICT_RULES:
        cond = f1 >= F.lit(f1_min)
        if auc_min is not None:
            cond = cond & (auc >= F.lit(auc_min))
        cond = F.coalesce(cond, F.lit(False))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(VERDICT_OTHERWISE))


def roc_points(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    buckets: int | None = None,
    drop_intermediate: bool = False,
) -> DataFrame:
    """ROC points ``(threshold, tp, fp, tpr, fpr)``: one per distinct score (predict
    positive when score >= threshold), plus the origin at threshold +inf.

    ``drop_intermediate`` drops points collinear with their neighbours, as the
    common ``roc_curve`` default does. In descending-threshold order a point's
    second differences are ``pos(next lower score) - pos(score)`` (and the same
    for negatives), so a point is kept when it is the highest or lowest score or
    its counts differ from those of the next lower score.
    """
    return roc_from_prefixed(_with_prefix(score_counts(scored, label, label, score), buckets), drop_intermediate, buckets)


def roc_from_prefixed(p: DataFrame, drop_intermediate: bool = False, buckets: int | None = None) -> DataFrame:
    """ROC points from a prefix-summed per-score table."""
    if drop_intermediate:
        p = previous_values(p, "score", ["pos", "neg"], buckets)
        highest = (F.col("pos_total") - F.col("pos_before") == F.col("pos")) & (
            F.col("neg_total") - F.col("neg_before") == F.col("neg")
        )
        keep = (
            highest
            | F.col("prev_pos").isNull()
            | (F.col("prev_pos") != F.col("pos"))
            | (F.col("prev_neg") != F.col("neg"))
        )
        p = p.filter(keep)
    tp = F.col("pos_total") - F.col("pos_before")
    fp = F.col("neg_total") - F.col("neg_before")
    pts = p.select(
        F.col("score").alias("threshold"),
        tp.cast("bigint").alias("tp"),
        fp.cast("bigint").alias("fp"),
        F.round(F.try_divide(tp.cast("double"), F.col("pos_total")), 6).alias("tpr"),
        F.round(F.try_divide(fp.cast("double"), F.col("neg_total")), 6).alias("fpr"),
    )
    origin = p.agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit(float("inf")).alias("threshold"),
        F.lit(0).cast("bigint").alias("tp"),
        F.lit(0).cast("bigint").alias("fp"),
        F.lit(0.0).alias("tpr"),
        F.lit(0.0).alias("fpr"),
    )
    return origin.unionByName(pts)


def probability_histogram(
    scored: DataFrame, label: str = "label", score: str = "score", bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Per actual class, ``bins`` equal-width bins over that class's own min..max (last bin
    closed; a class with one distinct value is centred in a unit range), empty bins included.

    Rows are first reduced to one per distinct score (partial aggregation), and
    binned with weights. Only classes 0 and 1 are histogrammed, so the per-class
    range table has at most two rows: its broadcast has a proven bound.
    """
    return histogram_from_counts(score_counts(scored, label, label, score), bins)


def histogram_from_counts(counts: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """The per-class histograms from a per-score count table (``score, pos, neg``)."""
    per_class = F.array(
        F.struct(F.lit(1).alias("label"), F.col("pos").alias("n")),
        F.struct(F.lit(0).alias("label"), F.col("neg").alias("n")),
    )
    s = counts.select("score", F.inline(per_class)).filter(F.col("n") > F.lit(0))
    rng = s.groupBy("label").agg(F.min("score").alias("lo0"), F.max("score").alias("hi0"))
    same = F.col("lo0") == F.col("hi0")
    rng = rng.select(
        "label",
        F.when(same, F.col("lo0") - F.lit(0.5)).otherwise(F.col("lo0")).alias("lo"),
        F.when(same, F.col("hi0") + F.lit(0.5)).otherwise(F.col("hi0")).alias("hi"),
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))

    def edge(i: Column) -> Column:
        return F.when(i >= F.lit(bins), F.col("hi")).otherwise(i.cast("double") * step + F.col("lo"))

    j = s.join(F.broadcast(rng), "label")
    raw = F.floor((F.col("score") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(float(bins))).cast("int")
    idx0 = F.least(raw, F.lit(bins - 1))
    idx1 = F.when(F.col("score") < edge(idx0), idx0 - F.lit(1)).otherwise(idx0)
    idx = F.when(
        (F.col("score") >= edge(idx1 + F.lit(1))) & (idx1 != F.lit(bins - 1)), idx1 + F.lit(1)
    ).otherwise(idx1)
    hist = j.groupBy("label", idx.alias("bin")).agg(F.sum("n").alias("n"))
    frame = rng.select("label", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    frame = frame.select(
        "label", "bin", edge(F.col("bin")).alias("bin_lo"), edge(F.col("bin") + F.lit(1)).alias("bin_hi")
    )
    return frame.join(hist, ["label", "bin"], "left").select(
        "label",
        "bin",
        F.round("bin_lo", 9).alias("bin_lo"),
        F.round("bin_hi", 9).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
    )


def threshold_sweep(
    scored: DataFrame,
    thresholds: Sequence[float] = DEFAULT_SWEEP,
    label: str = "label",
    score: str = "score",
) -> DataFrame:
    """Metrics for ``prediction = score > t`` at every threshold, in one pass over the scores.

    Each distinct score gets the number of thresholds below it; counts per that
    index are suffix-summed over at most ``len(thresholds) + 1`` rows, so the
    work does not multiply rows by thresholds.
    """
    return sweep_from_counts(score_counts(scored, label, label, score), thresholds)


def sweep_from_counts(counts: DataFrame, thresholds: Sequence[float] = DEFAULT_SWEEP) -> DataFrame:
    """The threshold sweep from a per-score count table."""
    ts = sorted(set(float(t) for t in thresholds))
    k = len(ts)
    arr = F.array(*[F.lit(t) for t in ts])
    c = counts.select(
        F.size(F.filter(arr, lambda t: t < F.col("score"))).alias("idx"), "pos", "neg"
    )
    per = c.groupBy("idx").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # the full index domain 0..k, derived from the per-index table so empty indexes appear
    dom = per.agg(F.count(F.lit(1)).alias("_n")).select(F.explode(F.sequence(F.lit(0), F.lit(k))).alias("idx"))
    full = dom.join(per, "idx", "left").select(
        "idx", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg")
    )
    w_suffix = Window.orderBy(F.col("idx").desc()).rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy()
    suf = full.select(
        "idx",
        F.sum("pos").over(w_suffix).alias("tp"),
        F.sum("neg").over(w_suffix).alias("fp"),
        F.sum("pos").over(w_all).alias("P"),
        F.sum("neg").over(w_all).alias("N"),
    ).filter(F.col("idx") >= F.lit(1))
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    return suf.select(
        F.element_at(arr, F.col("idx")).alias("threshold"),
        tp.cast("bigint").alias("tp"),
        fp.cast("bigint").alias("fp"),
        fn.cast("bigint").alias("fn"),
        tn.cast("bigint").alias("tn"),
        *_metric_columns(tp, fp, fn, tn),
    )
