"""A training run on record: split, cross-validation, refit, evaluation, metrics file and
model metadata under one run id.

The id is a digest of the configuration and of the training table (row count and an
order-free sum of row hashes), so the same run started again, for instance after its
driver was lost, finds what it has finished. Each step writes its own folder
``root/run=<id>/<step>`` with overwrite and counts as finished once its last file is
there; a finished step is read back instead of repeated. The ledger itself, ``root/ledger``,
is partitioned by run and overwritten partition by partition, so a run recorded twice
stands there once, and other runs stay as they are.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.config import TrainConfig
from textlab.operators import evaluate as ev
from textlab.operators.split import hash_split
from textlab.plans.evaluate import METRIC_FIELDS, predictions, save_metrics_json
from textlab.plans.train import (
    best_params,
    cross_validate,
    cv_table,
    fit_pipeline,
    load_model,
    model_info,
    save_model,
)

LEDGER_SCHEMA = "run_id string, step string, name string, value string"
METRICS_SCHEMA = ", ".join(f"{c} {'long' if c.endswith('samples') else 'double'}" for c in METRIC_FIELDS)


def run_id(clean: DataFrame, cfg: TrainConfig, id_col: str = "review_id") -> str:
    """Digest of configuration and training rows; the rows' order and layout play no part."""
    row = F.xxhash64(F.col(id_col).cast("string"), "review_combined", "label").cast("decimal(38,0)")
    rows = clean.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row), F.lit(0)).alias("h")).first()
    body = json.dumps([asdict(cfg), id_col, rows["n"], str(rows["h"])], sort_keys=True)
    return hashlib.sha256(body.encode()).hexdigest()[:16]


@dataclass(frozen=True)
class RunStore:
    """The folders of one run."""

    spark: SparkSession
    root: str
    run: str

    def path(self, step: str) -> str:
        return f"{self.root.rstrip('/')}/run={self.run}/{step}"

    def finished(self, step: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(step)}/_SUCCESS")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def table(self, step: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The step's table, made only if no earlier attempt finished it."""
        if not self.finished(step):
            make().write.mode("overwrite").parquet(self.path(step))
        return self.spark.read.parquet(self.path(step))

    def model(self, step: str, make: Callable[[], PipelineModel]) -> PipelineModel:
        """As ``table``; the marker is written after the model's last stage."""
        marker = f"{step}-saved"
        if not self.finished(marker):
            save_model(make(), self.path(step))
            self.spark.range(1).write.mode("overwrite").parquet(self.path(marker))
        return load_model(self.path(step))


def _rows(df: DataFrame, step: str, names: dict) -> DataFrame:
    """``step, name, value`` of the named columns, one row each."""
    pairs = F.array(*[F.struct(F.lit(k).alias("name"), c.cast("string").alias("value")) for k, c in names.items()])
    return df.select(F.lit(step).alias("step"), F.inline(pairs))


def record_run(
    spark: SparkSession, clean: DataFrame, root: str, cfg: TrainConfig = TrainConfig(), id_col: str = "review_id"
) -> DataFrame:
    """Train and evaluate ``clean(review_id, review_combined, label)`` on record; the run's rows of
    the ledger ``(run_id, step, name, value)``, read back."""
    store = RunStore(spark, root, run_id(clean, cfg, id_col))
    train, test = hash_split(clean, id_col, cfg.split)

    def sizes() -> DataFrame:
        parts = train.select("label", F.lit("train").alias("part")).unionByName(
            test.select("label", F.lit("test").alias("part"))
        )
        return parts.groupBy("part", "label").agg(F.count(F.lit(1)).alias("n"))

    split = store.table("split", sizes)
    cv = store.table("cv", lambda: cross_validate(spark, train, cfg, id_col))
    reg, elastic = best_params(cv_table(cv))
    model = store.model("model", lambda: fit_pipeline(train, cfg, reg, elastic))
    scored = store.table("predictions", lambda: predictions(model, test, id_col))
    if not store.finished("metrics"):
        save_metrics_json(ev.evaluation_summary(scored), store.path("metrics"))
    metrics = spark.read.schema(METRICS_SCHEMA).json(store.path("metrics"))
    info = store.table("info", lambda: model_info(spark, model, store.path("model"), store.path("metrics")))

    split_rows = split.select(
        F.lit("split").alias("step"),
        F.concat_ws("_", "part", F.lit("label"), F.col("label").cast("int").cast("string")).alias("name"),
        F.col("n").cast("string").alias("value"),
    )
    grid = F.concat(F.lit("reg"), F.col("reg_param").cast("string"), F.lit("_en"), F.col("elastic_net").cast("string"))
    cv_rows = cv.select(
        F.lit("cv").alias("step"),
        F.inline(F.array(
            F.struct(F.concat_ws("_", F.concat(F.lit("fold"), F.col("fold")), F.lit("auc"), grid).alias("name"),
                     F.col("auc").cast("string").alias("value")),
            F.struct(F.concat(F.lit("fold"), F.col("fold"), F.lit("_train_rows")).alias("name"),
                     F.col("train_rows").cast("string").alias("value")),
            F.struct(F.concat(F.lit("fold"), F.col("fold"), F.lit("_validation_rows")).alias("name"),
                     F.col("validation_rows").cast("string").alias("value")),
        )),
    ).distinct()
    refit = _rows(spark.range(1), "refit", {"reg_param": F.lit(reg), "elastic_net": F.lit(elastic)})
    verdict = ev.verdict(F.col("f1_score"), F.col("auc_roc"))
    metric_rows = _rows(metrics, "metrics", {c: F.col(c) for c in METRIC_FIELDS} | {"verdict": verdict})
    info_rows = info.select(
        F.lit("model").alias("step"),
        F.inline(F.array(
            F.struct(F.concat(F.lit("stage"), F.col("position")).alias("name"), F.col("stage").alias("value")),
            F.struct(F.concat(F.lit("params"), F.col("position")).alias("name"), F.col("params").alias("value")),
        )),
    ).unionByName(info.limit(1).select(
        F.lit("model").alias("step"), F.lit("training_metrics").alias("name"), F.col("training_metrics").alias("value")
    ))
    rows = split_rows.unionByName(cv_rows).unionByName(refit).unionByName(metric_rows).unionByName(info_rows)
    ledger = f"{root.rstrip('/')}/ledger"
    (
        rows.withColumn("run_id", F.lit(store.run)).coalesce(1)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(ledger)
    )
    return read_ledger(spark, root).filter(F.col("run_id") == store.run)


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """All recorded runs."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{root.rstrip('/')}/ledger")


def audit_run(record: DataFrame) -> DataFrame:
    """``step, name, value`` (long): the counts on a run's record, and as 0 or 1 whether it is
    consistent: metrics in [0, 1], the verdict its rule's, the refit at the best mean AUC,
    the samples those of the split's test part, five stages, the file's metrics in the model's metadata."""
    value = F.col("value").cast("double")

    def one(step: str, name: str, of=value):
        return F.max(F.when((F.col("step") == step) & (F.col("name") == name), of))

    text = F.col("value")
    rates = [c for c in METRIC_FIELDS if not c.endswith("samples")]
    cells = record.filter("step = 'cv' and name like '%_auc_%'").select(
        F.regexp_extract("name", "_auc_(.*)$", 1).alias("grid"), value.alias("auc")
    )
    means = cells.groupBy("grid").agg(F.round(F.avg("auc"), 6).alias("auc"), F.count(F.lit(1)).alias("n"))
    best = means.agg(
        F.struct(
            F.max("auc").alias("best"), F.sum("n").alias("cells"), F.collect_list(F.struct("grid", "auc")).alias("means")
        ).alias("_cv")
    ).scalar()
    facts = record.agg(
        *[one("metrics", c).alias(c) for c in METRIC_FIELDS],
        one("metrics", "verdict", text).alias("verdict"),
        one("model", "training_metrics", text).alias("_file"),
        F.concat(F.lit("reg"), one("refit", "reg_param", text), F.lit("_en"), one("refit", "elastic_net", text)).alias("_refit"),
        F.count_if((F.col("step") == "model") & F.col("name").startswith("stage")).alias("_stages"),
        F.sum(F.when((F.col("step") == "split") & F.col("name").startswith("test"), value)).alias("_test"),
    ).withColumn("_cv", best)
    inside = F.lit(True)
    for c in rates:
        inside = inside & F.col(c).between(0, 1)
    chosen = F.get(F.filter("_cv.means", lambda m: m["grid"] == F.col("_refit")), F.lit(0))["auc"]
    checks = {
        "metrics_in_range": inside,
        "verdict_follows_rule": ev.verdict(F.col("f1_score"), F.col("auc_roc")) == F.col("verdict"),
        "refit_at_best_mean_auc": chosen == F.col("_cv.best"),
        "samples_are_the_test_part": F.col("test_samples") == F.col("_test"),
        "metadata_holds_metrics": F.get_json_object("_file", "$.test_samples").cast("double") == F.col("test_samples"),
    }
    numbers = {"cv_cells": F.col("_cv.cells"), "stages": F.col("_stages")}
    counts = record.filter(
        "step = 'split' or (step = 'cv' and name like '%rows') or (step = 'metrics' and name like '%samples')"
    ).select("step", "name", value.cast("long").alias("value"))
    audit = facts.select(F.lit("audit").alias("step"), F.inline(F.array(*[
        F.struct(F.lit(k).alias("name"), F.coalesce(c.cast("long"), F.lit(0).cast("long")).alias("value"))
        for k, c in (numbers | checks).items()
    ])))
    return counts.unionByName(audit)
