"""Training: the 5-stage MLlib pipeline, cross-validation with features shared
inside each fold, the CV result table, save / load and model metadata.

Cross-validation over the whole pipeline (as ``CrossValidator(estimator=Pipeline)``
does) re-tokenises, re-hashes and refits IDF for every (fold, parameter) pair.
Here the stateless stages (Tokenizer, StopWordsRemover, HashingTF) run once, IDF
is fitted once per fold on that fold's training part only (no leakage from the
validation part), and the parameter grid is fitted on the persisted fold
features in parallel threads. Folds come from a hash of the row id, so they do
not depend on partitioning.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.config import TrainConfig
from textlab.functions.stopwords import english_stop_words
from textlab.operators import evaluate as ev
from textlab.operators.features import hashed_vectors, materialized
from textlab.operators.split import hash_split, with_folds

TEXT_COL = "review_combined"
LABEL_COL = "label"
# Rows per partition of persisted training features: every L-BFGS iteration is one Spark job
# over all partitions, so text splits by the thousand would pay per-task overhead a hundred times.
ROWS_PER_PARTITION = 50_000


def right_size(df: DataFrame, n_rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Coalesce (no shuffle) to ``ceil(n_rows / rows_per_partition)`` partitions, and no fewer than
    the session's cores, so that a fit of any size runs in parallel."""
    target = max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // rows_per_partition))
    return df.coalesce(target) if df.rdd.getNumPartitions() > target else df


def featurizer_stages(cfg: TrainConfig = TrainConfig()) -> list:
    """Tokenizer -> StopWordsRemover -> HashingTF (no fitted state)."""
    return [
        Tokenizer(inputCol=TEXT_COL, outputCol="tokens"),
        StopWordsRemover(
            inputCol="tokens",
            outputCol="tokens_filtered",
            stopWords=english_stop_words(cfg.keep_negations),
        ),
        HashingTF(inputCol="tokens_filtered", outputCol="raw_features", numFeatures=cfg.num_features),
    ]


def idf_stage(cfg: TrainConfig = TrainConfig()) -> IDF:
    return IDF(inputCol="raw_features", outputCol="features", minDocFreq=cfg.min_doc_freq)


def classifier(cfg: TrainConfig = TrainConfig(), reg_param: float | None = None, elastic_net: float | None = None) -> LogisticRegression:
    lr = LogisticRegression(featuresCol="features", labelCol=LABEL_COL, maxIter=cfg.max_iter, family="binomial")
    if reg_param is not None:
        lr = lr.setRegParam(reg_param)
    if elastic_net is not None:
        lr = lr.setElasticNetParam(elastic_net)
    return lr


def sentiment_pipeline(cfg: TrainConfig = TrainConfig(), reg_param: float | None = None, elastic_net: float | None = None) -> Pipeline:
    """The 5-stage pipeline: Tokenizer, StopWordsRemover, HashingTF, IDF, LogisticRegression."""
    return Pipeline(stages=[*featurizer_stages(cfg), idf_stage(cfg), classifier(cfg, reg_param, elastic_net)])


def param_grid(cfg: TrainConfig = TrainConfig()) -> list[tuple[float, float]]:
    """(regParam, elasticNetParam) pairs; elasticNet 0 is pure L2, 1 pure L1."""
    return [(r, e) for r in cfg.reg_params for e in cfg.elastic_net_params]


CV_SCHEMA = T.StructType(
    [
        T.StructField("reg_param", T.DoubleType()),
        T.StructField("elastic_net", T.DoubleType()),
        T.StructField("fold", T.IntegerType()),
        T.StructField("auc", T.DoubleType()),
        T.StructField("train_rows", T.LongType()),
        T.StructField("validation_rows", T.LongType()),
    ]
)


CELL = ("reg_param", "elastic_net", "fold")


def _areas(cells: list[tuple], scored: list[DataFrame], cfg: TrainConfig) -> list[tuple]:
    """The CV table's rows; a cell whose validation part is empty has no area (NULL)."""
    if cfg.cv_num_bins > 0:
        binned = BinaryClassificationEvaluator(labelCol=LABEL_COL, metricName="areaUnderROC", numBins=cfg.cv_num_bins)
        found = {c[:3]: binned.evaluate(s) for c, s in zip(cells, scored, strict=True)}
    else:
        margin = vector_to_array("rawPrediction")[1].alias("score")
        every = reduce(DataFrame.unionByName, [s.select(*CELL, LABEL_COL, margin) for s in scored])
        found = {tuple(a)[:3]: a.auc_roc for a in ev.auc_by(every, CELL, LABEL_COL).collect()}  # one row a cell
    return [(*c[:3], found.get(c[:3]), *c[3:]) for c in cells]


def cross_validate(spark: SparkSession, train: DataFrame, cfg: TrainConfig = TrainConfig(), id_col: str = "review_id") -> DataFrame:
    """k-fold CV of the grid, AUC on rawPrediction per (params, fold).

    The fold features are prepared first (one IDF fit per fold, persisted and
    right-sized), then all (fold, params) fits run concurrently in
    ``cfg.parallelism`` driver threads, each a chain of small Spark jobs. The fitted
    models score their validation parts into one table, and the exact areas of all
    curves come from one set of prefix sums over it (``evaluate.auc_by``); a positive
    ``cfg.cv_num_bins`` asks for MLlib's binned areas, one evaluator a curve, instead.
    Returns a small DataFrame ``(reg_param, elastic_net, fold, auc, train_rows,
    validation_rows)``: the metric values are the only data that reaches the driver.
    """
    folded = with_folds(train, id_col, cfg.split)
    tf = Pipeline(stages=featurizer_stages(cfg)).fit(folded).transform(folded)
    tf = tf.select(id_col, LABEL_COL, "fold", "raw_features").persist(StorageLevel.MEMORY_AND_DISK)
    grid = param_grid(cfg)
    persisted: list[DataFrame] = [tf]
    try:
        n_all = tf.count()
        folds = []
        for k in range(cfg.split.folds):
            fit_part = tf.filter(F.col("fold") != F.lit(k))
            val_part = tf.filter(F.col("fold") == F.lit(k))
            idf_model = idf_stage(cfg).fit(fit_part)
            fit_f = idf_model.transform(fit_part).select(LABEL_COL, "features")
            val_f = idf_model.transform(val_part).select(LABEL_COL, "features")
            fit_f = right_size(fit_f, n_all).persist(StorageLevel.MEMORY_AND_DISK)
            val_f = right_size(val_f, n_all).persist(StorageLevel.MEMORY_AND_DISK)
            persisted += [fit_f, val_f]
            folds.append((k, fit_f, val_f, fit_f.count(), val_f.count()))

        def fit(task: tuple) -> tuple[tuple, DataFrame]:
            (k, fit_f, val_f, n_fit, n_val), params = task
            cell = (float(params[0]), float(params[1]), int(k))
            out = classifier(cfg, *params).fit(fit_f).transform(val_f)
            marked = out.select(LABEL_COL, "rawPrediction", *[F.lit(v).alias(c) for c, v in zip(CELL, cell, strict=True)])
            return (*cell, n_fit, n_val), marked

        tasks = [(f, p) for f in folds for p in grid]
        with ThreadPoolExecutor(max_workers=max(1, min(cfg.parallelism, len(tasks)))) as pool:
            cells, scored = zip(*pool.map(fit, tasks), strict=True)
        rows = _areas(list(cells), list(scored), cfg)
    finally:
        for p in persisted:
            p.unpersist()
    return spark.createDataFrame(rows, CV_SCHEMA)


def cv_table(cv: DataFrame) -> DataFrame:
    """Mean and standard deviation of AUC per parameter pair, rank, and the best marker
    (ties all marked). The window spans the few grid rows only."""
    agg = cv.groupBy("reg_param", "elastic_net").agg(
        F.round(F.avg("auc"), 6).alias("mean_auc"),
        F.round(F.stddev("auc"), 6).alias("std_auc"),
        F.count(F.lit(1)).cast("int").alias("folds"),
    )
    w = Window.orderBy(F.col("mean_auc").desc())
    return agg.select("*", F.rank().over(w).alias("rank")).withColumn("is_best", F.col("rank") == F.lit(1))


def best_params(table: DataFrame) -> tuple[float, float]:
    """The best (regParam, elasticNet) pair; ties go to the smaller regularisation."""
    row = table.orderBy(F.col("mean_auc").desc(), "reg_param", "elastic_net").first()
    return float(row["reg_param"]), float(row["elastic_net"])


@dataclass
class TrainResult:
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    cv: DataFrame | None
    reg_param: float
    elastic_net: float


def train_model(
    spark: SparkSession,
    clean: DataFrame,
    cfg: TrainConfig = TrainConfig(),
    id_col: str = "review_id",
    tune: bool = True,
) -> TrainResult:
    """Split by key hash -> (optional) fold-shared CV -> refit the best pipeline on
    all training rows. ``clean`` needs ``review_id, review_combined, label``."""
    train, test = hash_split(clean, id_col, cfg.split)
    cv = None
    if tune:
        cv = cross_validate(spark, train, cfg, id_col)
        reg, en = best_params(cv_table(cv))
    else:
        reg, en = cfg.reg_params[0], cfg.elastic_net_params[0]
    model = fit_pipeline(train, cfg, reg, en)
    return TrainResult(model, train, test, cv, reg, en)


def with_hashed_counts(clean: DataFrame, cfg: TrainConfig = TrainConfig()) -> DataFrame:
    """``clean`` (cleaned texts: a-z, 0-9 and spaces only) with ``raw_features`` for its text, written:
    what :func:`featurizer_stages` make of it, by Arrow in the row's own task."""
    hashing = featurizer_stages(cfg)
    size, words = hashing[2].getNumFeatures(), [w.lower() for w in hashing[1].getStopWords()]
    found = hashed_vectors(clean, F.col(TEXT_COL), size, words)
    return materialized(found.drop(TEXT_COL).withColumnRenamed("vector", hashing[2].getOutputCol()))


def fit_pipeline(train: DataFrame, cfg: TrainConfig = TrainConfig(), reg_param: float | None = None, elastic_net: float | None = None) -> PipelineModel:
    """Fit the 5-stage pipeline with each part at the parallelism it needs.

    Tokenising, hashing and the IDF fit are text work and run on the input's
    partitions; only the hashed counts are persisted here, as the IDF factors cost less than a
    second copy, and coalesced (``right_size``) for the L-BFGS iterations, which are one small
    job each over the blocks that the fit itself keeps. The result is the same ``PipelineModel`` (Tokenizer, StopWordsRemover, HashingTF,
    IDFModel, LogisticRegressionModel) that ``sentiment_pipeline().fit`` returns. Where ``train`` holds
    :func:`with_hashed_counts`'s written counts, they are read as they are and nothing is persisted.
    """
    stages = featurizer_stages(cfg)
    tf, counted = train, "raw_features" in train.columns
    if not counted:
        for st in stages:
            tf = st.transform(tf)
        tf = tf.select(LABEL_COL, "raw_features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        idf_model = idf_stage(cfg).fit(tf)
        feats = idf_model.transform(tf).select(LABEL_COL, "features")
        lr_model = classifier(cfg, reg_param, elastic_net).fit(right_size(feats, idf_model.numDocs))
    finally:
        if not counted:
            tf.unpersist()
    return PipelineModel(stages=[*stages, idf_model, lr_model])


def save_model(model: PipelineModel, path: str) -> None:
    """Write the model, overwriting, so reruns are idempotent."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a saved PipelineModel; a missing path raises ``FileNotFoundError`` naming the fix."""
    try:
        return PipelineModel.load(path)
    except Exception as err:  # Py4J / Analysis errors carry the Hadoop message
        text = str(err)
        if "does not exist" in text or "PATH_NOT_FOUND" in text or "FileNotFound" in text:
            raise FileNotFoundError(f"no model at {path}: train and save one first (train_model + save_model)") from err
        raise


def _explicit_params(stage) -> str:
    out = {}
    for p, v in stage.extractParamMap().items():
        if stage.isSet(p):
            out[p.name] = v if isinstance(v, (int, float, str, bool)) or v is None else str(v)
    return json.dumps(out, sort_keys=True, default=str)


MODEL_INFO_SCHEMA = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("stage", T.StringType()),
        T.StructField("uid", T.StringType()),
        T.StructField("params", T.StringType()),
        T.StructField("model_path", T.StringType()),
    ]
)


def model_info(spark: SparkSession, model: PipelineModel, path: str = "", metrics_path: str | None = None) -> DataFrame:
    """Stage classes in order with uid and explicitly set params, plus the training
    metrics as a JSON string column when a metrics file exists (else ``{}``)."""
    rows = [(i, type(s).__name__, s.uid, _explicit_params(s), path) for i, s in enumerate(model.stages)]
    info = spark.createDataFrame(rows, MODEL_INFO_SCHEMA)
    metrics = "{}"
    if metrics_path:
        try:
            m = spark.read.json(metrics_path)
            first = m.select(F.to_json(F.struct(*m.columns)).alias("j")).first()
            metrics = first["j"] if first else "{}"
        except AnalysisException:
            metrics = "{}"
    return info.withColumn("training_metrics", F.lit(metrics))
