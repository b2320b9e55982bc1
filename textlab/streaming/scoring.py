"""Structured Streaming: file ingest with an explicit schema, validate -> clean ->
score -> two sinks (scored rows and quarantined requests), and a running
scored-batch summary.

The same ``Column`` functions and the same ``PipelineModel`` as the batch path
are used, so streaming and batch results agree on the same files. Sinks are
written per micro-batch into ``batch=<id>`` folders with overwrite, so a batch
replayed after a failure replaces its own output instead of duplicating it.
Checkpoints live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from textlab.operators.score import score, shape_predictions, validate_requests
from textlab.session import scratch_path


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A file-source stream; the schema is compulsory (no inference on streams)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", True).option("multiLine", True).option("escape", '"')
    return r.load(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType) -> DataFrame:
    """One of the provided parquet tables as a file stream, be it one file or a folder of part files.

    A plain path has to be a folder, and a name filter on the parent finds files only; a path
    with a wildcard is resolved to the table itself, whichever of the two it is.
    """
    return file_stream(spark, f"{sf_dir.rstrip('/')}/{name}.parque[t]", schema)


def scored_stream(requests: DataFrame, model: PipelineModel, id_col: str = "review_id", preprocess: str = "train") -> DataFrame:
    """Validate each request and score the accepted ones (stateless, per row).

    Only accepted requests are scored; every step is a per-row projection, so the
    stream keeps no state. Use :func:`start_scoring` to also sink the rejected rows.
    """
    v = validate_requests(requests)
    accepted = v.filter(F.col("reject_reason").isNull())
    s = score(accepted, model, id_col=id_col, title="title_s", text="text_s", preprocess=preprocess)
    return shape_predictions(s, id_col=id_col, keep=("score",))


def spread_batch(batch: DataFrame) -> DataFrame:
    """A micro-batch dealt by row position, so that no key or copy gathers, over at least the cores."""
    n = max(batch.sparkSession.sparkContext.defaultParallelism, batch.rdd.getNumPartitions())
    return batch.repartition(n, F.monotonically_increasing_id())


def start_scoring(
    requests: DataFrame,
    model: PipelineModel,
    out_path: str,
    quarantine_path: str,
    checkpoint: str | None = None,
    id_col: str = "review_id",
    available_now: bool = True,
) -> StreamingQuery:
    """Run validate -> score into two parquet sinks with ``foreachBatch``.

    A batch may be one file with one row group, which is one task however many cores there
    are: its requests are dealt over the cores before any text work."""
    spark = requests.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-score-ckpt")

    def write_batch(arrived: DataFrame, batch_id: int) -> None:
        # two sinks read the micro-batch: keep it for the duration of this batch only
        batch = validate_requests(spread_batch(arrived)).persist()
        try:
            bad = batch.filter(F.col("reject_reason").isNotNull()).select(id_col, "reject_reason")
            bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
            good = batch.filter(F.col("reject_reason").isNull())
            s = score(good, model, id_col=id_col, title="title_s", text="text_s")
            out = shape_predictions(s, id_col=id_col)
            out.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    w = requests.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def sink_rows(spark: SparkSession, out_path: str, quarantine_path: str, id_col: str = "review_id") -> DataFrame:
    """Both sinks of :func:`start_scoring` as one table ``(id, reject_reason, scored)``.

    Accepted requests have no reason; ``scored`` says whether a prediction with a confidence
    in [0, 1] is on record, so a request that was lost or left unscored shows.
    """
    good = spark.read.parquet(out_path)
    whole = good["label"].isNotNull() & good["confidence"].between(0, 1)
    accepted = good.select(
        id_col, F.lit(None).cast("string").alias("reject_reason"), F.coalesce(whole, F.lit(False)).alias("scored")
    )
    rejected = spark.read.parquet(quarantine_path).select(id_col, "reject_reason", F.lit(False).alias("scored"))
    return accepted.unionByName(rejected)


def running_summary(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Running totals of a scored stream (one state row): total, positives, negatives, ratio."""
    pos = F.count_if(F.col(prediction) == F.lit(1))
    agg = scored.groupBy().agg(F.count(F.lit(1)).alias("total"), pos.alias("positive_count"))
    return agg.select(
        F.col("total").cast("bigint").alias("total"),
        F.col("positive_count").cast("bigint").alias("positive_count"),
        (F.col("total") - F.col("positive_count")).cast("bigint").alias("negative_count"),
        F.round(F.try_divide(F.col("positive_count"), F.col("total")), 4).alias("positive_ratio"),
    )


def start_summary(summary: DataFrame, out_path: str, checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Complete-mode summary written (overwrite) to ``out_path`` after every micro-batch."""
    spark = summary.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-summary-ckpt")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    w = summary.writeStream.outputMode("complete").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
