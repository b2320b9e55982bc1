"""Registered queries: Structured Streaming (H1-H3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.operators.split import hash_key
from textlab.plans.catalog import register
from textlab.session import scratch_path
from textlab.sources import views
from textlab.sources.readers import read_table
from textlab.streaming.scoring import file_stream, running_summary, sink_rows, start_scoring, start_summary, table_stream

ARRIVAL_SEED = 7  # of the hash that deals documents to the two arrivals

DOCUMENTS_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
LABELS_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType()),
    ]
)


@register("stream_score")
def q_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 + H2: documents arrive as a file stream, are validated, cleaned and scored
    by the batch-trained model; accepted rows and rejected requests go to two sinks."""
    from textlab.plans.catalog_model import _language_model

    model = _language_model(spark, sf_dir)
    docs = table_stream(spark, sf_dir, "documents", DOCUMENTS_SCHEMA)
    requests = views.reviews_from_documents(docs).select("review_id", "title", F.col("body").alias("text"))
    out, bad = scratch_path(spark, "stream-scored"), scratch_path(spark, "stream-quarantine")
    q = start_scoring(requests, model, out, bad)
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch")


@register("stream_requests")
def q_stream_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 + H2 over many batches and a restart: the documents arrive as part files in two
    halves, one file a batch; the scoring run ends after the first half and goes on from its
    checkpoint with the second. Every request is in one of the two sinks, with its reason."""
    from textlab.plans.catalog_model import _language_model

    docs = read_table(spark, sf_dir, "documents")
    half = F.coalesce(hash_key("doc_id", ARRIVAL_SEED) % F.lit(2), F.lit(0))
    model = _language_model(spark, sf_dir)
    landing, ckpt = scratch_path(spark, "stream-landing"), scratch_path(spark, "stream-resumed-ckpt")
    out, bad = scratch_path(spark, "stream-scored"), scratch_path(spark, "stream-quarantine")
    for arrival in (0, 1):
        docs.filter(half == F.lit(arrival)).write.mode("append").parquet(landing)
        stream = file_stream(spark, landing, docs.schema, max_files_per_trigger=1)
        requests = views.reviews_from_documents(stream).select("review_id", "title", F.col("body").alias("text"))
        start_scoring(requests, model, out, bad, checkpoint=ckpt).awaitTermination()
    return sink_rows(spark, out, bad)


@register("stream_summary")
def q_stream_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: running scored-batch summary of a label stream (complete mode, one state row)."""
    lab = table_stream(spark, sf_dir, "labels", LABELS_SCHEMA)
    summary = running_summary(views.scores_from_labels(lab))
    out = scratch_path(spark, "stream-summary")
    q = start_summary(summary, out)
    q.awaitTermination()
    return spark.read.parquet(out)
