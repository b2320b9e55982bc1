"""Streaming equals batch on the same files."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from textlab.operators import profile
from textlab.plans.catalog_streaming import LABELS_SCHEMA
from textlab.session import scratch_path
from textlab.sources import views
from textlab.streaming.scoring import file_stream, running_summary, start_summary

from .conftest import SF_SMALL


def test_stream_summary_equals_batch(spark):
    stream = file_stream(spark, SF_SMALL, LABELS_SCHEMA, glob="labels.parquet")
    out = scratch_path(spark, "test-summary")
    q = start_summary(running_summary(views.scores_from_labels(stream)), out)
    q.awaitTermination()
    got = spark.read.parquet(out).first().asDict()
    want = profile.batch_summary(views.scores(spark, SF_SMALL), "prediction").first().asDict()
    assert got == want


def test_stream_score_equals_batch(spark):
    from textlab.operators.score import score, shape_predictions
    from textlab.plans.catalog_streaming import DOCUMENTS_SCHEMA
    from textlab.plans.train import fit_pipeline
    from textlab.plans.transform import clean_documents
    from textlab.streaming.scoring import start_scoring

    model = fit_pipeline(clean_documents(views.language_documents(spark, SF_SMALL)))
    docs = file_stream(spark, SF_SMALL, DOCUMENTS_SCHEMA, glob="documents.parquet")
    req = views.reviews_from_documents(docs).select("review_id", "title", F.col("body").alias("text"))
    out, bad = scratch_path(spark, "test-scored"), scratch_path(spark, "test-bad")
    start_scoring(req, model, out, bad).awaitTermination()
    streamed = spark.read.parquet(out).drop("batch")
    batch_req = views.reviews(spark, SF_SMALL).select("review_id", "title", F.col("body").alias("text"))
    from textlab.operators.score import split_requests

    accepted, rejected = split_requests(batch_req)
    batch = shape_predictions(score(accepted, model, title="title_s", text="text_s"))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert spark.read.parquet(bad).count() == rejected.count()


def test_scored_stream_is_stateless(spark):
    from textlab.plans.catalog_streaming import DOCUMENTS_SCHEMA
    from textlab.plans.train import fit_pipeline
    from textlab.plans.transform import clean_documents
    from textlab.streaming.scoring import scored_stream

    model = fit_pipeline(clean_documents(views.language_documents(spark, SF_SMALL)))
    docs = file_stream(spark, SF_SMALL, DOCUMENTS_SCHEMA, glob="documents.parquet")
    req = views.reviews_from_documents(docs).select("review_id", "title", F.col("body").alias("text"))
    out = scored_stream(req, model)
    assert out.isStreaming and "score" in out.columns
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    q = out.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "test-noop")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.lastProgress is not None and q.exception() is None


def test_csv_stream_ingest_equals_batch_read(spark, workdir):
    """H1 with the review CSV: the explicit schema is compulsory, multi-line quoted
    texts arrive whole, and the stream sees what a batch read sees."""
    import os

    from textlab.sources.readers import read_reviews_csv, write_reviews_csv
    from textlab.sources.schema import RAW_REVIEW_SCHEMA

    src = os.path.join(workdir, "incoming")
    write_reviews_csv(views.reviews(spark, SF_SMALL), src)
    stream = file_stream(spark, src, RAW_REVIEW_SCHEMA, fmt="csv", glob="*.csv")
    out = scratch_path(spark, "test-csv-stream")
    q = (
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "test-csv-ckpt")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    streamed = spark.read.parquet(out).drop("_corrupt_record")
    batch = read_reviews_csv(spark, src).drop("_corrupt_record")
    assert streamed.count() == batch.count() == views.reviews(spark, SF_SMALL).count()
    assert streamed.exceptAll(batch).count() == 0


def _requests(spark, folder, **kw):
    from textlab.plans.catalog_streaming import DOCUMENTS_SCHEMA

    docs = file_stream(spark, folder, DOCUMENTS_SCHEMA, **kw)
    return views.reviews_from_documents(docs).select("review_id", "title", F.col("body").alias("text"))


def test_a_stopped_stream_resumes_and_replaces_its_own_batch(spark, workdir):
    """One file a batch; the third batch fails after its rejected rows are written. The run that
    follows from the same checkpoint replays it, and both sinks hold every request once."""
    import os

    import pytest
    from pyspark.errors import StreamingQueryException

    from textlab.operators.score import score, shape_predictions, split_requests
    from textlab.plans.train import fit_pipeline
    from textlab.plans.transform import clean_documents
    from textlab.sources.readers import read_table
    from textlab.streaming.scoring import sink_rows, start_scoring

    model = fit_pipeline(clean_documents(views.language_documents(spark, SF_SMALL)))
    landing = os.path.join(workdir, "landing")
    read_table(spark, SF_SMALL, "documents").repartition(5).write.parquet(landing)
    out, bad, ckpt = (os.path.join(workdir, n) for n in ("scored", "rejected", "ckpt"))

    class Stops:
        calls = 0

        def transform(self, df):
            Stops.calls += 1
            if Stops.calls == 3:
                raise RuntimeError("executor gone")
            return model.transform(df)

    with pytest.raises(StreamingQueryException):
        start_scoring(_requests(spark, landing, max_files_per_trigger=1), Stops(), out, bad, ckpt).awaitTermination()
    assert sorted(n for n in os.listdir(bad) if n.startswith("batch")) == ["batch=0", "batch=1", "batch=2"]
    assert sorted(n for n in os.listdir(out) if n.startswith("batch")) == ["batch=0", "batch=1"]

    start_scoring(_requests(spark, landing, max_files_per_trigger=1), model, out, bad, ckpt).awaitTermination()
    assert len([n for n in os.listdir(out) if n.startswith("batch")]) == 5
    batch = views.reviews(spark, SF_SMALL).select("review_id", "title", F.col("body").alias("text"))
    accepted, rejected = split_requests(batch)
    want = shape_predictions(score(accepted, model, title="title_s", text="text_s"))
    got = spark.read.parquet(out).drop("batch")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    rows = sink_rows(spark, out, bad)
    assert rows.count() == batch.count() == rows.select("review_id").distinct().count()
    assert rows.filter("reject_reason is null").count() == rows.filter("scored").count() == accepted.count()
    reasons = lambda df: {(r.reject_reason, r["count"]) for r in df.groupBy("reject_reason").count().collect()}
    assert reasons(rows.filter("not scored")) == reasons(rejected)

    # nothing new has arrived: another run changes nothing
    start_scoring(_requests(spark, landing, max_files_per_trigger=1), model, out, bad, ckpt).awaitTermination()
    assert sink_rows(spark, out, bad).exceptAll(rows).count() == 0


def test_streamed_tables_may_be_folders_of_part_files(spark, workdir):
    from textlab.plans.catalog_streaming import q_stream_score, q_stream_summary

    docs = spark.range(40).selectExpr(
        "id as doc_id", "concat('some words of text beyond the forty characters of a title, number ', id) as text", "if(id % 2 = 0, 'en', 'de') as lang",
        "'web' as source", "cast(30 as bigint) as n_chars",
    )
    labels = spark.range(40).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "cast(0 as int) as toxic")
    got = []
    for kind in ("folder", "file"):
        sf_dir = f"{workdir}/{kind}"
        os.makedirs(sf_dir)
        for name, table in (("documents", docs), ("labels", labels)):
            if kind == "folder":
                table.repartition(3).write.parquet(f"{sf_dir}/{name}.parquet")
            else:
                table.toPandas().to_parquet(f"{sf_dir}/{name}.parquet")
        scored = q_stream_score(spark, sf_dir)
        got.append((q_stream_summary(spark, sf_dir).first().total, sorted(r.review_id for r in scored.collect())))
    assert got[0] == got[1] == (40, [i for i in range(40) if i % 11])  # without a body: rejected


def test_a_batch_of_one_task_is_dealt_over_the_cores(spark):
    from textlab.streaming.scoring import spread_batch

    one = spark.range(0, 400, 1, 1).selectExpr("7 as review_id", "'same text' as text")
    sizes = [len(p) for p in spread_batch(one).rdd.glom().collect()]
    assert sum(sizes) == 400 and sum(n > 0 for n in sizes) >= spark.sparkContext.defaultParallelism > 1
