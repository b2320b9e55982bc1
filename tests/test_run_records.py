"""Run ledger, content key and quarantine ledger."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from textlab.config import TrainConfig
from textlab.plans import ledger
from textlab.plans.transform import clean_documents
from textlab.sources import views
from textlab.sources.readers import (
    canonical_reviews,
    quarantine_ledger,
    quarantine_reason,
    read_reviews_csv,
    split_quarantine,
    with_content_key,
)

SMALL = TrainConfig(max_iter=5, reg_params=(0.01, 0.1), elastic_net_params=(0.0,))


def test_a_run_survives_a_retry(spark, workdir, monkeypatch):
    clean = clean_documents(views.labelled_documents(spark, SF_SMALL, "quality"))
    first = ledger.record_run(spark, clean, workdir, SMALL)
    rows = {(r.step, r.name): r.value for r in first.collect()}
    run = first.first()["run_id"]
    assert len(rows) == first.count()
    audit = {r.name: r.value for r in ledger.audit_run(first).filter("step = 'audit'").collect()}
    assert audit == {"cv_cells": 6, "stages": 5, "metrics_in_range": 1, "verdict_follows_rule": 1,
                     "refit_at_best_mean_auc": 1, "samples_are_the_test_part": 1, "metadata_holds_metrics": 1}

    # the same rows in another layout are the same run, and nothing is trained again
    def never(*_a, **_k):
        raise AssertionError("trained again")

    with monkeypatch.context() as m:
        m.setattr(ledger, "cross_validate", never)
        m.setattr(ledger, "fit_pipeline", never)
        again = ledger.record_run(spark, clean.repartition(5), workdir, SMALL)
        assert {(r.step, r.name): r.value for r in again.collect()} == rows
    assert ledger.read_ledger(spark, workdir).count() == len(rows)

    # an attempt that stopped before its model was whole trains it again; other steps stay
    store = ledger.RunStore(spark, workdir, run)
    other = ledger.RunStore(spark, workdir, "other")
    assert store.finished("cv") and store.finished("model-saved") and not other.finished("cv")
    with monkeypatch.context() as m:
        m.setattr(ledger, "cross_validate", never)
        m.setattr(ledger.RunStore, "finished", lambda self, step, f=ledger.RunStore.finished: step != "model-saved" and f(self, step))
        third = ledger.record_run(spark, clean, workdir, SMALL)
    assert {(r.step, r.name) for r in third.collect()} == set(rows)

    # another configuration is another run beside it
    two = ledger.record_run(spark, clean, workdir, TrainConfig(max_iter=4, reg_params=(0.1,), elastic_net_params=(0.0,)))
    assert two.first()["run_id"] != run
    assert ledger.read_ledger(spark, workdir).select("run_id").distinct().count() == 2


def test_an_audit_finds_a_changed_record(spark, workdir):
    clean = clean_documents(views.labelled_documents(spark, SF_SMALL, "quality"))
    record = ledger.record_run(spark, clean, workdir, SMALL)

    def audit(name, value):
        changed = record.withColumn("value", F.when(F.col("name") == name, F.lit(value)).otherwise(F.col("value")))
        return {r.name: r.value for r in ledger.audit_run(changed).collect()}

    assert audit("verdict", "splendid")["verdict_follows_rule"] == 0
    assert audit("recall", "1.5")["metrics_in_range"] == 0
    assert audit("test_samples", "1")["samples_are_the_test_part"] == 0
    assert audit("training_metrics", "{}")["metadata_holds_metrics"] == 0


def test_content_key(spark):
    rows = [("5", "t", None, "EN")] * 40 + [("5", "t", "", "EN"), ("5", None, "t", "EN"), (None, None, None, None)] * 2
    df = spark.createDataFrame(rows + [("V1:a", "b", "x", "y"), ("a", "V1:b", "x", "y")], "rating string, title string, body string, country string")
    keys = [
        sorted(map(str, with_content_key(d, step=s).collect()))
        for d, s in ((df.coalesce(1), 1 << 16), (df.repartition(50), 1 << 16), (df.repartition(7, "body"), 3))
    ]
    assert keys[0] == keys[1] == keys[2] and len(set(keys[0])) == len(rows) + 2
    got = with_content_key(df, step=3)
    assert got.select("review_id").distinct().count() == df.count()
    same = got.filter("rating = '5' and title = 't' and body is null").select(F.split("review_id", "-")[1].cast("int").alias("n"))
    assert sorted(r.n for r in same.collect()) == list(range(40))
    assert with_content_key(df.limit(0)).count() == 0


def test_ids_of_a_file_do_not_depend_on_its_splits(spark, workdir):
    path = os.path.join(workdir, "r.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("Rating,Review Title,Review Text,Country\n")
        f.writelines(f'Rated {i % 5},t{i % 7},"text {i % 30}",EN\n' for i in range(3000))
    good, _ = split_quarantine(read_reviews_csv(spark, path, multiline=False))
    one = canonical_reviews(good.coalesce(1)).select("review_id", "body").exceptAll(
        canonical_reviews(good.repartition(50)).select("review_id", "body")
    )
    assert one.count() == 0 and canonical_reviews(good).select("review_id").distinct().count() == 3000


@pytest.mark.parametrize(
    "line, reason",
    [('5,"a,b"', "short"), ('5,t,"a ""b"", c",EN,x', "surplus"), ('5,t,"abc,EN', "unclosed_quote"), ('5,t,"a,b",EN', "other")],
)
def test_quarantine_reason(spark, line, reason):
    got = spark.createDataFrame([(line,)], "raw string").select(quarantine_reason(F.col("raw")).alias("r")).first()
    assert got.r == reason


def test_quarantine_ledger_reconciles(spark, workdir):
    path = os.path.join(workdir, "r.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('Rating,Review Title,Review Text,Country\n5,t,"x, y",EN\n4,t\n3,t,x,EN,more\n2,t,"x,EN\n1,t,x,EN\n')
    good, bad = split_quarantine(read_reviews_csv(spark, path, multiline=False))
    got = {r.reason: r.rows for r in quarantine_ledger(good, bad).collect()}
    assert got == {"good": 2, "short": 1, "surplus": 1, "unclosed_quote": 1, "all": 5}
    # whatever a query needs of a row, the verdict on it is the same
    assert bad.select("_corrupt_record").count() == bad.count() == 3 and good.select("Rating").count() == 2
    assert {r.reason: r.rows for r in quarantine_ledger(good.limit(0), bad.limit(0)).collect()}.get("all") in (None, 0)
