"""Readers: CSV with quarantine, contract check, missing paths, golden JSON, line source."""

from __future__ import annotations

import json
import os

import pytest

from textlab.sources.readers import canonical_reviews, read_golden, read_lines, read_reviews_csv, split_quarantine
from textlab.sources.schema import check_contract

CSV = (
    'Rating,Review Title,Review Text,Country\n'
    '"Rated 5 out of 5 stars","Great","Line one\nline two with ""quotes""",US\n'
    'Rated 1 out of 5 stars,only\n'
    'a,b,c,d,e,f\n'
    'Rated 4 out of 5 stars,Nice,Works fine,GB\n'
)


def _write(workdir, name, text):
    path = os.path.join(workdir, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_multiline_and_quarantine(spark, workdir):
    path = _write(workdir, "reviews.csv", CSV)
    raw = read_reviews_csv(spark, path).cache()
    good, bad = split_quarantine(raw)
    g = good.orderBy("Rating").collect()
    assert [r["Review Text"] for r in g] == ['Line one\nline two with "quotes"', "Works fine"][::-1] or \
        sorted(r["Review Text"] for r in g) == sorted(['Line one\nline two with "quotes"', "Works fine"])
    assert bad.count() == 2
    assert all(r["_corrupt_record"] for r in bad.collect())
    canon = canonical_reviews(good)
    assert {"review_id", "rating", "title", "body", "country"} <= set(canon.columns)
    raw.unpersist()


def test_missing_path_raises(spark, workdir):
    with pytest.raises(FileNotFoundError):
        read_reviews_csv(spark, os.path.join(workdir, "nope.csv"))


def test_contract_message_lists_missing_and_present(spark):
    df = spark.createDataFrame([("5", "t")], "Rating string, `Review Title` string")
    with pytest.raises(ValueError) as e:
        check_contract(df, "x.csv")
    msg = str(e.value)
    assert "Review Text" in msg and "Country" in msg and "['Rating', 'Review Title']" in msg


def test_golden_json_and_lines(spark, workdir):
    golden = [
        {"id": 1, "title": "Great", "text": "Love it", "expected_label": 1, "category": "clear_positive"},
        {"id": 2, "title": "", "text": "Broke", "expected_label": 0, "category": "edge_case_no_title"},
    ]
    path = _write(workdir, "golden.json", json.dumps(golden))
    g = read_golden(spark, path).orderBy("id").collect()
    assert [r.category for r in g] == ["clear_positive", "edge_case_no_title"]
    lines = _write(workdir, "lines.txt", "  first review \n\n   \nsecond　\n")
    assert [r.text for r in read_lines(spark, lines).collect()] == ["first review", "second"]


def test_quarantine_sink_and_raw_lines(spark, workdir):
    from textlab.sources.readers import write_quarantine

    path = _write(workdir, "reviews.csv", CSV)
    _, bad = split_quarantine(read_reviews_csv(spark, path))
    out = os.path.join(workdir, "quarantine")
    write_quarantine(bad, out)
    lines = sorted(r[0] for r in spark.read.parquet(out).select("_corrupt_record").collect())
    assert lines == ["Rated 1 out of 5 stars,only", "a,b,c,d,e,f"]


def test_inferred_schema_read(spark, workdir):
    path = _write(workdir, "reviews.csv", 'Rating,Review Title,Review Text,Country\n5,Great,"Nice, really",US\n1,Bad,Broke,DE\n')
    df = read_reviews_csv(spark, path, schema=None)
    assert "_corrupt_record" not in df.columns
    assert dict(df.dtypes)["Rating"] == "int"
    assert sorted(r["Review Text"] for r in df.collect()) == ["Broke", "Nice, really"]


def test_quarantine_count_and_raw_lines_without_caching(spark, workdir):
    path = _write(workdir, "reviews.csv", CSV)
    good, bad = split_quarantine(read_reviews_csv(spark, path))
    assert bad.count() == 2 and good.count() == 2
    assert sorted(r[0] for r in bad.select("_corrupt_record").collect()) == ["Rated 1 out of 5 stars,only", "a,b,c,d,e,f"]
