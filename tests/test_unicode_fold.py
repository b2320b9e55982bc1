"""Accent folding against Python's own normalisation, for every code point and every document."""

from __future__ import annotations

import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from textlab.functions.unicode_fold import SURROGATES, fold_unicode
from textlab.sources.readers import read_table


def whole(text):
    """The rule on the whole text at once."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def folded(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.f for r in df.select("i", fold_unicode("t").alias("f")).orderBy("i").collect()]


def test_every_code_point(spark):
    points = [chr(c) for c in range(sys.maxunicode + 1) if c not in SURROGATES]
    texts = ["".join(points[i : i + 512]) for i in range(0, len(points), 512)]
    bad = [t[:1] for t, f in zip(texts, folded(spark, texts), strict=True) if f != whole(t)]
    assert bad == []


@pytest.mark.parametrize(
    "text,want",
    [
        ("Łódź", "Łodz"), ("đường", "đuong"), ("ø", "ø"), ("café", "cafe"), ("ﬁn ½ Å", "fin 1⁄2 A"),
        ("한글", "한글"), ("가", "가"), ("𝐀𝓫", "Ab"), ("ạ̇", "a"),
        ("", ""), ("́", ""), ("plain <b>", "plain <b>"), ("ﬀ\nﬀ", "ff\nff"), (None, None),
    ],
)
def test_cases(spark, text, want):
    assert folded(spark, [text]) == [want]
    if text is not None:
        assert whole(text) == want


def test_every_document(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("text", fold_unicode(F.col("text")).alias("f"))
    rows = docs.collect()
    assert rows and all(r.f == (None if r.text is None else whole(r.text)) for r in rows)
