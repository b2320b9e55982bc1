"""Property tests: batches of random strings through the Column functions, compared with
plain-Python models of the same semantics (Java regex classes are ASCII)."""

from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from textlab.functions.text import clean_text, parse_rating, py_strip, request_reject_reason
from textlab.functions.tokens import ml_tokens

JAVA_WS = " \t\n\x0b\x0c\r"
ALPHABET = st.sampled_from(list("abcXYZ019 \t\n\r<>/-.,!'\"é") + [" ", "　", "Ü"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=60)


def model_clean(s):
    if s is None:
        return None
    x = s.lower()
    x = re.sub(r"<[^>]+>", " ", x)
    x = re.sub(r"[^a-z0-9" + re.escape(JAVA_WS) + "]", " ", x)
    x = re.sub("[" + re.escape(JAVA_WS) + "]+", " ", x)
    return x.strip(" ")


def model_rating(s):
    if s is None:
        return None
    m = re.search(r"[0-9]", s)
    if not m:
        return None
    n = int(m.group(0))
    return None if n == 0 else n


def model_reason(s):
    if s is None:
        return "missing_text"
    if len(s) < 5:
        return "too_short"
    if not s.strip():
        return "blank"
    return None


def _frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")


@settings(max_examples=6, deadline=None)
@given(TEXTS)
def test_clean_rating_strip_match_models(spark, texts):
    rows = _frame(spark, texts).select(
        "i",
        clean_text(F.col("x")).alias("c"),
        parse_rating(F.col("x")).alias("r"),
        py_strip(F.col("x")).alias("s"),
        request_reject_reason(F.col("x")).alias("why"),
    ).orderBy("i").collect()
    for t, row in zip(texts, rows):
        assert row.c == model_clean(t), t
        assert row.r == model_rating(t), t
        assert row.s == t.strip(), t
        assert row.why == model_reason(t), t


@settings(max_examples=6, deadline=None)
@given(TEXTS)
def test_token_twin_matches_tokenizer(spark, texts):
    df = _frame(spark, texts)
    out = Tokenizer(inputCol="x", outputCol="ml").transform(df).select("i", "ml", ml_tokens(F.col("x")).alias("twin"))
    for row in out.collect():
        assert row.ml == row.twin, texts[row.i]
