"""Token twins, stop words, n-grams and term-keyed TF-IDF against MLlib."""

from __future__ import annotations

import math

from pyspark.ml.feature import IDF, CountVectorizer, NGram, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.functions.stopwords import SPARK_ENGLISH_STOP_WORDS, english_stop_words
from textlab.functions.tokens import bigrams, ml_tokens, remove_stop_words
from textlab.operators import features
from textlab.plans.transform import clean_reviews
from textlab.sources import views

from .conftest import SF_SMALL


def test_stop_list_equals_spark_default(spark):
    assert list(SPARK_ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    kept = english_stop_words(keep_negations=True)
    assert "not" not in kept and "no" not in kept and "isn't" not in kept and "the" in kept


def test_token_edge_cases(spark):
    rows = [(" a  b ",), ("",), ("   ",), ("a b  ",), (" the cat isn t not good",)]
    df = spark.createDataFrame(rows, "x string")
    out = df.select(ml_tokens(F.col("x")).alias("t")).select("t", remove_stop_words(F.col("t")).alias("f")).collect()
    assert out[0]["t"] == ["", "a", "", "b"]
    assert out[1]["t"] == [""]
    assert out[2]["t"] == []
    assert out[3]["t"] == ["a", "b"]
    assert out[4]["f"] == ["", "cat", "isn", "good"]


def test_twins_equal_mllib_on_whole_documents(spark):
    docs = clean_reviews(views.reviews(spark, SF_SMALL)).select("review_id", "review_combined")
    ml = Tokenizer(inputCol="review_combined", outputCol="t_ml").transform(docs)
    ml = StopWordsRemover(inputCol="t_ml", outputCol="f_ml").transform(ml)
    ml = NGram(n=2, inputCol="f_ml", outputCol="g_ml").transform(ml)
    twin = ml.select(
        "*",
        ml_tokens(F.col("review_combined")).alias("t"),
    ).select("*", remove_stop_words(F.col("t")).alias("f")).select("*", bigrams(F.col("f")).alias("g"))
    bad = twin.filter((F.col("t") != F.col("t_ml")) | (F.col("f") != F.col("f_ml")) | (F.col("g") != F.col("g_ml")))
    assert docs.count() > 50
    assert bad.count() == 0


def test_tfidf_small_example(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["a", "c", "c"])], "id long, terms array<string>")
    got = {(r.id, r.term): (r.tf, r.df, r.idf, r.weight) for r in features.tfidf_terms(docs, "id", "terms", 1).collect()}
    assert got[(1, "a")][2] == 0.0
    assert math.isclose(got[(1, "b")][2], round(math.log(4 / 2), 6))
    assert math.isclose(got[(3, "c")][3], round(2 * math.log(4 / 2), 6))
    strict = {(r.id, r.term): r.weight for r in features.tfidf_terms(docs, "id", "terms", 2).collect()}
    assert strict[(1, "b")] == 0.0 and strict[(3, "c")] == 0.0


def test_term_keyed_tfidf_equals_countvectorizer_idf(spark):
    """D5 equals MLlib CountVectorizer + IDF(minDocFreq=2) weight for weight (no hashing)."""
    docs = clean_reviews(views.reviews(spark, SF_SMALL)).select(
        "review_id", remove_stop_words(ml_tokens(F.col("review_combined"))).alias("terms")
    )
    cv = CountVectorizer(inputCol="terms", outputCol="tf", vocabSize=1 << 20, minDF=1.0).fit(docs)
    vec = IDF(inputCol="tf", outputCol="w", minDocFreq=2).fit(cv.transform(docs)).transform(cv.transform(docs))
    vocab = cv.vocabulary
    ml = {}
    for r in vec.select("review_id", "w").collect():
        for i, v in zip(r.w.indices, r.w.values):
            ml[(r.review_id, vocab[i])] = v
    ours = {(r.review_id, r.term): r.weight for r in features.tfidf_terms(docs, "review_id", "terms").collect()}
    assert set(ml) <= set(ours)
    assert all(ours[k] == 0.0 for k in set(ours) - set(ml))
    assert all(abs(ours[k] - round(v, 6)) < 1e-6 for k, v in ml.items())


def test_vocabulary_ties_and_cap(spark):
    docs = spark.createDataFrame(
        [(1, ["x", "y", "z"]), (2, ["x", "y", "z", "w"]), (3, ["w", "q"])], "id long, terms array<string>"
    )
    tf = features.term_frequencies(docs, "id", "terms")
    v = features.vocabulary(tf, size=2, min_df=2).collect()
    assert [(r["rank"], r.term) for r in v] == [(1, "w"), (2, "x")]


def test_sublinear_l2_rows_have_unit_norm(spark):
    docs = spark.createDataFrame(
        [(1, ["a", "a", "b"]), (2, ["a", "b", "b", "b"]), (3, ["a", "c"])], "id long, terms array<string>"
    )
    out = features.tfidf_sublinear_l2(docs, "id", "terms", min_df=2)
    norms = out.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n")).collect()
    assert all(abs(r.n - 1.0) < 1e-5 for r in norms)
    w = {(r.id, r.term): r.weight for r in out.collect()}
    # doc 1: a (tf 2, df 3), b (tf 1, df 2); N = 3
    ia, ib = math.log(4 / 4) + 1, math.log(4 / 3) + 1
    wa, wb = (1 + math.log(2)) * ia, 1 * ib
    assert abs(w[(1, "a")] - wa / math.hypot(wa, wb)) < 1e-6


def test_tfidf_independent_of_partitioning(spark):
    docs = clean_reviews(views.reviews(spark, SF_SMALL)).select(
        "review_id", remove_stop_words(ml_tokens(F.col("review_combined"))).alias("terms")
    )
    a = features.tfidf_terms(docs, "review_id", "terms")
    b = features.tfidf_terms(docs.repartition(7), "review_id", "terms")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_vocabulary_threshold_prune_matches_full_sort(spark):
    """The count-threshold pruning gives exactly the plain sort-and-limit result, ties included."""
    docs = clean_reviews(views.reviews(spark, SF_SMALL)).select(
        "review_id", remove_stop_words(ml_tokens(F.col("review_combined"))).alias("terms")
    )
    tf = features.term_frequencies(docs, "review_id", "terms")
    full = (
        features.document_frequencies(tf).filter(F.col("df") >= 2)
        .orderBy(F.col("cf").desc(), F.col("term").asc()).collect()
    )
    for size in (1, 7, 50, 333, 10**6):
        got = [(r.term, r.cf) for r in features.vocabulary(tf, size=size).orderBy("rank").collect()]
        assert got == [(r.term, r.cf) for r in full[:size]], size


def test_mirror_weights_shuffle_no_pairs_and_merge_repeated_ids(spark):
    import math
    from collections import Counter

    from textlab.operators import features as fe

    rows = [(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, []), (4, None), (5, ["c", "a", "b"])]
    again = [(6, ["a", "b"]), (6, ["b", "a", "c"]), (None, ["a"]), (None, ["c", "c"])]
    for data in (rows, [*rows, (None, ["b"])], rows + again):
        docs = spark.createDataFrame(data, "id long, terms array<string>").repartition(3)
        out = fe.tfidf_sublinear_l2(docs, "id", "terms", min_df=2, pairs=True)
        merged = {}
        for i, t in data:
            t = t or []
            merged.setdefault(i, Counter()).update(t + [f"{x} {y}" for x, y in zip(t, t[1:])])
        df = Counter(t for c in merged.values() for t in c)
        want = {}
        for i, c in merged.items():
            w = {t: (1 + math.log(k)) * (math.log((1 + len(merged)) / (1 + df[t])) + 1) for t, k in c.items() if df[t] >= 2}
            norm = math.sqrt(sum(x * x for x in w.values()))
            want |= {(i, t): x / norm for t, x in w.items() if i is not None}
        got = {(r.id, r.term): r.weight for r in out.collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)
        if data is not rows + again and len({i for i, _ in data}) == len(data):
            assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()


def test_rows_are_counted_in_slices(spark, monkeypatch):
    import pyarrow as pa

    from textlab.operators import features as fe

    monkeypatch.setattr(fe, "SLICE_TOKENS", 4)
    lists = pa.array([["a", "b"], None, [], ["c"] * 9, ["a"], ["b", "a"]], pa.list_(pa.string()))
    cuts = fe._row_slices(lists)
    assert cuts[0][0] == 0 and cuts[-1][1] == len(lists) and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert fe._row_slices(lists.slice(3)) == [(0, 1), (1, 2), (2, 3)]
    row, code, names = fe._coded(lists.slice(3), True)
    spelled = sorted((int(r), names[int(c)].as_py()) for r, c in zip(row, code))
    assert spelled == sorted([(0, "c")] * 9 + [(0, "c c")] * 8 + [(1, "a"), (2, "b"), (2, "a"), (2, "b a")])
