"""Registered queries: tokens, stop words, n-grams, term-keyed and hashed TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.config import LabelConfig
from textlab.functions.text import clean_text, fold_accents
from textlab.functions.tokens import (
    ml_tokens,
    mirror_tokens,
    remove_stop_words,
    unigrams_and_bigrams,
)
from textlab.functions.unicode_fold import fold_unicode
from textlab.operators import features
from textlab.plans.catalog import register
from textlab.plans.transform import clean_reviews
from textlab.sources import views

MIRROR = LabelConfig(zero_is_null=False)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_reviews(views.reviews(spark, sf_dir))


def _filtered_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).select(
        "review_id", remove_stop_words(ml_tokens(F.col("review_combined"))).alias("terms")
    )


def _mirror_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mirror's documents, cleaned once: trimmed combine, its own filter, 2+-character
    tokens, stop words removed."""
    docs = clean_reviews(views.reviews(spark, sf_dir), MIRROR, trimmed=True).select("review_id", "review_combined")
    toks = remove_stop_words(mirror_tokens(F.col("review_combined")))
    return features.materialized(docs).select("review_id", toks.alias("terms"))


@register("tokens")
def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenizer twin on the clean texts (leading '' tokens kept, trailing dropped)."""
    t = ml_tokens(F.col("review_combined"))
    return _clean(spark, sf_dir).select(
        "review_id", F.size(t).alias("n_tokens"), F.array_join(t, "|").alias("tokens_text")
    )


@register("stopword_filter")
def q_stopword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default English stop words removed (duplicates and '' tokens kept)."""
    t = F.col("terms")
    return _filtered_tokens(spark, sf_dir).select(
        "review_id", F.size(t).alias("n_tokens"), F.array_join(t, "|").alias("tokens_text")
    )


@register("bigrams")
def q_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigrams followed by bigrams of the stop-word-filtered tokens."""
    g = unigrams_and_bigrams(F.col("terms"))
    return _filtered_tokens(spark, sf_dir).select(
        "review_id", F.size(g).alias("n_grams"), F.array_join(g, "|").alias("grams_text")
    )


@register("tfidf_terms")
def q_tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact term-keyed TF-IDF with MLlib's IDF (minDocFreq 2)."""
    return features.tfidf_terms(_filtered_tokens(spark, sf_dir), "review_id", "terms")


@register("vocab_topk")
def q_vocab_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 65,536 terms by corpus count among terms in 2+ documents."""
    tf = features.term_frequencies(_filtered_tokens(spark, sf_dir), "review_id", "terms")
    return features.vocabulary(tf)


@register("tfidf_l2")
def q_tfidf_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mirror features: 1-2 grams, capped vocabulary, sublinear tf, smooth IDF, L2."""
    return features.tfidf_sublinear_l2(_mirror_tokens(spark, sf_dir), "review_id", "terms", pairs=True)


@register("clean_folded")
def q_clean_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accent folding before cleaning, so accented words survive as words."""
    d = views.reviews(spark, sf_dir)
    return d.select("review_id", clean_text(fold_accents(F.col("body"))).alias("text_clean"))


@register("clean_unicode")
def q_clean_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-case, full compatibility decomposition without marks, then cleaning."""
    folded = fold_unicode(F.lower(F.col("body")))
    return views.reviews(spark, sf_dir).select("review_id", clean_text(folded).alias("text_clean"))


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean reviews with HashingTF (2^16 buckets) and IDF (minDocFreq 2) vectors, fitted on them."""
    from pyspark.ml import Pipeline

    from textlab.plans.train import featurizer_stages, idf_stage

    docs = _clean(spark, sf_dir)
    return Pipeline(stages=[*featurizer_stages(), idf_stage()]).fit(docs).transform(docs)


@register("hashed_features")
def q_hashed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 + D4 + D11: per document the number of non-zero buckets and the sum of weights,
    read from the sparse vector's own entries."""
    v = F.unwrap_udt("features")
    return _hashed(spark, sf_dir).select(
        "review_id",
        F.size(v["indices"]).alias("n_buckets"),
        F.round(F.aggregate(v["values"], F.lit(0.0), lambda acc, x: acc + x), 6).alias("weight_sum"),
    )


@register("hashed_buckets")
def q_hashed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 + D4: every document's buckets with their counts and IDF weights."""
    tf, weights = F.unwrap_udt("raw_features"), F.unwrap_udt("features")
    entries = F.arrays_zip(
        tf["indices"].alias("bucket"), tf["values"].alias("count"), weights["values"].alias("w")
    )
    return _hashed(spark, sf_dir).select("review_id", F.inline(entries)).select(
        "review_id", "bucket", F.col("count").cast("bigint").alias("tf"), F.round("w", 6).alias("weight")
    )
