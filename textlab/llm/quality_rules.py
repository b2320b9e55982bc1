"""Operator 4: base rules and a hashed n-gram log-likelihood ratio, DataFrame functions only.

Two multinomials over ``buckets`` hash buckets of word unigrams and bigrams are
estimated: one from the trusted documents (given by id), one from the whole raw
corpus. A document's score is the mean over its n-grams of
``log p_trusted - log p_raw``; it passes at ``threshold`` or above. Nothing is
sampled: equal inputs get equal verdicts at every run.

Defined cases: a NULL or blank text has zero counts, fails the base rules
(fewer than ``min_words`` words) and scores 0. Repeated rows are judged
one by one. Without trusted documents both models are the raw one and only the
base rules decide. Empty input gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.common import let, words

GAP = r"[\x20\x09-\x0D]"
NOT_SYMBOLS = r"[^#*$%&|<>]+"


@dataclass(frozen=True)
class QualityRules:
    """``buckets`` bounds the model's size; ``threshold`` is in nats per n-gram."""

    buckets: int = 1 << 14
    smoothing: float = 1.0
    threshold: float = -0.1
    min_words: int = 50
    max_repeat_percent: int = 50


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def ngram_buckets(hashes: Column, buckets: int) -> Column:
    """Bucket numbers of all unigrams and bigrams; the last word's bigram ends the text."""
    n = F.lit(buckets).cast("long")

    def both(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.lit(2)))
        return F.transform(F.concat(h, pairs), lambda x: F.pmod(x, n).cast("int"))

    return let(hashes, both)


def repeated_words(hashes: Column) -> Column:
    """Words inside any three-word window that occurs twice or more in the text."""

    def windows(h: Column) -> Column:
        # the last two windows are short; each of them occurs once
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))

    def covered(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        repeated = let(
            ordered,
            lambda s: F.filter(
                s,
                lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False))
                | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)),
            ),
        )
        starts = F.sort_array(F.transform(repeated, lambda e: e["i"]))
        return F.aggregate(
            starts,
            F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, p: F.struct(
                p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    return let(
        let(hashes, windows),
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(
            covered(w)
        ),
    )


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long")


def model_weights(docs: DataFrame, trusted: DataFrame, cfg: QualityRules) -> DataFrame:
    """One row, one array: ``log p_trusted - log p_raw`` of each bucket.

    ``trusted`` holds the ``doc_id`` of trusted documents. The text moves once, to
    meet the flags; counts are pre-aggregated in the map tasks, so the second
    exchange has at most ``buckets`` rows a task.
    """
    flags = (
        trusted.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
        .withColumn("_t", F.lit(1).cast("long"))
    )
    counted = (
        docs.select("doc_id", "text")
        .join(flags.hint("shuffle_hash"), "doc_id", "left")
        .select(F.col("_t"), F.explode(ngram_buckets(word_hashes(F.col("text")), cfg.buckets)).alias("_b"))
        .groupBy("_b")
        .agg(F.count(F.lit(1)).alias("_raw"), F.sum(F.coalesce("_t", F.lit(0))).alias("_ok"))
    )
    spark = docs.sparkSession
    every = spark.range(0, cfg.buckets, 1, 1).select(F.col("id").cast("int").alias("_b"))
    # at most `buckets` rows meet in the one task that makes the array
    table = every.join(counted, "_b", "left").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "_b", F.coalesce("_raw", F.lit(0)).alias("r"), F.coalesce("_ok", F.lit(0)).alias("t")
                )
            )
        ).alias("_c"),
        F.coalesce(F.sum("_raw"), F.lit(0)).cast("double").alias("_nr"),
        F.coalesce(F.sum("_ok"), F.lit(0)).cast("double").alias("_nt"),
    )
    a, spread = F.lit(cfg.smoothing), F.lit(cfg.smoothing * cfg.buckets)
    ratio = F.transform(
        "_c",
        lambda c: F.log((c["t"] + a) / (F.col("_nt") + spread)) - F.log((c["r"] + a) / (F.col("_nr") + spread)),
    )
    none = F.transform("_c", lambda c: F.lit(0.0))
    return table.select(F.when(F.col("_nt") > 0, ratio).otherwise(none).alias("w"))


def fitted(weights: DataFrame) -> Column:
    """The weights as a constant: ``buckets`` numbers pass the driver, however large the corpus."""
    w = weights.first()["w"]
    return F.split(F.lit(",".join(f"{x:.7g}" for x in w)), ",").cast("array<double>")


def judge(docs: DataFrame, trusted: DataFrame, cfg: QualityRules = QualityRules()) -> DataFrame:
    """``doc_id``, the counts, ``llr``, ``base_failed`` and ``kept`` of every document."""
    weights = fitted(model_weights(docs, trusted, cfg))
    return _with_verdict(docs.select("doc_id", "text"), weights, cfg).drop("text")


def keep_good(docs: DataFrame, trusted: DataFrame, cfg: QualityRules = QualityRules()) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    weights = fitted(model_weights(docs, trusted, cfg))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text")
    return _with_verdict(row, weights, cfg).filter("kept").select("_row.*")


def _with_verdict(df: DataFrame, weights: Column, cfg: QualityRules) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = df.withColumn("_h", word_hashes(text)).select(
        *df.columns,
        F.size("_h").cast("long").alias("n_words"),
        (F.length(text) + 1 - F.size(F.split(text, GAP))).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        _repeated_lines(text).alias("n_dup_lines"),
        repeated_words(F.col("_h")).alias("n_repeat_words"),
        F.transform(
            F.array(weights),
            lambda w: F.aggregate(
                ngram_buckets(F.col("_h"), cfg.buckets), F.lit(0.0), lambda acc, b: acc + F.get(w, b)
            ),
        )[0].alias("_sum"),
    )
    ngrams = F.greatest(2 * F.col("n_words"), F.lit(1))
    failed = (F.col("n_words") < cfg.min_words) | (
        100 * F.col("n_repeat_words") > cfg.max_repeat_percent * F.col("n_words")
    )
    return (
        counted.withColumn("llr", F.col("_sum") / ngrams)
        .drop("_sum")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= cfg.threshold))
    )
