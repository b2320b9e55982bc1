"""Views derived from the provided tables (``/root/testdata/sf*/``).

``documents`` holds no ratings, titles or tags, so the review-shaped inputs are
derived from it column by column. Every view reads whole tables and whole
texts: title and body together hold the complete document. The title takes the first
40 characters and the body the rest; where the title is NULL or empty the body is
the whole text, and where the body is NULL the title is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.operators.split import with_folds
from textlab.sources.readers import read_table

# --- fixed values of the derived views (shared with the SQL oracles) --------
TITLE_CHARS = 40
SCORE_MULTIPLIER = 7919
SCORE_MODULUS = 200
POSITIVE_PROBABILITY_CUT = 0.5
GOLDEN_SHORT_CHARS = 400
EDGE_REPEATS = 200
# (reg_param, elastic_net, score multiplier) of the given cross-validation scores
GRID_MULTIPLIERS = ((0.01, 0.0, 7919), (0.01, 0.5, 7907), (0.1, 0.0, 7901), (0.1, 0.5, 7883))
# ---------------------------------------------------------------------------


def _rating_text(doc_id: Column) -> Column:
    m = doc_id % F.lit(8)
    return (
        F.when(
            m < F.lit(5),
            F.concat(F.lit("Rated "), (m + F.lit(1)).cast("string"), F.lit(" out of 5 stars")),
        )
        .when(m == F.lit(5), F.lit(None).cast("string"))
        .when(m == F.lit(6), F.lit("no rating"))
        .otherwise(F.lit("Rated 0 out of 5 stars"))
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``review_id, rating, title, body, country`` from ``documents``.

    rating cycles through 'Rated 1..5 out of 5 stars', NULL, 'no rating' and
    'Rated 0 out of 5 stars'; titles are NULL, '' or text in ``<b>`` tags; bodies are
    NULL or the text that is not in the title after a ``<br>``.
    """
    return reviews_from_documents(read_table(spark, sf_dir, "documents"))


def reviews_from_documents(d: DataFrame) -> DataFrame:
    """The review derivation on any documents frame (batch or stream)."""
    doc_id, text = F.col("doc_id"), F.col("text")
    m5 = doc_id % F.lit(5)
    no_body = doc_id % F.lit(11) == F.lit(0)
    title = (
        F.when(no_body, F.concat(F.lit("<b>"), text, F.lit("</b>")))
        .when(m5 == F.lit(0), F.lit(None).cast("string"))
        .when(m5 == F.lit(1), F.lit(""))
        .otherwise(F.concat(F.lit("<b>"), F.substring(text, 1, TITLE_CHARS), F.lit("</b>")))
    )
    body = (
        F.when(no_body, F.lit(None).cast("string"))
        .when(m5 <= F.lit(1), F.concat(F.lit("<br>"), text))
        .otherwise(F.concat(F.lit("<br>"), F.substr(text, F.lit(TITLE_CHARS + 1))))
    )
    return d.select(
        doc_id.alias("review_id"),
        _rating_text(doc_id).alias("rating"),
        title.alias("title"),
        body.alias("body"),
        F.upper(F.col("lang")).alias("country"),
    )


def score_of(doc_id: Column, multiplier: Column | None = None) -> Column:
    """Deterministic positive-class probability with repeats (ties) in [0, 1)."""
    m = F.lit(SCORE_MULTIPLIER) if multiplier is None else multiplier
    return ((doc_id * m) % F.lit(SCORE_MODULUS)).cast("double") / F.lit(float(SCORE_MODULUS))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``review_id, label, score, prediction`` from ``labels`` (label = quality)."""
    return scores_from_labels(read_table(spark, sf_dir, "labels"))


def scores_from_labels(lab: DataFrame) -> DataFrame:
    """The score derivation on any labels frame (batch or stream)."""
    s = score_of(F.col("doc_id"))
    return lab.select(
        F.col("doc_id").alias("review_id"),
        F.col("quality").cast("int").alias("label"),
        s.alias("score"),
        F.when(s > F.lit(POSITIVE_PROBABILITY_CUT), F.lit(1)).otherwise(F.lit(0)).alias("prediction"),
    )


def grid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reg_param, elastic_net, fold, label, score``: every labelled document scored by four
    parameter pairs (label = quality, the fold of its id)."""
    lab = with_folds(read_table(spark, sf_dir, "labels"), "doc_id")
    grid = F.array(
        *[
            F.struct(F.lit(r).alias("reg_param"), F.lit(e).alias("elastic_net"), F.lit(m).cast("bigint").alias("m"))
            for r, e, m in GRID_MULTIPLIERS
        ]
    )
    cells = lab.select("doc_id", "fold", F.col("quality").cast("int").alias("label"), F.inline(grid))
    return cells.select("reg_param", "elastic_net", "fold", "label", score_of(F.col("doc_id"), F.col("m")).alias("score"))


def golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden set from ``documents``: English is the positive class; short texts are edge cases."""
    d = read_table(spark, sf_dir, "documents")
    expected = F.when(F.col("lang") == F.lit("en"), F.lit(1)).otherwise(F.lit(0))
    category = (
        F.when(F.col("n_chars") < F.lit(GOLDEN_SHORT_CHARS), F.lit("edge_case_short"))
        .when(expected == F.lit(1), F.lit("clear_positive"))
        .otherwise(F.lit("clear_negative"))
    )
    return d.select(
        F.col("doc_id").alias("id"),
        F.lit("").alias("title"),
        F.col("text"),
        expected.alias("expected_label"),
        category.alias("category"),
    )


def edge_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, case, title, text``: scoring requests made from every document. Without a title
    (NULL), its opening words 200 times over, texts that are not English, and the mixed batch
    of all documents with their opening words as title."""
    d = read_table(spark, sf_dir, "documents")
    opening = F.substring("text", 1, TITLE_CHARS)
    none = F.lit(None).cast("string")

    def request(case: str, title: Column, text: Column) -> Column:
        return F.struct(F.lit(case).alias("case"), title.alias("title"), text.alias("text"))

    cases = F.array(
        request("missing_title", none, F.col("text")),
        request("repeated_text", F.lit(""), F.repeat(F.concat(opening, F.lit(" ")), F.lit(EDGE_REPEATS))),
        request("mixed_batch", opening, F.col("text")),
        F.when(F.col("lang") != F.lit("en"), request("other_language", F.lit(""), F.col("text"))),
    )
    requests = F.filter(cases, lambda c: c.isNotNull())
    return d.select(F.col("doc_id").alias("id"), F.inline(requests))


def labelled_documents(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    """``documents JOIN labels``: ``review_id, text, lang, label`` (double) for training.

    Both sides grow with the data, so no broadcast is forced; AQE converts the
    join to a broadcast at run time only if the measured labels side is small.
    """
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label"))
    return d.join(lab, "doc_id").select(
        F.col("doc_id").alias("review_id"),
        "text",
        "lang",
        F.col("label").cast("double").alias("label"),
    )


def language_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with ``label = (lang = 'en')``: a cleanly learnable target."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("review_id"),
        "text",
        "lang",
        F.when(F.col("lang") == F.lit("en"), F.lit(1.0)).otherwise(F.lit(0.0)).alias("label"),
    )
