"""The exact mirror as a table of terms: scoring with it, and a form to keep it in.

A document's margin is ``sum(w * coefficient) / sqrt(sum(w * w)) + intercept`` over its
vocabulary terms, ``w = (1 + ln tf) * idf``. The vocabulary has at most 65,536 rows and goes
to every task; a row's terms are counted, looked up and summed where the row is, in batches,
so nothing is shuffled however long or often repeated the texts are.

Every row is scored on its own, copies and NULL ids included. Texts that are NULL, empty or
without vocabulary terms get the intercept. Other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.operators.features import row_weights
from textlab.operators.score import SENTIMENT_NEGATIVE, SENTIMENT_POSITIVE
from textlab.plans.mirror import ExactMirrorModel, mirror_unigrams
from textlab.plans.train import TEXT_COL

TERMS_SCHEMA = "term string, idf double, coefficient double"
PARAMS_SCHEMA = "intercept double, terms long"


@dataclass(frozen=True)
class TermModel:
    """``terms(term, idf, coefficient)``, at most 65,536 rows, and the intercept."""

    terms: DataFrame
    intercept: float

    def score(self, docs: DataFrame, id_col: str = "review_id", text: str = TEXT_COL) -> DataFrame:
        """``(id, prediction, score)``, one row for every input row; ``score`` = P(positive)."""
        rows = self.terms.filter(F.col("idf").isNotNull()).select("term", "idf", "coefficient").collect()  # at most 65,536
        tokens = mirror_unigrams(F.col(text))
        weighed = row_weights(
            docs.select(F.col(id_col), tokens.alias("_own")), F.col("_own"), [r.term for r in rows], [r.idf for r in rows],
            "dot", pairs=True, coefficients=[0.0 if r.coefficient is None else r.coefficient for r in rows],
        )
        margin = F.col("dot") + F.lit(float(self.intercept))
        return weighed.select(
            id_col,
            F.when(margin > F.lit(0.0), F.lit(1)).otherwise(F.lit(0)).alias("prediction"),
            (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias("score"),
        )

    def save(self, path: str) -> None:
        """Terms, then parameters, each with overwrite: a model counts as saved once both are there,
        and a reload checks that its terms are as many as the parameters say."""
        self.terms.select("term", "idf", "coefficient").write.mode("overwrite").parquet(f"{path}/terms")
        spark = self.terms.sparkSession
        n = spark.read.schema(TERMS_SCHEMA).parquet(f"{path}/terms").count()
        spark.createDataFrame([(float(self.intercept), n)], PARAMS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            f"{path}/params"
        )


def load_term_model(spark: SparkSession, path: str) -> TermModel:
    """A saved model; a missing or half-written one raises ``FileNotFoundError``."""
    try:
        params = spark.read.schema(PARAMS_SCHEMA).parquet(f"{path}/params").first()
        terms = spark.read.schema(TERMS_SCHEMA).parquet(f"{path}/terms")
        n = terms.count()
    except AnalysisException as err:
        raise FileNotFoundError(f"no term model at {path}: save one first (TermModel.save)") from err
    if params is None or params.terms != n:
        raise FileNotFoundError(f"the term model at {path} is not whole: save it again")
    return TermModel(terms, params.intercept)


def from_mirror(model: ExactMirrorModel) -> TermModel:
    """The fitted exact mirror as a table (coefficients are at most vocabulary size)."""
    spark = model.vocab.sparkSession
    weights = [(i, float(c)) for i, c in enumerate(model.lr_model.coefficients.toArray())]
    coef = spark.createDataFrame(weights, "index int, coefficient double")
    terms = model.vocab.join(coef, "index").select("term", "idf", "coefficient")
    return TermModel(terms, float(model.lr_model.intercept))


def shape_probabilities(scored: DataFrame, id_col: str = "review_id") -> DataFrame:
    """The mirror's response: sentiment, label, both probabilities rounded to 4 places on their
    own (so they may miss 1 by a last digit), and the chosen one as confidence."""
    label = F.col("prediction")
    pos, neg = F.round("score", 4), F.round(F.lit(1.0) - F.col("score"), 4)
    return scored.select(
        id_col,
        F.when(label == F.lit(1), F.lit(SENTIMENT_POSITIVE)).otherwise(F.lit(SENTIMENT_NEGATIVE)).alias("sentiment"),
        label.alias("label"),
        F.when(label == F.lit(1), pos).otherwise(neg).alias("confidence"),
        pos.alias("prob_positive"),
        neg.alias("prob_negative"),
    )
