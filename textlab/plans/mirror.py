"""The single-machine mirror model, re-expressed as a second MLlib pipeline, and
model comparison / term weights.

Mirror: 2+-character word tokens, stop words removed, unigrams + bigrams, an
explicit vocabulary (top 65,536 by count among terms in 2+ documents), IDF,
L2-normalised rows, logistic regression. Two deliberate differences from the
scikit-learn original, both documented in the README: MLlib's IDF has no ``+1``
smoothing term and TF is raw (the exact sublinear / smooth weights exist as the
term-keyed query ``tfidf_l2``). The regularisation is converted from C: sklearn
sums the loss and Spark averages it, so ``regParam = 1 / (C * n_train)`` without
feature standardisation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
)
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.functions.stopwords import english_stop_words
from textlab.functions.tokens import MIRROR_TOKEN_PATTERN, mirror_tokens, remove_stop_words, unigrams_and_bigrams
from textlab.operators import features
from textlab.plans.train import LABEL_COL, TEXT_COL

# --- fixed values ---------------------------------------------------------------
MIRROR_C = 10.0
MIRROR_MAX_ITER = 1000
MIRROR_TOL = 1e-4  # the single-machine solver's default stopping tolerance
MIRROR_VOCAB = 1 << 16
MIRROR_MIN_DF = 2
# ---------------------------------------------------------------------------------


def mirror_pipeline(n_train: int, c: float = MIRROR_C) -> Pipeline:
    reg = 1.0 / (c * max(n_train, 1))
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=TEXT_COL, outputCol="words", pattern=MIRROR_TOKEN_PATTERN, gaps=False, toLowercase=True),
            StopWordsRemover(inputCol="words", outputCol="kept", stopWords=english_stop_words()),
            NGram(n=2, inputCol="kept", outputCol="pairs"),
            SQLTransformer(statement="SELECT *, concat(kept, pairs) AS terms FROM __THIS__"),
            CountVectorizer(inputCol="terms", outputCol="tf", vocabSize=MIRROR_VOCAB, minDF=float(MIRROR_MIN_DF)),
            IDF(inputCol="tf", outputCol="tfidf"),
            Normalizer(inputCol="tfidf", outputCol="features", p=2.0),
            LogisticRegression(
                featuresCol="features", labelCol=LABEL_COL, maxIter=MIRROR_MAX_ITER, regParam=reg,
                elasticNetParam=0.0, standardization=False, family="binomial", tol=MIRROR_TOL,
            ),
        ]
    )


@dataclass
class Counted:
    """The n-grams of cleaned documents, counted once for both mirrors (:func:`count_terms`).

    ``vocab``: ``(term, index, df)`` of the vocabulary, written, and ``terms`` by index; ``rows``: the
    documents with the counts ``tf`` of those terms and ``log_tf`` for their text, written; ``n``: the
    training rows."""

    vocab: DataFrame
    terms: list[str]
    rows: DataFrame
    n: int


def count_terms(docs: DataFrame, train: DataFrame) -> Counted:
    """The vocabulary of ``train`` and the counts of all ``docs``, whose texts are cleaned (a-z, 0-9 and
    spaces only). Every row is a document."""
    text, words = F.col(TEXT_COL), [w.lower() for w in english_stop_words()]
    counts = features.row_term_counts(train, text, True, words).filter(F.col("df") >= F.lit(MIRROR_MIN_DF))
    top = features.top_counts(counts, MIRROR_VOCAB)
    vocab = features.materialized(top.select("term", (F.col("rank") - F.lit(1)).cast("int").alias("index"), "df"))
    terms = vocab.select("index", "term").toArrow().sort_by("index")["term"].to_pylist()  # a model parameter
    rows = features.row_weights(docs, text, terms, None, "counts", pairs=True, stop_words=words)
    return Counted(vocab, terms, features.materialized(rows.drop(TEXT_COL)), train.count())


def after_counts(model: PipelineModel) -> PipelineModel:
    """The stages of :func:`fit_mirror`'s model that follow the counting of terms, for rows with ``tf``."""
    at = next(i for i, s in enumerate(model.stages) if isinstance(s, CountVectorizerModel))
    return PipelineModel(stages=model.stages[at + 1 :])


def fit_mirror(train: DataFrame, counted: Counted | None = None) -> PipelineModel:
    """The pipeline fitted on documents that are cleaned once and written.

    The vocabulary is counted row by row (:func:`features.row_term_counts`; equal counts at the
    cut go by term), the term counts become vectors once, and IDF, rows of unit length and the
    L-BFGS iterations work on those. With ``counted``, ``train`` is the training part of its rows."""
    from textlab.plans.train import right_size

    docs = None if counted else features.materialized(train.select(TEXT_COL, LABEL_COL))
    n = counted.n if counted else docs.count()
    *text_stages, cv, idf, unit, lr = mirror_pipeline(n).getStages()
    if counted:
        # the iterations' sums go in the order of the same files as without ``counted``
        terms, tf = counted.terms, features.materialized(train.select(LABEL_COL, cv.getOutputCol()))
    else:
        tokens = mirror_unigrams(F.col(TEXT_COL))
        counts = features.row_term_counts(docs, tokens, pairs=True).filter(F.col("df") >= F.lit(MIRROR_MIN_DF))
        terms = [r.term for r in features.top_counts(counts, MIRROR_VOCAB).orderBy("rank").collect()]  # a model parameter
        vectors = features.row_weights(docs.select(LABEL_COL, TEXT_COL), tokens, terms, None, "vector", pairs=True)
        tf = features.materialized(vectors.select(LABEL_COL, F.col("vector").alias(cv.getOutputCol())))
    cv_model = CountVectorizerModel.from_vocabulary(terms, inputCol=cv.getInputCol(), outputCol=cv.getOutputCol())
    idf_model = idf.fit(tf)
    feats = unit.transform(idf_model.transform(tf)).select(LABEL_COL, "features")
    return PipelineModel(stages=[*text_stages, cv_model, idf_model, unit, lr.fit(right_size(feats, n))])


TERM_SCHEMA = T.StructType(
    [T.StructField("index", T.IntegerType()), T.StructField("term", T.StringType()), T.StructField("coefficient", T.DoubleType())]
)


def top_terms(spark: SparkSession, model: PipelineModel, k: int = 20) -> DataFrame:
    """The ``k`` most positive and most negative term weights of a vocabulary model.

    Vocabulary and coefficients are model parameters already held by the driver
    (at most ``vocabSize`` entries); the ranking itself runs as a Spark job.
    """
    cv = next(s for s in model.stages if hasattr(s, "vocabulary"))
    lr = model.stages[-1]
    coef = lr.coefficients.toArray().tolist()
    terms = spark.createDataFrame([(i, t, float(coef[i])) for i, t in enumerate(cv.vocabulary)], TERM_SCHEMA)
    pos = terms.orderBy(F.col("coefficient").desc(), "term").limit(k).withColumn("direction", F.lit("positive"))
    neg = terms.orderBy(F.col("coefficient").asc(), "term").limit(k).withColumn("direction", F.lit("negative"))
    both = pos.unionByName(neg)
    w = Window.partitionBy("direction").orderBy(
        F.when(F.col("direction") == F.lit("positive"), -F.col("coefficient")).otherwise(F.col("coefficient")), "term"
    )
    return both.select("direction", F.row_number().over(w).alias("rank"), "term", F.round("coefficient", 6).alias("coefficient"))


def compare_models(summaries: dict[str, DataFrame]) -> DataFrame:
    """Side-by-side metrics of several models (one summary row each) with deltas to the first."""
    names = list(summaries)
    rows = None
    for i, name in enumerate(names):
        r = summaries[name].select(
            F.lit(i).alias("position"), F.lit(name).alias("model"), "accuracy", "precision", "recall", "f1_score", "auc_roc"
        )
        rows = r if rows is None else rows.unionByName(r)
    w = Window.orderBy("position")
    out = rows
    for m in ("accuracy", "f1_score", "auc_roc"):
        out = out.withColumn(f"delta_{m}", F.round(F.col(m) - F.first(m).over(w.rowsBetween(Window.unboundedPreceding, 0)), 4))
    return out


BUCKET_SCHEMA = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("coefficient", T.DoubleType())])


def hashed_top_terms(spark: SparkSession, model: PipelineModel, terms: DataFrame, k: int = 20) -> DataFrame:
    """Term weights of a hashed model: each distinct corpus term (``terms.term``) is
    hashed with the model's own HashingTF, and the bucket's coefficient is attached.

    Terms that collide share their bucket's coefficient (``terms_in_bucket`` says
    how many). The coefficient table has ``numFeatures`` rows (a model parameter),
    so its broadcast is bounded; the terms are a Spark table of any size.
    """
    hashing = next(s for s in model.stages if type(s).__name__ == "HashingTF")
    coef = model.stages[-1].coefficients.toArray().tolist()
    buckets = spark.createDataFrame([(i, float(c)) for i, c in enumerate(coef) if c != 0.0], BUCKET_SCHEMA)
    single = terms.select("term").distinct().select("term", F.array("term").alias("_one"))
    hashed = hashing.copy({hashing.inputCol: "_one", hashing.outputCol: "_h"}).transform(single)
    keyed = hashed.select("term", F.unwrap_udt("_h")["indices"].getItem(0).alias("bucket"))
    per_bucket = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("terms_in_bucket"))
    joined = keyed.join(F.broadcast(buckets), "bucket").join(per_bucket, "bucket")
    pos = joined.orderBy(F.col("coefficient").desc(), "term").limit(k).withColumn("direction", F.lit("positive"))
    neg = joined.orderBy(F.col("coefficient").asc(), "term").limit(k).withColumn("direction", F.lit("negative"))
    both = pos.unionByName(neg)
    w = Window.partitionBy("direction").orderBy(
        F.when(F.col("direction") == F.lit("positive"), -F.col("coefficient")).otherwise(F.col("coefficient")), "term"
    )
    return both.select(
        "direction",
        F.row_number().over(w).alias("rank"),
        "term",
        "bucket",
        "terms_in_bucket",
        F.round("coefficient", 6).alias("coefficient"),
    )


# --- the mirror with its exact features -------------------------------------------
# Sublinear tf, smooth idf and L2 rows, as in the single-machine original, built as
# Spark joins and aggregates and handed to MLlib as sparse vectors.

VECTOR_JSON = T.StructType([T.StructField("v", VectorUDT())])


def mirror_unigrams(text: Column) -> Column:
    """2+-character tokens, stop words removed."""
    return remove_stop_words(mirror_tokens(text))


def mirror_terms(text: Column) -> Column:
    """2+-character tokens, stop words removed, followed by their bigrams."""
    return unigrams_and_bigrams(mirror_unigrams(text))


class ExactMirrorModel:
    """Fitted exact mirror: vocabulary ``(term, index, idf)`` (at most 65,536 rows,
    written) and a ``LogisticRegressionModel`` on the L2-normalised weights."""

    def __init__(self, vocab: DataFrame, size: int, lr_model, id_col: str = "review_id"):
        self.vocab, self.size, self.lr_model, self.id_col = vocab, size, lr_model, id_col

    def features(self, docs: DataFrame) -> DataFrame:
        """``(id, features)`` for documents with ``review_combined``.

        A row whose id is its own becomes a sparse vector where it is; rows that share an id
        are one document, each with its vector (:meth:`_merged`). Documents without
        vocabulary terms, and a NULL id, get the zero vector.
        """
        i = self.id_col
        single, merged = features.rows_by_id(docs.select(i, TEXT_COL), i, features.repeated_ids(docs.select(i), i))
        tokens = F.when(F.col(i).isNotNull(), mirror_unigrams(F.col(TEXT_COL)))
        own = self._weigh(single, tokens).select(i, "features")
        return own if merged is None else own.unionByName(self._merged(merged))

    def _weigh(self, docs: DataFrame, tokens: Column) -> DataFrame:
        rows = self.vocab.orderBy("index").collect()  # at most 65,536
        terms, idf = [r.term for r in rows], [r.idf for r in rows]
        return features.row_weights(docs, tokens, terms, idf, "vector", pairs=True).withColumnRenamed("vector", "features")

    def _merged(self, docs: DataFrame) -> DataFrame:
        """``(id, features)`` of rows that share ids.

        Weights join the broadcast vocabulary; norms are an aggregate joined back;
        each document's (index, weight) pairs (at most vocabulary-size of them)
        become one sparse vector through ``from_json`` with a vector schema, in the
        JVM.
        """
        i = self.id_col
        terms = docs.select(i, mirror_terms(F.col(TEXT_COL)).alias("terms"))
        tf = features.term_frequencies(terms, i, "terms")
        w = tf.join(F.broadcast(self.vocab), "term").select(
            i, "index", ((F.lit(1.0) + F.log(F.col("tf"))) * F.col("idf")).alias("w")
        )
        norms = w.groupBy(i).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
        pairs = (
            w.join(norms, i)
            .groupBy(i)
            .agg(F.array_sort(F.collect_list(F.struct("index", (F.col("w") / F.col("norm")).alias("value")))).alias("p"))
        )
        ids = docs.select(i).join(pairs, i, "left")
        p = F.coalesce(F.col("p"), F.array().cast("array<struct<index:int,value:double>>"))
        vec = F.struct(
            F.lit(0).alias("type"),
            F.lit(self.size).alias("size"),
            F.transform(p, lambda x: x.getField("index")).alias("indices"),
            F.transform(p, lambda x: x.getField("value")).alias("values"),
        )
        return ids.select(i, F.from_json(F.to_json(F.struct(vec.alias("v"))), VECTOR_JSON).getField("v").alias("features"))

    def with_features(self, docs: DataFrame) -> DataFrame:
        """``docs`` joined to their features by id (no partner for a NULL id); where the id is
        the row's own, without a shuffle. Rows of a :class:`Counted` with this model's vocabulary,
        each with an id of its own, are weighed by their counts."""
        i = self.id_col
        if "log_tf" in docs.columns:
            idf = self.vocab.select("index", "idf").toArrow().sort_by("index")["idf"].to_numpy()  # at most 65,536
            scaled = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="log_tf", outputCol="_scaled")
            unit = Normalizer(inputCol="_scaled", outputCol="features", p=2.0)
            own = unit.transform(scaled.transform(docs.filter(F.col(i).isNotNull())))
            return own.select(i, *[c for c in docs.columns if c not in (i, "tf", "log_tf")], "features")
        single, merged = features.rows_by_id(docs, i, features.repeated_ids(docs.select(i), i))
        columns = [i, *[c for c in docs.columns if c != i], "features"]
        own = self._weigh(single.filter(F.col(i).isNotNull()), mirror_unigrams(F.col(TEXT_COL))).select(columns)
        return own if merged is None else own.unionByName(merged.join(self._merged(merged), i).select(columns))

    def transform(self, docs: DataFrame) -> DataFrame:
        """Adds rawPrediction, probability and prediction, keeping the input columns."""
        return self.lr_model.transform(self.with_features(docs))


def mirror_vocabulary(docs: DataFrame, id_col: str = "review_id") -> DataFrame:
    """``(term, index, idf)`` of the documents' vocabulary, written once. ``docs`` is read
    several times: write it first where it is expensive."""
    again = features.repeated_ids(docs.select(id_col), id_col)
    tokens = mirror_unigrams(F.col(TEXT_COL))
    vocab, n = features.fitted_vocabulary(docs.select(id_col, TEXT_COL), id_col, tokens, True, MIRROR_VOCAB, MIRROR_MIN_DF, again)
    index = (F.col("rank") - F.lit(1)).cast("int").alias("index")
    return features.materialized(vocab.select("term", index, smooth_idf(n).alias("idf")))


def smooth_idf(n: int) -> Column:
    """The mirror's idf of a term in ``df`` of ``n`` documents."""
    return F.log((F.lit(1.0) + F.lit(float(n))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)


def fit_exact_mirror(
    train: DataFrame, id_col: str = "review_id", c: float = MIRROR_C, counted: Counted | None = None
) -> ExactMirrorModel:
    """Fit the exact mirror on ``(id, review_combined, label)`` rows. With ``counted``, ``train`` is the
    training part of its rows, each with an id of its own."""
    from textlab.plans.train import right_size

    if counted:
        vocab = features.materialized(counted.vocab.select("term", "index", smooth_idf(counted.n).alias("idf")))
        model = ExactMirrorModel(vocab, len(counted.terms), None, id_col)
        feats, n_rows = model.with_features(train).select(LABEL_COL, "features"), train.filter(F.col(id_col).isNotNull()).count()
    else:
        docs = features.materialized(train.select(id_col, TEXT_COL, LABEL_COL))
        vocab = mirror_vocabulary(docs, id_col)
        model = ExactMirrorModel(vocab, vocab.count(), None, id_col)
        feats = features.materialized(model.with_features(docs).select(LABEL_COL, "features"))
        n_rows = feats.count()
    lr = LogisticRegression(
        featuresCol="features", labelCol=LABEL_COL, maxIter=MIRROR_MAX_ITER, regParam=1.0 / (c * max(n_rows, 1)),
        elasticNetParam=0.0, standardization=False, family="binomial", tol=MIRROR_TOL,
    )
    model.lr_model = lr.fit(right_size(feats, n_rows))
    return model


def exact_top_terms(model: ExactMirrorModel, k: int = 20) -> DataFrame:
    """Strongest term weights of the exact mirror: coefficients (a model parameter of at
    most vocabulary size) joined to the vocabulary by index."""
    spark = model.vocab.sparkSession
    coef = model.lr_model.coefficients.toArray().tolist()
    weights = spark.createDataFrame([(i, float(x)) for i, x in enumerate(coef)], "index int, coefficient double")
    terms = model.vocab.join(weights, "index").select("index", "term", "coefficient")
    pos = terms.orderBy(F.col("coefficient").desc(), "term").limit(k).withColumn("direction", F.lit("positive"))
    neg = terms.orderBy(F.col("coefficient").asc(), "term").limit(k).withColumn("direction", F.lit("negative"))
    w = Window.partitionBy("direction").orderBy(
        F.when(F.col("direction") == F.lit("positive"), -F.col("coefficient")).otherwise(F.col("coefficient")), "term"
    )
    return pos.unionByName(neg).select(
        "direction", F.row_number().over(w).alias("rank"), "term", F.round("coefficient", 6).alias("coefficient")
    )
