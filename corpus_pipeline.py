"""From raw documents to encoded training text: five stages over the ``documents`` table.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; between stages the documents are written as Parquet to the shared folder and
read again. All stages but the last return the columns of ``documents``
(``n_chars`` follows the text); the last returns ``doc_id, source, n_tokens, ids``.
A document that the mix repeats stands there as often as it is repeated.

``ORACLE_SQL`` is None: hashed n-gram models, content-defined chunks and merges of
pieces have no SQL; the stages are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.llm import line_dedup, mixing, near_dup, pieces, quality_rules
from textlab.llm.common import drop_scratch, materialise, read, recorded
from textlab.llm.queries import tokenizer_path, trusted

#: Near duplicates of this pipeline: five-word shingles, similarity 0.8 or more.
NEAR = near_dup.NearDup(shingle=5, percent=80, slots=160, trees=32)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    return quality_rules.keep_good(docs, trusted(spark, sf_dir))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated multi-line passages; documents that held nothing else are dropped."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in out.columns:
        kind = dict(out.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(kind))
    return out


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.distinct_documents(docs, NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target sizes; documents repeat as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    out = pieces.encode(docs, pieces.load(tokenizer_path()), ("doc_id", "source"))
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


#: Scratch tables by the number of the stage that made them.
_scratch: dict[int, list[str]] = {}


def _tidy(number: int, stage: Callable[..., DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``stage``, which first drops what the stages before it left: their results are written
    and read again by then. Tables that ``docs`` still reads stay."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for n in [n for n in _scratch if n < number]:
            _scratch[n] = drop_scratch(spark, _scratch[n], docs)
        with recorded() as made:
            out = stage(spark, docs, sf_dir)
        _scratch.setdefault(number, []).extend(made)
        return out

    return run_stage


STAGES = [
    (name, _tidy(number, stage))
    for number, (name, stage) in enumerate(
        [
            ("quality rules", quality),
            ("line dedup", lines),
            ("near dedup", near),
            ("mixing", mix),
            ("sentencepiece", encode),
        ]
    )
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
