"""Array-valued Column functions: SQL twins of the MLlib text stages.

These give the same arrays as ``Tokenizer``, ``StopWordsRemover`` and ``NGram``
but as plain SQL expressions, so the term-keyed features can be computed with
joins and aggregates (and checked against an SQL oracle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textlab.functions.stopwords import english_stop_words

# --- fixed values -----------------------------------------------------------
# Tokens of the single-machine mirror: two or more word characters.
MIRROR_TOKEN_PATTERN = r"\b\w\w+\b"
NGRAM_SEPARATOR = " "
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ml_tokens(text: Column | str) -> Column:
    """Exact twin of ``pyspark.ml.feature.Tokenizer``.

    Tokenizer lower-cases and applies Java ``String.split("\\s")``, which keeps
    leading and inner empty tokens but drops trailing ones: ``''`` -> ``['']``,
    all-blank -> ``[]``, ``' a  b '`` -> ``['', 'a', '', 'b']``.
    """
    x = F.lower(_col(text))
    return (
        F.when(x == F.lit(""), F.array(F.lit("")))
        .when(~x.rlike(r"\S"), F.array().cast("array<string>"))
        .otherwise(F.split(F.regexp_replace(x, r"\s+$", ""), r"\s"))
    )


def mirror_tokens(text: Column | str) -> Column:
    """Tokens of two or more word characters (the mirror's token rule), lower-cased."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(MIRROR_TOKEN_PATTERN), 0)


def remove_stop_words(tokens: Column | str, keep_negations: bool = False) -> Column:
    """Twin of ``StopWordsRemover`` (case-insensitive, keeps duplicates and '' tokens).

    ``isin`` over more than ten literals is planned as a hash-set lookup (InSet),
    so the cost per token does not grow with the list.
    """
    words = english_stop_words(keep_negations)
    return F.filter(_col(tokens), lambda t: ~F.lower(t).isin(words))


def bigrams(tokens: Column | str) -> Column:
    """Twin of ``NGram(n=2)``: adjacent pairs joined by one space; [] below two tokens."""
    t = _col(tokens)
    n = F.greatest(F.size(t) - F.lit(1), F.lit(0))
    return F.zip_with(
        F.slice(t, F.lit(1), n),
        F.slice(t, F.lit(2), n),
        lambda a, b: F.concat(a, F.lit(NGRAM_SEPARATOR), b),
    )


def unigrams_and_bigrams(tokens: Column | str) -> Column:
    """Tokens followed by their bigrams (an n-gram range of 1..2)."""
    t = _col(tokens)
    return F.concat(t, bigrams(t))
