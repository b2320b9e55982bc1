"""Column functions (JVM-side built-ins only; no Python UDFs)."""

from textlab.functions.stopwords import english_stop_words
from textlab.functions.text import (
    clean_text,
    combine_exact,
    combine_trimmed,
    display_text,
    parse_rating,
    percent_text,
    py_strip,
    request_reject_reason,
    scoring_text,
    sentiment_label,
)
from textlab.functions.tokens import (
    bigrams,
    ml_tokens,
    mirror_tokens,
    remove_stop_words,
    unigrams_and_bigrams,
)

__all__ = [
    "bigrams",
    "clean_text",
    "combine_exact",
    "combine_trimmed",
    "display_text",
    "english_stop_words",
    "ml_tokens",
    "mirror_tokens",
    "parse_rating",
    "percent_text",
    "py_strip",
    "remove_stop_words",
    "request_reject_reason",
    "scoring_text",
    "sentiment_label",
    "unigrams_and_bigrams",
]
