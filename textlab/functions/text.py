"""Column functions for rating parsing, labelling, text cleaning and combining.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen and run on the executors. They are used by the batch plans, the
scoring path and the streaming path alike (one definition, no train/serve skew).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textlab.config import LabelConfig

# --- fixed values (must equal the reference's behaviour) -------------------
# Rating: the first ASCII digit anywhere in the string.
RATING_DIGIT_PATTERN = r"(\d)"
# Cleaning: lower-case, tags to a space, anything but a-z / 0-9 / whitespace to a
# space, runs of whitespace to one space, then trim.
TAG_PATTERN = r"<[^>]+>"
# The last two steps together turn every maximal run of characters outside a-z0-9
# into one space, which one pattern does in a single pass:
NON_ALNUM_RUN_PATTERN = r"[^a-z0-9]+"
# Python's str.strip() removes every character for which str.isspace() is true.
# The same set as one regex class (Java and RE2 both read \x{..}):
PY_WHITESPACE_CLASS = (
    r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# Accent folding for multilingual text (lower-case Latin letters and their base letter).
ACCENTED_LETTERS = "àáâãäåāăąçćčďèéêëēėęěìíîïīįñńňòóôõöøōőùúûüūůűųýÿžźżšśş"
FOLDED_LETTERS = "aaaaaaaaacccdeeeeeeeeiiiiiinnnoooooooouuuuuuuuyyzzzsss"
# Display truncation of the demo table.
DISPLAY_MAX_CHARS = 120
ELLIPSIS = "…"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_rating(rating: Column | str, zero_is_null: bool = True) -> Column:
    """First digit of the rating text as int; no digit or NULL gives NULL.

    ``'Rated 4 out of 5 stars'`` -> 4, ``'4.5'`` -> 4, ``'10 out of 10'`` -> 1.
    ``try_cast`` because ``cast('' as int)`` raises under ANSI mode.
    With ``zero_is_null`` a parsed 0 becomes NULL (training pipeline rule).
    """
    n = F.regexp_extract(_col(rating), RATING_DIGIT_PATTERN, 1).try_cast("int")
    return F.nullif(n, F.lit(0)) if zero_is_null else n


def sentiment_label(rating_numeric: Column | str, cfg: LabelConfig = LabelConfig()) -> Column:
    """1 for rating >= positive threshold, else 0 for <= negative threshold, else NULL."""
    r = _col(rating_numeric)
    return (
        F.when(r >= F.lit(cfg.positive_threshold), F.lit(1))
        .when(r <= F.lit(cfg.negative_threshold), F.lit(0))
        .otherwise(F.lit(None).cast("int"))
    )


def clean_text(text: Column | str) -> Column:
    """lower -> strip tags -> non [a-z0-9 whitespace] to space -> collapse -> trim.

    NULL stays NULL. Accented letters become spaces (they split words), exactly
    as the training pipeline does. Replacing non-[a-z0-9\\s] characters by spaces
    and then collapsing whitespace runs leaves single spaces exactly where a
    maximal run of non-[a-z0-9] characters was, so both steps are done by one
    pass of ``[^a-z0-9]+`` -> ' ' (fewer replacements on long texts). ``trim``
    only removes spaces, which is enough because every run is one space by then.
    """
    x = F.lower(_col(text))
    x = F.regexp_replace(x, TAG_PATTERN, " ")
    x = F.regexp_replace(x, NON_ALNUM_RUN_PATTERN, " ")
    return F.trim(x)


def fold_accents(text: Column | str) -> Column:
    """Lower-case and map accented Latin letters to their base letter (é -> e), so
    cleaning keeps 'cafe' instead of splitting 'caf' and ''. Optional pre-clean step."""
    return F.translate(F.lower(_col(text)), ACCENTED_LETTERS, FOLDED_LETTERS)


def combine_exact(title_clean: Column | str, text_clean: Column | str) -> Column:
    """``concat_ws(' ', title, text)``: NULL parts skipped, empty parts kept.

    An empty title therefore yields a leading space, which counts toward the
    length filter and produces an empty first token.
    """
    return F.concat_ws(" ", _col(title_clean), _col(text_clean))


def combine_trimmed(title_clean: Column | str, text_clean: Column | str) -> Column:
    """Mirror variant: NULL is '', the joined result is trimmed (no leading space)."""
    return F.concat_ws(
        " ", F.nullif(_col(title_clean), F.lit("")), F.nullif(_col(text_clean), F.lit(""))
    )


def py_strip(text: Column | str) -> Column:
    """Python ``str.strip()`` semantics (all Unicode whitespace), unlike ``trim``."""
    return F.regexp_replace(
        _col(text), f"^{PY_WHITESPACE_CLASS}+|{PY_WHITESPACE_CLASS}+$", ""
    )


def request_reject_reason(text: Column | str, min_length: int = 5) -> Column:
    """Scoring-request validation: NULL when accepted, else the first failed rule.

    Order matters and follows the request contract: presence, then the raw
    length (before stripping), then blankness after stripping.
    """
    t = _col(text)
    return (
        F.when(t.isNull(), F.lit("missing_text"))
        .when(F.length(t) < F.lit(min_length), F.lit("too_short"))
        .when(py_strip(t) == F.lit(""), F.lit("blank"))
        .otherwise(F.lit(None).cast("string"))
    )


def scoring_text(title: Column | str, text: Column | str) -> Column:
    """Scoring-time combine: strip both parts, skip empty ones, join with one space."""
    return F.concat_ws(
        " ",
        F.nullif(py_strip(F.coalesce(_col(title), F.lit(""))), F.lit("")),
        F.nullif(py_strip(_col(text)), F.lit("")),
    )


def display_text(text: Column | str, max_chars: int = DISPLAY_MAX_CHARS) -> Column:
    """Truncate to ``max_chars`` characters and append an ellipsis when cut."""
    t = _col(text)
    return F.when(
        F.length(t) > F.lit(max_chars),
        F.concat(F.substring(t, 1, max_chars), F.lit(ELLIPSIS)),
    ).otherwise(t)


def percent_text(fraction: Column | str, decimals: int = 1) -> Column:
    """``fraction*100`` as text with ``decimals`` places and a trailing ``%``.

    Rounded with HALF_EVEN first (Python's formatting of exact ties), then
    formatted, so the formatter never has to round.
    """
    pct = F.bround(_col(fraction) * F.lit(100.0), decimals)
    return F.format_string(f"%.{decimals}f%%", pct)
