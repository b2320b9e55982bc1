"""English stop words.

The list is Spark MLlib's default English list (``StopWordsRemover.
loadDefaultStopWords("english")``, 181 words). It is written out here so the
SQL twins and the DuckDB oracles can inline it without a JVM;
``tests/test_features.py`` checks it still equals the JVM list.
"""

from __future__ import annotations

# --- fixed values: Spark's default English stop words, in Spark's order ------
SPARK_ENGLISH_STOP_WORDS = tuple(
    """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs themselves
what which who whom this that these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while
of at by for with about against between into through during before after above
below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor
not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's
she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split()
)
# ---------------------------------------------------------------------------


def is_negation(word: str) -> bool:
    """Negation words kept by ``keep_negations``: no, nor, not, cannot and any n't form."""
    return word in ("no", "nor", "not", "cannot") or word.endswith("n't")


def english_stop_words(keep_negations: bool = False) -> list[str]:
    """The default list, optionally without negations (so 'not good' keeps its 'not')."""
    words = list(SPARK_ENGLISH_STOP_WORDS)
    if keep_negations:
        words = [w for w in words if not is_negation(w)]
    return words


def sql_string_list(words: list[str] | tuple[str, ...]) -> str:
    """Render words as a SQL list literal body: ``'a', 'b', 'it''s'``."""
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
