"""Accent folding by the Unicode compatibility decomposition, as a Column expression.

``fold_unicode`` equals ``unicodedata.normalize("NFKD", text)`` with combining characters
removed. Spark has no normalisation function, so the tables are made here by that rule, from
Python's Unicode data: marks are removed whole, hence their canonical order plays no part and
every character can be replaced on its own.

Three kinds of characters change. Those that become one character, and those that vanish,
go through one ``translate``. Those that become several (ligatures, fractions, Hangul
syllables, whose parts follow from the code point) are replaced first, character by
character, and only in texts that hold one. Texts of ASCII only are returned as they are.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: Hangul syllables (the Unicode standard's arithmetic) ----------
SYLLABLES = range(0xAC00, 0xD7A4)
LEADS = "".join(map(chr, range(0x1100, 0x1113)))
VOWELS = "".join(map(chr, range(0x1161, 0x1176)))
TAILS = "".join(map(chr, range(0x11A8, 0x11C3)))
# ----------------------------------------------------------------------------------
SURROGATES = range(0xD800, 0xE000)


def fold_char(c: str) -> str:
    """The rule: compatibility decomposition without combining characters."""
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


@cache
def _tables() -> tuple[str, str, dict[str, str]]:
    """(characters that become one or none, their replacements, characters that become several).

    Vanishing characters stand last in the first string, as ``translate`` wants them.
    """
    single, gone, several = {}, [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if cp in SURROGATES or cp in SYLLABLES:
            continue
        c = chr(cp)
        to = fold_char(c)
        if to == "":
            gone.append(c)
        elif to != c and len(to) == 1:
            single[c] = to
        elif to != c:
            several[c] = to
    return "".join(single) + "".join(gone), "".join(single.values()), several


def _class(points: list[int]) -> str:
    """A regex class of sorted code points, runs written as ranges."""
    runs: list[list[int]] = []
    for cp in points:
        if runs and runs[-1][1] == cp - 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]"


def _syllable(c: Column) -> Column:
    s = F.ascii(c) - F.lit(SYLLABLES.start)  # ascii() gives the code point
    per_lead, per_vowel = len(VOWELS) * (len(TAILS) + 1), len(TAILS) + 1

    def part(letters: str, at: Column) -> Column:
        return F.substr(F.lit(letters), at.cast("int"), F.lit(1))

    tail = s % F.lit(per_vowel)
    return F.concat(
        part(LEADS, F.floor(s / F.lit(per_lead)) + F.lit(1)),
        part(VOWELS, F.floor((s % F.lit(per_lead)) / F.lit(per_vowel)) + F.lit(1)),
        F.when(tail == F.lit(0), F.lit("")).otherwise(part(TAILS, tail)),
    )


def fold_unicode(text: Column | str) -> Column:
    """``text`` in NFKD without combining characters; NULL stays NULL."""
    t = F.col(text) if isinstance(text, str) else text
    one_from, one_to, several = _tables()
    syllables = _class([SYLLABLES.start, *SYLLABLES[1:]])
    holds_several = _class(sorted([*map(ord, several), *SYLLABLES]))
    pairs = F.create_map(*[F.lit(x) for kv in several.items() for x in kv])

    def expand(c: Column) -> Column:
        return (
            F.when(~c.rlike(holds_several), c).when(c.rlike(syllables), _syllable(c)).otherwise(F.try_element_at(pairs, c))
        )

    chars = F.regexp_extract_all(t, F.lit("(?s)."), F.lit(0))
    spelled = F.when(t.rlike(holds_several), F.array_join(F.transform(chars, expand), "")).otherwise(t)
    return F.when(t.rlike(r"[^\x{0}-\x{7f}]"), F.translate(spelled, one_from, one_to)).otherwise(t)
