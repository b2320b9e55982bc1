"""Lattices as relations: bounded substrings of words, joined to a table of pieces.

``edges`` explodes the substrings of each word, equi-joins them to the pieces and
groups what matches by word; ``viterbi`` and ``merges`` fold a word's edges with
``aggregate``. Both the substring table and the edges stay partitioned by word,
so the grouping needs no exchange of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.common import let


def _spans(words: DataFrame, starts: Column, lens: Column) -> DataFrame:
    """The substrings of words, by arrays of their starts and, by ``_start``, their lengths."""
    begun = words.select("word", F.explode(starts).alias("_start"))
    return begun.select("word", "_start", F.explode(lens).alias("_len")).select(
        "word", "_start", "_len", F.substring("word", F.col("_start"), F.col("_len")).alias("_span")
    )


def edges(words: DataFrame, pieces: DataFrame, max_len: int, more: tuple[str, ...] = ()) -> DataFrame:
    """``word, _edges``: of each distinct ``word`` an array of ``(start, len, id, score)`` and
    what columns of the pieces ``more`` names.

    ``pieces(piece, id, score, ...)`` has unique pieces. Every single character is in
    the lattice, with a NULL id and score where it is no piece.
    """
    n = F.length("word")
    spans = _spans(words, F.sequence(F.lit(1), n), F.sequence(F.lit(1), F.least(F.lit(max_len), n - F.col("_start") + 1)))
    known = pieces.select(F.col("piece").alias("_piece"), F.col("id").alias("_id"), F.col("score").alias("_score"), *more)
    found = spans.join(known, F.col("_span") == F.col("_piece"), "left").filter(
        (F.col("_len") == 1) | F.col("_piece").isNotNull()
    )
    edge = F.struct(
        F.col("_start").alias("start"), F.col("_len").alias("len"),
        F.col("_id").alias("id"), F.col("_score").alias("score"), *more,
    )
    return found.groupBy("word").agg(F.collect_list(edge).alias("_edges"))


def joint(start: Column, length: Column, turn: Column, late: Column) -> Column:
    """An edge of two characters or more as one long; longs sort by turn, then from the left."""
    place = F.shiftleft(start, 7).bitwiseOR(F.shiftleft(length, 1)).bitwiseOR(late.cast("int"))
    return F.shiftleft(turn, 13).bitwiseOR(place.cast("long"))


def joints(words: DataFrame, pieces: DataFrame, max_len: int) -> DataFrame:
    """``word, _joints``: of each distinct ``word``, of at most 61 characters, its edges of two
    characters or more as ``joint`` has them; ``pieces(piece, turn, late)`` as for ``merge_cuts``."""
    n, start, size = F.length("word"), F.col("_start"), F.col("_len")
    # one span of one character keeps each word
    least = F.when(start == 1, 1).otherwise(2)
    spans = _spans(
        words, F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), F.sequence(least, F.least(F.lit(max_len), n - start + 1))
    )
    known = pieces.select(F.col("piece").alias("_piece"), F.col("turn").alias("_turn"), F.col("late").alias("_late"))
    found = spans.join(known, F.col("_span") == F.col("_piece"), "left").filter(
        F.when(size == 1, start == 1).otherwise(F.col("_piece").isNotNull())
    )
    code = F.when(size > 1, joint(start, size, F.col("_turn"), F.col("_late")))
    return found.groupBy("word").agg(F.collect_list(code).alias("_joints"))


def viterbi(edge_list: Column, length: Column, unknown: Column) -> Column:
    """The best path as an array of ``(start, len, id)``: largest sum of scores, ties to
    the edge found first in (start, len) order. ``unknown`` scores a character without a piece.

    The fold keeps one cell a position: the best score up to it and the edge taken.
    """
    cell = "struct<score:double,start:int,len:int,id:int>"

    def best_at(ends: Column, cells: Column) -> Column:
        options = F.transform(
            ends,
            lambda e: F.struct(
                (F.element_at(cells, e["start"])["score"] + F.coalesce(e["score"], unknown)).alias("score"),
                e["start"].alias("start"), e["len"].alias("len"), e["id"].alias("id"),
            ),
        )
        return F.aggregate(
            options, F.lit(None).cast(cell),
            lambda a, b: F.when(a.isNull() | (b["score"] > a["score"]), b).otherwise(a).cast(cell),
        )

    def by_end(edges_: Column) -> Column:
        """Edges sorted, so that each end's edges are taken in (start, len) order."""
        return F.sort_array(edges_)

    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("start"), F.lit(0).alias("len"),
                             F.lit(None).cast("int").alias("id")).cast(cell))

    def table(edges_: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), length), first,
            lambda cells, p: F.concat(
                cells,
                F.array(best_at(F.filter(edges_, lambda e: e["start"] + e["len"] - 1 == p), cells)),
            ),
        )

    step = "struct<start:int,len:int,id:int>"

    def back(cells: Column) -> Column:
        walked = F.aggregate(
            F.sequence(length, F.lit(1), F.lit(-1)),
            F.struct((length + 1).alias("at"), F.array().cast(f"array<{step}>").alias("path")),
            lambda acc, p: F.when(
                p + 1 == acc["at"],
                let(
                    F.element_at(cells, p + 1),
                    lambda c: F.struct(
                        c["start"].alias("at"),
                        F.concat(
                            acc["path"],
                            F.array(F.struct(c["start"].alias("start"), c["len"].alias("len"), c["id"].alias("id"))),
                        ).alias("path"),
                    ),
                ),
            ).otherwise(acc),
            lambda acc: acc["path"],
        )
        return F.reverse(walked)

    return let(by_end(edge_list), lambda s: let(table(s), back))


def _bit(p: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), p)


def merge_cuts(joints_: Column, word: Column) -> Column:
    """The cuts between ``word``'s pieces as byte-pair merging leaves them: bits of a long, bit
    ``p`` for a piece that starts at ``p`` (from 1), and one after the last character.

    Starting from single characters, each step joins the adjacent two whose joint
    piece has the lowest ``turn`` (ties: leftmost), until none is a piece. Words have at most 61
    characters: an edge joins two neighbours when both its ends are cuts and one cut lies inside.

    A piece is ``late`` unless, merged by itself, each merge that leads to it has a lower turn.
    What happens inside a span before it is joined is what happens there by itself, so
    a piece that isn't late is joined when its turn comes or never, and one walk over the edges
    in order makes the same merges. Words with late pieces look for the best edge at each step.
    """
    n = F.length(word)
    all_cuts = _bit(n + 2) - 2

    def apply(cuts: Column, e: Column, otherwise: Column) -> Column:
        start = F.shiftright(e, 7).cast("int").bitwiseAND(F.lit(63))
        end = start + F.shiftright(e, 1).cast("int").bitwiseAND(F.lit(63))
        inner = _bit(end) - _bit(start + 1)
        fits = (
            (F.call_function("getbit", cuts, start) == 1) & (F.call_function("getbit", cuts, end) == 1)
            & (F.bit_count(cuts.bitwiseAND(inner)) == 1)
        )
        return F.when(fits, cuts.bitwiseAND(F.bitwise_not(inner))).otherwise(otherwise)

    def walk(r: Column) -> Column:
        return F.aggregate(r, all_cuts, lambda cuts, e: apply(cuts, e, cuts))

    def search(r: Column) -> Column:
        none = F.lit(None).cast("long")

        def step(cuts: Column) -> Column:
            best = F.aggregate(r, none, lambda found, e: F.coalesce(found, apply(cuts, e, none)))
            return F.coalesce(best, cuts)

        return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), all_cuts, lambda cuts, _: step(cuts))

    late = F.exists(joints_, lambda e: e.bitwiseAND(F.lit(1)) == 1)
    return F.when(late, let(F.sort_array(joints_), search)).otherwise(walk(F.sort_array(joints_)))


def merges(edge_list: Column, word: Column) -> Column:
    """The ``(start, len, id)`` of ``word``'s pieces as byte-pair merging gives them: the edges
    between neighbouring cuts of ``merge_cuts``; edges with the pieces' ``turn`` and ``late``."""
    long_ones = F.filter(edge_list, lambda e: (e["len"] > 1) & e["id"].isNotNull())
    codes = F.transform(long_ones, lambda e: joint(e["start"], e["len"], e["turn"], e["late"]))

    def named(cuts: Column) -> Column:
        def between(e: Column) -> Column:
            ends = _bit(e["start"]).bitwiseOR(_bit(e["start"] + e["len"]))
            return cuts.bitwiseAND(_bit(e["start"] + e["len"] + 1) - _bit(e["start"])) == ends

        return F.transform(
            F.sort_array(F.filter(edge_list, between)),
            lambda e: F.struct(e["start"].alias("start"), e["len"].alias("len"), e["id"].alias("id")),
        )

    return let(merge_cuts(codes, word), named)


def starts(path: Column) -> Column:
    """The cuts of a path of ``(start, len, id)``, as ``merge_cuts`` gives them without the last."""
    return F.aggregate(path, F.lit(0).cast("long"), lambda cuts, e: cuts.bitwiseOR(_bit(e["start"])))
