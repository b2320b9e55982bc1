"""Operator 7: repeated multi-line passages, DataFrame functions only.

A text's lines are hashed; a rolling hash over each window of ``window`` line hashes
ends a chunk unless it is divisible by ``divisor``: passages of few lines need boundaries
inside them. A boundary depends on the lines
just before it alone, so lines inserted or removed elsewhere shift no other
boundary. Units are the chunks of ``min_lines`` lines or more and every pair of
neighbouring chunks, so that one-line chunks inside a passage leave no gap. Units whose
hash occurs more than once in the corpus are compared byte by byte with the
occurrence that is kept, and the chunks of equal ones are removed.

Units overlap, so the first occurrence of one (smallest document, then position) may
itself lose a chunk to another. Kept is therefore the first occurrence none of whose chunks lies
in a later occurrence of some other unit; where there is none, the unit removes nothing. The kept
occurrence stays whole, so every removed unit is still found in one piece. What a
passage's edges cut off stays: chunks that begin before it or end behind it are not equal.

Hashes alone are grouped, with map-side pre-aggregation. Texts move twice: documents to
meet the places of their repeated units, whose texts are taken there, and documents to
meet their removals; a unit that a third of the documents hold is left to AQE's skew
splitting, and its hash is one row there.

Defined cases: a NULL or empty text has no chunks and stays as it is. Units
without a word are never removed. Rows equal in id and text count as one
document and get the same result. A document that lost chunks and has no word left
is dropped. An empty table gives an empty result.
Extra columns are kept, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.common import let, materialise

KEY = ["_id", "_th"]
WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Chunking:
    """Chunks go on over one line end in ``divisor``."""

    window: int = 2
    divisor: int = 4
    min_lines: int = 2


def chunks(text: Column, cfg: Chunking = Chunking()) -> Column:
    """The text as an array of ``(text, lines)``: joined by LF they are the text again."""

    def cut(lines: Column) -> Column:
        hashes = F.transform(lines, lambda x: F.xxhash64(x))

        def ends(h: Column) -> Column:
            rolled = F.transform(
                h,
                lambda x, i: F.xxhash64(x, *[F.get(h, i - j) for j in range(1, cfg.window)]),
            )
            at = F.filter(
                F.transform(
                    rolled,
                    lambda x, i: F.when((F.pmod(x, F.lit(cfg.divisor).cast("long")) != 0) | (i + 1 == F.size(h)), i + 1),
                ),
                lambda x: x.isNotNull(),
            )
            return at

        def pieces(e: Column) -> Column:
            def one(end: Column, i: Column) -> Column:
                start = F.coalesce(F.get(e, i - 1), F.lit(0))
                return F.struct(
                    F.array_join(F.slice(lines, start + 1, end - start), "\n").alias("text"),
                    (end - start).alias("lines"),
                )

            return F.transform(e, one)

        return let(let(hashes, ends), pieces)

    return F.when(text.isNotNull() & (text != ""), let(F.split(text, "\n"), cut))


def _parts(text: Column, cfg: Chunking) -> Column:
    return F.transform(chunks(text, cfg), lambda x: x["text"])


def _left(parts: Column, gone: Column) -> Column:
    """The parts at positions not in the sorted ``gone``: the slices between them."""

    def between(ends: Column) -> Column:
        def one(end: Column, i: Column) -> Column:
            start = F.coalesce(F.get(ends, i - 1) + 1, F.lit(0))
            return F.slice(parts, start + 1, end - start)

        return F.flatten(F.transform(ends, one))

    return let(F.concat(gone, F.array(F.size(parts))), between)


def _joined(parts: Column) -> Column:
    """The text of what is left, NULL where the document is dropped."""
    return F.when(F.exists(parts, lambda x: x.rlike(WORD)), F.array_join(parts, "\n"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"), "text")


def _units(docs: DataFrame, cfg: Chunking) -> DataFrame:
    """``_id, _th, _at, _hash`` of each unit that holds a word. ``_at`` is twice the position of its
    first chunk, one more for a pair."""

    def hashed(marks: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            after = F.get(marks, i + 1)
            alone = F.when((m["lines"] >= cfg.min_lines) & m["word"], m["hash"])
            both = F.when(m["word"] | after["word"], F.xxhash64(m["hash"], after["hash"], F.lit(2)))
            both = F.when(i + 1 < F.size(marks), both)
            return F.array(
                F.struct((2 * i).alias("_at"), alone.alias("_hash")),
                F.struct((2 * i + 1).alias("_at"), both.alias("_hash")),
            )

        return F.flatten(F.transform(marks, one))

    marks = F.transform(
        chunks(F.col("text"), cfg),
        lambda x: F.struct(
            F.xxhash64(x["text"]).alias("hash"), x["lines"].alias("lines"), x["text"].rlike(WORD).alias("word")
        ),
    )
    return _keyed(docs).select(*KEY, F.inline(let(marks, hashed))).filter("_hash is not null")


def _repeated(units: DataFrame) -> DataFrame:
    """``_h, _first``: hashes that occur more than once, and where first."""
    mark = F.xxhash64("_id", "_th", "_at")
    return (
        units.groupBy("_hash")
        .agg(F.min(F.struct("_id", "_th", "_at")).alias("_first"), F.min(mark).alias("_low"), F.max(mark).alias("_high"))
        .filter("_low <> _high")
        .select(F.col("_hash").alias("_h"), "_first")
    )


def _chunk(at: Column) -> Column:
    return F.shiftright(at, 1)


def _last(at: Column) -> Column:
    return _chunk(at) + at % 2


def _spoiled(places: Column, p: Column, i: Column) -> Column:
    """Whether a chunk of place ``p`` lies in a later occurrence of a unit at another place.

    Places come in order, at most two a position, so what overlaps is at most four away."""
    near = [F.get(places, i + d) for d in (-4, -3, -2, -1, 1, 2, 3, 4)]
    hits = [
        F.coalesce(
            ~q["_is_first"] & (_chunk(q["_at"]) <= _last(p["_at"])) & (_chunk(p["_at"]) <= _last(q["_at"])),
            F.lit(False),
        )
        for q in near
    ]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return out


def _found(docs: DataFrame, cfg: Chunking) -> DataFrame:
    """``_id, _th, _at, _hash, _text, _is_first, _spoiled`` of each unit of a repeated hash."""
    units = materialise(_units(docs, cfg), "units", "zstd")
    place = F.struct("_at", "_hash", F.struct("_id", "_th", "_at").eqNullSafe(F.col("_first")).alias("_is_first"))
    places = (
        units.join(_repeated(units), F.col("_hash") == F.col("_h"))
        .groupBy(F.col("_id").alias("_gid"), F.col("_th").alias("_gth"))
        .agg(F.sort_array(F.collect_set(place)).alias("_places"))
    )
    texts = let(_parts(F.col("text"), cfg), lambda parts: let(F.col("_places"), lambda s: F.transform(
        s,
        lambda p, i: F.struct(
            p["_at"].alias("_at"), p["_hash"].alias("_hash"),
            F.array_join(F.slice(parts, _chunk(p["_at"]) + 1, p["_at"] % 2 + 1), "\n").alias("_text"),
            p["_is_first"].alias("_is_first"), _spoiled(s, p, i).alias("_spoiled"),
        ),
    )))
    return (
        _keyed(docs).join(
            places.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_th") == F.col("_gth"))
        )
        .select(*KEY, F.inline(texts))
    )


def removals(docs: DataFrame, cfg: Chunking = Chunking()) -> DataFrame:
    """``_id, _th, _gone``: of each document the sorted positions of chunks to remove."""
    # written once, so that texts meet the repeated hashes once for both uses below
    found = materialise(_found(docs, cfg), "repeated-units", "zstd")
    where = F.struct("_id", "_th", "_at")
    kept = (
        found.filter("not _spoiled").groupBy("_hash")
        .agg(F.min(F.struct(where.alias("at"), F.col("_text").alias("text"))).alias("_kept"))
        .select(F.col("_hash").alias("_h"), F.col("_kept.at").alias("_kept_at"), F.col("_kept.text").alias("_kept_text"))
    )
    equal = found.filter("not _is_first").join(
        kept, (F.col("_hash") == F.col("_h")) & (F.col("_text") == F.col("_kept_text")) & ~where.eqNullSafe(F.col("_kept_at"))
    )
    gone = F.array_distinct(F.flatten(F.collect_set(F.sequence(_chunk(F.col("_at")), _last(F.col("_at"))))))
    return equal.groupBy(*KEY).agg(F.array_sort(gone).alias("_gone"))


def dedup_lines(docs: DataFrame, cfg: Chunking = Chunking()) -> DataFrame:
    """The documents without repeated units, in the columns they came with."""
    gone = removals(docs, cfg).select(F.col("_id").alias("_gid"), F.col("_th").alias("_gth"), "_gone")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    joined = docs.select(row, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"), F.col("text").alias("_text")).join(
        gone.hint("shuffle_hash"),
        F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_th") == F.col("_gth")), "left",
    )

    def rest(parts: Column) -> Column:
        return let(_left(parts, F.col("_gone")), _joined)

    cleaned = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(let(_parts(F.col("_text"), cfg), rest))
    kept = joined.select("_row", "_gone", cleaned.alias("_clean")).filter(
        F.col("_gone").isNull() | F.col("_clean").isNotNull()
    )
    return kept.select(
        *[(F.col("_clean") if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns]
    )


def line_report(docs: DataFrame, cfg: Chunking = Chunking()) -> DataFrame:
    """``doc_id, n_chunks, n_removed, n_chars, kept_chars, kept_md5``, all documents."""
    gone = removals(docs, cfg).select(F.col("_id").alias("_gid"), F.col("_th").alias("_gth"), "_gone")
    joined = _keyed(docs).join(
        gone.hint("shuffle_hash"),
        F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_th") == F.col("_gth")), "left",
    )
    none = F.array().cast("array<int>")
    cut = joined.select(
        F.col("_id").alias("doc_id"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.coalesce("_gone", none).alias("_gone"), _parts(F.col("text"), cfg).alias("_chunks"), "text",
    )
    left = let(_left(F.col("_chunks"), F.col("_gone")), lambda x: F.coalesce(_joined(x), F.lit("")))
    clean = F.when(F.size("_gone") == 0, F.coalesce("text", F.lit(""))).otherwise(left)
    return cut.select(
        "doc_id",
        F.coalesce(F.size("_chunks"), F.lit(0)).cast("long").alias("n_chunks"),
        F.size("_gone").cast("long").alias("n_removed"),
        "n_chars",
        clean.alias("_clean"),
    ).select(
        "doc_id", F.greatest("n_chunks", F.lit(0)).alias("n_chunks"), "n_removed", "n_chars",
        F.length("_clean").cast("long").alias("kept_chars"), F.md5("_clean").alias("kept_md5"),
    )
