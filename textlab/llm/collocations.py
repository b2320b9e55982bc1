"""Operator 12: phrase collocations from one count of the longest windows.

A text is lower-cased (A-Z), split into pieces at punctuation and line ends and the pieces
into words. Every word leads one window: itself and the ``max_words - 1`` words after it,
padded with NULL behind the piece's end. Only these longest windows are counted; Spark's
``ROLLUP`` over the window's columns sums them to successively shorter prefixes, and as
every occurrence of a phrase is a prefix of exactly one window, the sums are the counts of all
phrases of 1 to ``max_words`` words, and at the language's level of all words. There is no
explosion of n-grams by length.

Most windows of a corpus are unique, so a window also ends where it can't belong to a
candidate. A first pass counts all pairs and triples in ``1 << bucket_bits`` hash
buckets (numbers saturating at ``min_count``, ``1 << bucket_bits`` bytes a task, added up by bucket
range); a bucket below ``min_count`` proves that the phrases in it, and all longer ones that
hold them, are too rare. Buckets never undercount, so the result is exact whatever they
hold; the mask of one bit a bucket, 4 MB at any size, is all that every task gets.

The counts of frequent phrases then meet by join: a candidate's cuts with the counts of
both parts, and the two phrases one word shorter with its own count (a phrase that a longer one
covers is covered by one that is one word longer, as counts never grow with length).
The score's products are decimals of 38 digits. The first ``top`` of a language are taken within
salted shares of it first, so that one language may hold most rows.

Defined cases: NULL, empty and blank texts have no words; a NULL language is ``und``.
Repeated rows count as often as they stand there. Ties go by count, then phrase in byte
order. An empty table gives an empty result. Texts are read whole. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlab.llm.common import materialise

BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
#: Bytes of text, and words of one, that a step holds.
STEP_BYTES = 4 << 20
STEP_WORDS = 1 << 20
RANGE_BITS = 16
SALTS = 64


@dataclass(frozen=True)
class Collocations:
    max_words: int = 5
    min_count: int = 100
    top: int = 2000
    bucket_bits: int = 25


def _tokens(texts: Any) -> Iterator[tuple[str, list]]:
    """(language, words and breaks) of each text, a long one in overlapping pieces."""
    import re

    upper = bytes(range(65, 91))
    table = bytes.maketrans(upper + BREAKS + b"\t", upper.lower() + b"\n" * len(BREAKS) + b" ")
    find = re.compile(rb"[^ \n]+|\n").findall
    for lang, text in texts:
        found = find((text or "").encode("utf-8").translate(table))
        if found:
            found.append(b"\n")
            yield lang, found


class _Step:
    """Some texts as numbers: ``ids`` (0: a break) in order; ``words`` and ``langs`` by id.

    ``lead`` tells which positions lead windows here: a long text is cut into steps that
    overlap by the words which only continue windows."""

    def __init__(self) -> None:
        fresh = count(1).__next__
        self.vocab = defaultdict(lambda: defaultdict(fresh, {b"\n": 0}))
        self.parts, self.leads = [], []
        self.size = 0

    def add(self, lang: str, tokens: list, leads: int) -> None:
        import numpy as np

        self.parts.append(np.fromiter(map(self.vocab[lang].__getitem__, tokens), np.int64, len(tokens)))
        lead = np.zeros(len(tokens), bool)
        lead[:leads] = True
        self.leads.append(lead)
        self.size += len(tokens)

    def finish(self, extra: int) -> None:
        import numpy as np

        gap = np.zeros(extra, np.int64)
        self.ids = np.concatenate([*self.parts, gap])
        self.lead = np.concatenate([*self.leads, gap.astype(bool)])
        size = 1 + sum(len(v) - 1 for v in self.vocab.values())
        self.words, self.langs = [None] * size, [None] * size
        hashes = np.zeros(size, np.uint64)
        for lang, ids in self.vocab.items():
            start = zlib.crc32(lang.encode())
            for w, i in ids.items():
                if i:
                    self.words[i], self.langs[i], hashes[i] = w, lang, zlib.crc32(w, start)
        self.hashes = hashes

    def buckets(self, order: int, bits: int) -> tuple[Any, Any]:
        """Whether ``order`` words start at each position, and the bucket of that phrase."""
        import numpy as np

        n = len(self.ids) - order + 1
        whole = np.ones(n, bool)
        h = np.full(n, order * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
        for k in range(order):
            ids = self.ids[k : k + n]
            whole &= ids != 0
            h = (h ^ self.hashes[ids]) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
        return whole, (h >> np.uint64(64 - bits)).astype(np.int64)


def _steps(batches: Iterator, extra: int) -> Iterator[_Step]:
    """``extra``: the words that a window has beside its leading one."""
    step, held = _Step(), 0
    for batch in batches:
        rows = ((a.as_py(), b.as_py()) for a, b in zip(batch.column("lang"), batch.column("text"), strict=True))
        for lang, tokens in _tokens(rows):
            for at in range(0, len(tokens), STEP_WORDS):
                piece = tokens[at : at + STEP_WORDS + extra]
                # a step's texts end with a break, or with words that lead no window
                step.add(lang, [*piece, b"\n"], min(STEP_WORDS, len(piece)))
                held += sum(map(len, piece)) + len(piece)
                if held >= STEP_BYTES:
                    step.finish(extra)
                    yield step
                    step, held = _Step(), 0
    if held:
        step.finish(extra)
        yield step


def _bucket_counts(cfg: Collocations):
    """Saturating counts of pairs and triples by bucket, packed a range of buckets."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        counts = np.zeros(1 << cfg.bucket_bits, np.min_scalar_type(cfg.min_count))
        for step in _steps(batches, cfg.max_words - 1):
            for order in (2, 3):
                whole, bucket = step.buckets(order, cfg.bucket_bits)
                found, n = np.unique(bucket[whole & step.lead[: len(whole)]], return_counts=True)
                counts[found] = np.minimum(counts[found] + n, cfg.min_count)
        for at, part in enumerate(counts.reshape(-1, 1 << min(RANGE_BITS, cfg.bucket_bits))):
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                    names=["range", "packed"],
                )

    return run


def _range_masks(cfg: Collocations):
    """One bit a bucket of each range: whether its counts reach ``min_count``."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        sums: dict[int, Any] = {}
        for batch in batches:
            for at, packed in zip(batch.column("range").to_pylist(), batch.column("packed"), strict=True):
                part = np.frombuffer(zlib.decompress(packed.as_py()), np.min_scalar_type(cfg.min_count))
                own = sums.setdefault(at, np.zeros(len(part), np.int64))
                own += part
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([np.packbits(s >= cfg.min_count).tobytes() for s in sums.values()], pa.binary()),
            ],
            names=["range", "mask"],
        )

    return run


def frequent_buckets(docs: DataFrame, cfg: Collocations) -> bytes:
    """The mask over all buckets; ``1 << (bucket_bits - 3)`` bytes pass the driver."""
    ranges = (
        docs.mapInArrow(_bucket_counts(cfg), "range int, packed binary")
        .repartition(min(32, 1 << max(0, cfg.bucket_bits - RANGE_BITS)), "range")
        .mapInArrow(_range_masks(cfg), "range int, mask binary")
    )
    width = 1 << min(RANGE_BITS, cfg.bucket_bits) - 3
    mask = bytearray(1 << cfg.bucket_bits - 3)
    for r in ranges.collect():
        mask[r["range"] * width : (r["range"] + 1) * width] = r["mask"]
    return bytes(mask)


def _windows(mask: bytes, cfg: Collocations):
    """Each step's distinct windows (``lang, w1 ..``) with their number ``n``."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        bits = np.frombuffer(mask, np.uint8)
        m = cfg.max_words
        for step in _steps(batches, m - 1):
            def passes(order: int, step: _Step = step) -> Any:
                whole, bucket = step.buckets(order, cfg.bucket_bits)
                out = np.zeros(len(step.ids) + m, bool)
                out[: len(whole)] = whole & ((bits[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1 == 1)
                return out

            n = len(step.ids)
            pair, triple = passes(2), passes(3)
            padded = np.concatenate([step.ids, np.zeros(m, np.int64)])
            window = np.zeros((m, n), np.int64)
            window[0] = step.ids
            goes_on = pair[:n] & step.lead
            for k in range(1, m):
                if k > 1:
                    goes_on = goes_on & triple[k - 2 : k - 2 + n]
                window[k] = np.where(goes_on, padded[k : k + n], 0)
            window = window[:, step.lead & (step.ids != 0)]
            if not window.shape[1]:
                continue
            single = window[1] == 0
            alone = np.bincount(window[0][single], minlength=len(step.words))
            one = np.flatnonzero(alone)
            longer = window[:, ~single]
            longer = longer[:, np.lexsort(longer[::-1])]
            new = np.ones(longer.shape[1], bool)
            new[1:] = (longer[:, 1:] != longer[:, :-1]).any(axis=0)
            starts = np.flatnonzero(new)
            counts = np.concatenate([alone[one], np.diff([*starts, longer.shape[1]])])
            first = np.zeros((m, len(one)), np.int64)
            first[0] = one
            ids = np.concatenate([first, longer[:, starts]], axis=1)
            words = pa.array(step.words, pa.binary()).cast(pa.string())
            langs = pa.array(step.langs, pa.string())
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(ids[0])), *[words.take(pa.array(w)) for w in ids], pa.array(counts, pa.int64())],
                names=["lang", *_columns(cfg), "n"],
            )

    return run


def _columns(cfg: Collocations) -> list[str]:
    return [f"w{k}" for k in range(1, cfg.max_words + 1)]


def phrase_counts(docs: DataFrame, cfg: Collocations = Collocations()) -> DataFrame:
    """``lang, phrase, words, n``: phrases of 1 to ``max_words`` words found ``min_count`` times
    or more, and for each language a row of 0 words that counts all its words."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter(F.length("text") > 0)
    columns = _columns(cfg)
    fields = ", ".join(f"{c} string" for c in columns)
    top = (
        texts.mapInArrow(_windows(frequent_buckets(texts, cfg), cfg), f"lang string, {fields}, n long")
        .groupBy("lang", *columns).agg(F.sum("n").alias("n"))
    )
    rolled = top.rollup("lang", *columns).agg(F.sum("n").alias("n"), F.grouping_id().alias("_gid"))
    # the words that a row's grouping kept; the last of them must not be padding
    kept = F.lit(cfg.max_words) - F.bit_count("_gid").cast("int")
    last = F.get(F.array(*columns), kept - 1)
    return (
        rolled.withColumn("words", kept)
        .filter((F.col("words") == 0) | ((F.col("words") > 0) & last.isNotNull() & (F.col("n") >= cfg.min_count)))
        .select("lang", F.concat_ws(" ", *columns).alias("phrase"), "words", "n")
    )


def mine(docs: DataFrame, cfg: Collocations = Collocations()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases."""
    counts = materialise(phrase_counts(docs, cfg), "phrases")
    phrases = counts.filter("words > 0")
    candidates = phrases.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))

    def part(name: str) -> DataFrame:
        return phrases.select("lang", F.col("phrase").alias(f"_{name}"), F.col("n").alias(name))

    split = F.split("phrase", " ")
    cuts = (
        candidates.withColumn("_w", split)
        .withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .select(
            "lang", "phrase", "a", "_k",
            F.concat_ws(" ", F.slice("_w", F.lit(1), F.col("_k"))).alias("_l"),
            F.concat_ws(" ", F.slice("_w", F.col("_k") + 1, F.col("words") - F.col("_k"))).alias("_r"),
        )
    )
    totals = counts.filter("words = 0").select("lang", "n")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    scored = (
        cuts.join(part("l"), ["lang", "_l"]).join(part("r"), ["lang", "_r"]).join(totals, "lang")
        .withColumn("_top", wide["a"] * wide["n"] * F.lit(1000).cast("decimal(4,0)"))
        .withColumn("_below", wide["l"] * wide["r"])
        .withColumn("score", F.expr("_top div _below"))
        .groupBy("lang", "phrase").agg(F.min(F.struct("score", "_k", "a", "l", "r", "n")).alias("_best"))
        .select("lang", "phrase", "_best.*")
    )
    longer = candidates.filter("words > 2").withColumn("_w", split)
    shorter = F.array(
        F.concat_ws(" ", F.slice("_w", F.lit(1), F.col("words") - 1)),
        F.concat_ws(" ", F.slice("_w", F.lit(2), F.col("words") - 1)),
    )
    covered = (
        longer.select("lang", F.explode(shorter).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("_covers"))
    )
    left = scored.join(covered, ["lang", "phrase"], "left").filter(
        F.col("_covers").isNull() | (F.col("_covers") < F.col("a"))
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    share = Window.partitionBy("lang", "_share").orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    first = (
        left.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        .withColumn("_n", F.row_number().over(share)).filter(F.col("_n") <= cfg.top)
    )
    return (
        first.withColumn("rank", F.row_number().over(whole).cast("long")).filter(F.col("rank") <= cfg.top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
