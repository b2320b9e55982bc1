"""Operator 2: SentencePiece encoding and decoding over a relational lattice.

Texts are cut into units that no piece of the model crosses (white-space runs with
what follows; letters apart from other characters where the model's pieces
allow it). The distinct units of each block of documents are collected, and of
all distinct units the substrings up to the longest piece are exploded, equi-joined to
the piece table and grouped by unit. A fold with ``aggregate`` then picks the
pieces: for unigram models Viterbi on the piece scores, for byte-pair models the
model's own merge order on the same lattice (its scores are ranks: their largest sum
is not what the library returns). Characters without a piece become byte pieces.
Encoded units go back to their blocks, where texts are spelled with them.

Only distinct units of a block are shuffled, never their occurrences, packed by share of
all units; a share's task finds its distinct units, and later hands each block where the
pieces of its units start, as bits in their order; the block looks up the ids of the pieces
found there. A block is ``BLOCK_BYTES`` of text from one input
partition, or one longer text, and moves once, as one compressed row. Units of more than
``LATTICE_CHARS`` characters, whose fold would take quadratic time, are encoded by the same
rule with a heap in the block's task; so are units whose answer doesn't fit because an
input without a stable order was read differently the second time.

Defined cases: a NULL text encodes like ''; both have no pieces. U+2581 stands for the
space, so it decodes as one. Repeated rows
are encoded one by one. An empty table gives an empty result. Extra columns are
ignored. Models with a normalisation table or other white-space handling than the
identity's are refused.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from textlab.llm.blocks import LEVEL, ROW_BYTES, blocked, numbers, pack, release, unpack
from textlab.llm.common import let, materialise
from textlab.llm.lattice import edges, joints, merge_cuts, merges, starts, viterbi

SPACE = "▁"
BLOCK_BYTES = 4 << 20
OUT_ROWS = 1 << 16
LATTICE_CHARS = 32
PLAIN_UNITS = f"{SPACE}*[^{SPACE}]+|{SPACE}+"
LETTER_UNITS = f"{SPACE}*[\\p{{L}}\\p{{M}}]+|{SPACE}*[^{SPACE}\\p{{L}}\\p{{M}}]+|{SPACE}+"
UNIGRAM, BPE = 1, 2


def _fields(body: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message; fixed-width fields as bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = body[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    at = 0
    while at < len(body):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            n = {1: 8, 5: 4}.get(kind)
            if n is None:
                n, at = varint(at)
            value, at = body[at : at + n], at + n
        yield tag >> 3, value


@dataclass(frozen=True)
class PieceModel:
    """``pieces``: (piece, id, score) of what texts are made of; ``spelled``: bytes of every id;
    ``late``: pieces that byte-pair merging may join out of the order of the scores."""

    pieces: tuple
    spelled: tuple
    byte_base: int
    unknown: int
    kind: int
    units: str
    max_len: int
    late: frozenset = frozenset()

    @property
    def unknown_score(self) -> float:
        return min(s for _, _, s in self.pieces) - 10.0


def _late(pieces: list) -> frozenset:
    """Pieces that, merged by themselves, are not reached by merges of falling scores."""
    score = {p: s for p, _, s in pieces}

    def in_order(piece: str) -> bool:
        parts, last = list(piece), ("", float("inf"))
        while len(parts) > 1:
            joint = [a + b for a, b in zip(parts, parts[1:])]
            known = [(-score[j], k) for k, j in enumerate(joint) if j in score]
            if not known:
                return False
            best, at = min(known)
            if -best > last[1] or (-best == last[1] and joint[at] != last[0]):
                return False
            last = joint[at], -best
            parts[at : at + 2] = [joint[at]]
        return True

    return frozenset(p for p, _, _ in pieces if not in_order(p))


def load(path: str) -> PieceModel:
    import pyarrow as pa
    import pyarrow.compute as pc
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    spec = dict(_fields(sp.serialized_model_proto()))
    trainer, normaliser = dict(_fields(spec[2])), dict(_fields(spec.get(3, b"")))
    # defaults of the format: dummy prefix and escaping on, extra white space removed
    flags = [normaliser.get(3, 1), normaliser.get(4, 1), normaliser.get(5, 1)]
    if normaliser.get(2) or flags != [1, 0, 1]:
        raise ValueError("only models with identity normalisation are supported")
    pieces, spelled = [], []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            spelled.append(bytes([int(p[1:-1], 16)]))
        elif sp.is_control(i):
            spelled.append(b"")
        elif sp.is_unknown(i):
            spelled.append(" ⁇ ".encode())
        else:
            spelled.append(p.replace(SPACE, " ").encode())
            if not sp.is_unused(i):
                pieces.append((p, i, float(sp.get_score(i))))
    base = sp.piece_to_id("<0x00>") if sp.is_byte(sp.piece_to_id("<0x00>")) else -1
    if base >= 0 and any(spelled[base + b] != bytes([b]) for b in range(256)):
        raise ValueError("byte pieces are not in order")
    names = pa.array([p for p, _, _ in pieces], pa.string())
    # by the engine that cuts the texts
    whole = {u: pc.all(pc.match_substring_regex(names, f"^(?:{u})$")).as_py() for u in (LETTER_UNITS, PLAIN_UNITS)}
    if not any(whole.values()):
        raise ValueError("a piece crosses a white-space boundary")
    kind = trainer.get(3, UNIGRAM)
    return PieceModel(
        tuple(pieces), tuple(spelled), base, sp.unk_id(), kind,
        LETTER_UNITS if whole[LETTER_UNITS] else PLAIN_UNITS, max(len(p) for p, _, _ in pieces),
        _late(pieces) if kind == BPE else frozenset(),
    )


def piece_table(spark: SparkSession, model: PieceModel) -> DataFrame:
    turn = {s: n for n, s in enumerate(sorted({s for _, _, s in model.pieces}, reverse=True))}
    rows = [(p, i, s, turn[s], p in model.late) for p, i, s in model.pieces]
    return spark.createDataFrame(rows, "piece string, id int, score double, turn long, late boolean")


def _words(texts):
    """Texts as words: each word's number, where each text ends, and the distinct words. A word
    is what stands after one space, with the further spaces before it as U+2581."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    texts.validate(full=True)  # as UTF-8
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), SPACE, " ")
    parts = pc.split_pattern(texts, " ")
    ends = parts.offsets.to_numpy()
    gaps = np.flatnonzero(pc.binary_length(parts.flatten()).to_numpy(zero_copy_only=False) == 0)
    if len(gaps):
        # texts with more than one space in a row, at an end or no word at all
        runs = re.compile(PLAIN_UNITS).findall
        odd = np.unique(np.searchsorted(ends, gaps + ends[0], "right") - 1)
        found = [
            [w[1:] for w in runs(SPACE + t.replace(" ", SPACE))] if t else [] for t in texts.take(odd).to_pylist()
        ]
        at = np.arange(len(texts))
        at[odd] = len(texts) + np.arange(len(odd))
        parts = pa.concat_arrays([parts, pa.array(found, parts.type)]).take(pa.array(at))
        ends = parts.offsets.to_numpy()
    words = parts.flatten().dictionary_encode()
    return words.indices.to_numpy(), ends[1:] - ends[0], words.dictionary


def _cut(words, pattern: str):
    """Distinct words as units: each unit's number, how many a word has, and the distinct units."""
    import pyarrow as pa
    import pyarrow.compute as pc

    # no unit has a space: they are U+2581 here
    whole = pc.binary_join_element_wise(pa.scalar(SPACE), words, "")
    parts = pc.split_pattern(pc.replace_substring_regex(whole, pattern, "\\0 "), " ")
    units = parts.flatten()
    units = units.filter(pc.greater(pc.binary_length(units), 0)).dictionary_encode()
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False) - 1
    return units.indices.to_numpy(), sizes, units.dictionary


def _text_blocks(batches: Iterator) -> Iterator:
    import pyarrow.compute as pc

    def sizes(batch):
        return ROW_BYTES + pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False)

    return blocked(batches, sizes, BLOCK_BYTES)


def _shares(units, shares: int):
    """The numbers of those distinct units that the lattice takes, by share and in order; and by
    share, from where to where it goes there and its units joined by spaces."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    taken = np.flatnonzero(pc.less_equal(pc.utf8_length(units), LATTICE_CHARS).to_numpy(zero_copy_only=False))
    own = units.take(pa.array(taken))
    bodies = own.cast(pa.binary()).to_numpy(zero_copy_only=False)
    share = np.fromiter(map(zlib.crc32, bodies), np.uint32, len(own)) % shares
    order = pc.sort_indices(own).to_numpy()
    order = order[np.argsort(share[order], kind="stable")]
    share = share[order]
    cuts = np.flatnonzero(np.diff(share, prepend=-1, append=-1)) if len(share) else np.zeros(1, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), own.take(pa.array(order)))
    joined = pc.binary_join(lists, " ").to_pylist()
    return taken[order], {
        int(share[a]): (int(a), int(b), text.encode()) for a, b, text in zip(cuts[:-1], cuts[1:], joined)
    }


def _squeezed(body: bytes) -> bytes:
    import pyarrow as pa

    return len(body).to_bytes(4, "big") + pa.Codec("zstd", LEVEL).compress(body, asbytes=True)


def _restored(packed: bytes) -> bytes:
    import pyarrow as pa

    return pa.Codec("zstd").decompress(packed[4:], int.from_bytes(packed[:4], "big"), asbytes=True)


def _listed(packed):
    """The units of some packed lists, and how many each list has."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.split_pattern(pa.array([_restored(p.as_py()) for p in packed], pa.binary()).cast(pa.string()), " ")
    return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)


def _units(pattern: str, shares: int):
    """Distinct units of each block, one packed row a share of all units."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for block, rows in zip(numbers(), _text_blocks(batches)):
            _, found = _shares(_cut(_words(rows.column("_text"))[2], pattern)[2], shares)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(found), pa.int64()), pa.array(list(found), pa.int32()),
                    pa.array([_squeezed(text) for _, _, text in found.values()], pa.binary()),
                ],
                names=["block", "share", "units"],
            )
            del rows, found
            release()
            yield out

    return run


def _distinct(batches: Iterator) -> Iterator:
    """The distinct units of whole shares."""
    import pyarrow as pa
    import pyarrow.compute as pc

    seen = pa.array([], pa.string())
    for batch in batches:
        seen = pc.unique(pa.concat_arrays([seen, _listed(batch.column("units"))[0]]))
    for at in range(0, len(seen), OUT_ROWS):
        yield pa.RecordBatch.from_arrays([seen.slice(at, OUT_ROWS)], names=["unit"])
    del seen
    release()


def _answered(found, known):
    """Each block's units of one share as where their pieces start, in their order: bits of 32,
    packed byte by byte of all units."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    units, sizes = _listed(found.column("units"))
    at = pc.index_in(units, value_set=known.column("unit").combine_chunks())
    if at.null_count:
        raise ValueError("a unit has no answer")
    cuts = known.column("cuts").to_numpy().astype("<u4")[at.to_numpy(zero_copy_only=False)]
    ends = np.cumsum(sizes)
    answers = [
        _squeezed(cuts[a:b].view(np.uint8).reshape(-1, 4).T.tobytes()) for a, b in zip(ends - sizes, ends)
    ]
    digests = [zlib.crc32(_restored(p.as_py())) for p in found.column("units")]
    del units, at, cuts
    release()
    return pa.table(
        {
            "block": found.column("block"), "share": found.column("share"), "digest": pa.array(digests, pa.int64()),
            "cuts": pa.array(answers, pa.binary()),
        }
    )


def _packed(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for block, rows in zip(numbers(), _text_blocks(batches)):
        out = pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([pack(rows)], pa.binary())], names=["block", "packed"]
        )
        del rows
        release()
        yield out


def _lattice(units: DataFrame, model: PieceModel, kind: Callable[..., DataFrame], *more) -> DataFrame:
    pieces = F.broadcast(piece_table(units.sparkSession, model))  # one row a piece of the model
    return kind(units.select(F.col("unit").alias("word")), pieces, model.max_len, *more)


def _best(model: PieceModel) -> Column:
    return viterbi(F.col("_edges"), F.length("word"), F.lit(model.unknown_score))


def encode_units(units: DataFrame, model: PieceModel) -> DataFrame:
    """``unit, ids`` of distinct ``units(unit)`` by the lattice."""
    if model.kind == BPE:
        lattice, path = _lattice(units, model, edges, ("turn", "late")), merges(F.col("_edges"), F.col("word"))
    else:
        lattice, path = _lattice(units, model, edges), _best(model)

    def ids_of(e: Column) -> Column:
        digits = F.hex(F.encode(F.substring(F.col("word"), e["start"], e["len"]), "UTF-8"))
        as_bytes = F.transform(
            F.sequence(F.lit(0), (F.length(digits) / 2).cast("int") - 1),
            lambda i: F.conv(F.substring(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("int") + model.byte_base,
        )
        unknown = as_bytes if model.byte_base >= 0 else F.array(F.lit(model.unknown))
        return F.when(e["id"].isNotNull(), F.array(e["id"])).otherwise(unknown)

    return lattice.select(F.col("word").alias("unit"), F.flatten(F.transform(path, ids_of)).alias("ids"))


def cut_units(units: DataFrame, model: PieceModel) -> DataFrame:
    """``unit, cuts`` of distinct ``units(unit)``, of at most 32 characters, by the lattice: bit ``p``
    for a piece that starts after ``p`` characters. The pieces' texts give the ids."""
    if model.kind == BPE:
        lattice, cuts = _lattice(units, model, joints), merge_cuts(F.col("_joints"), F.col("word"))
    else:
        lattice, cuts = _lattice(units, model, edges), starts(_best(model))
    own = F.call_function("shiftleft", F.lit(1).cast("long"), F.length("word")) - 1
    return lattice.select(F.col("word").alias("unit"), F.shiftright(cuts, 1).bitwiseAND(own).alias("cuts"))


def encode_long(unit: str, scores: dict, model: PieceModel) -> list[int]:
    """One unit by the model's rule, in time near linear in its length."""
    if model.kind == BPE:
        n = len(unit)
        left, right, end = list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))
        heap = []

        def offer(a: int) -> None:
            b = right[a]
            if b < n and (found := scores.get(unit[a : end[b]])):
                heapq.heappush(heap, (-found[1], a, end[a], end[b]))

        for a in range(n):
            offer(a)
        alive = [True] * n
        while heap:
            _, a, mid, stop = heapq.heappop(heap)
            if not alive[a] or end[a] != mid or mid >= n or end[mid] != stop or not alive[mid]:
                continue
            alive[mid], end[a], right[a] = False, stop, right[mid]
            if right[a] < n:
                left[right[a]] = a
            offer(a)
            if left[a] >= 0:
                offer(left[a])
        parts = [unit[a : end[a]] for a in range(n) if alive[a]]
    else:
        best, step = [0.0], [0]
        for stop in range(1, len(unit) + 1):
            options = [
                (best[a] + s, -a)
                for a in range(max(0, stop - model.max_len), stop)
                if (s := scores[unit[a:stop]][1] if unit[a:stop] in scores else
                    model.unknown_score if stop - a == 1 else None) is not None
            ]
            top = max(options)
            best.append(top[0])
            step.append(-top[1])
        parts, at = [], len(unit)
        while at:
            parts.append(unit[step[at] : at])
            at = step[at]
        parts.reverse()
    out = []
    for p in parts:
        if p in scores:
            out.append(scores[p][0])
        elif model.byte_base >= 0:
            out += [model.byte_base + b for b in p.encode("utf-8")]
        else:
            out.append(model.unknown)
    return out


def _joined(flat, starts, sizes, index):
    """The pieces of ``flat`` (at ``starts``, of ``sizes``) that ``index`` names, one after the other."""
    import numpy as np

    n = sizes[index]
    return flat[np.repeat(starts[index] - np.cumsum(n) + n, n) + np.arange(n.sum())]


def _ids(units, cuts, model: PieceModel):
    """The ids of all units, one after the other, and how many each has; ``cuts`` as ``cut_units``."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if not len(units):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    units = pa.concat_arrays([units])
    ends = np.frombuffer(units.buffers()[1], np.int32)[units.offset : units.offset + len(units) + 1]
    body = np.frombuffer(units.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    chars = np.flatnonzero((body & 0xC0) != 0x80).astype(np.int32)
    sizes = pc.utf8_length(units).to_numpy(zero_copy_only=False)
    unit = np.repeat(np.arange(len(units), dtype=np.int32), sizes)
    place = np.arange(len(chars), dtype=np.uint32) - np.repeat((np.cumsum(sizes) - sizes).astype(np.uint32), sizes)
    begins = (cuts[unit] >> place) & 1 == 1
    # the pieces are the same bytes, cut finer
    unit, at = unit[begins], np.append(chars[begins], len(body)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(body))
    number = pc.index_in(pieces, value_set=pa.array([p for p, _, _ in model.pieces], pa.string()))
    known = np.append(np.array([i for _, i, _ in model.pieces], np.int32), np.int32(model.unknown))
    ids = known[pc.fill_null(number, len(known) - 1).to_numpy(zero_copy_only=False)]
    other = number.is_null().to_numpy(zero_copy_only=False)
    if model.byte_base >= 0 and other.any():
        wide = np.where(other, np.diff(at), 1)
        ids, unit = np.repeat(ids, wide), np.repeat(unit, wide)
        ids[np.repeat(other, wide)] = model.byte_base + body[np.repeat(other, np.diff(at))].astype(np.int32)
    return ids, np.bincount(unit, minlength=len(units))


def _spelled(texts, answers, model: PieceModel, shares: int):
    """The ids of some texts, by the answers to their distinct units."""
    import numpy as np
    import pyarrow as pa

    # texts as numbers of words, words as numbers of units, units as ids
    words, ends, distinct = _words(texts)
    made, lengths, units = _cut(distinct, model.units)
    order, own = _shares(units, shares)
    cuts, known = np.zeros(len(order), np.uint32), np.zeros(len(order), bool)
    for share, digest, packed in zip(*(answers.column(c) for c in ("share", "digest", "cuts")), strict=True):
        a, b, text = own.get(share.as_py(), (0, 0, b""))
        if text and zlib.crc32(text) == digest.as_py():
            planes = np.frombuffer(_restored(packed.as_py()), np.uint8).reshape(4, -1)
            cuts[a:b] = np.ascontiguousarray(planes.T).view("<u4").ravel()
            known[a:b] = True
    del own
    order = order[known]
    flat, sizes = _ids(units.take(pa.array(order)), cuts[known], model)
    at = np.full(len(units), -1, np.int64)
    at[order] = np.arange(len(order))
    left = np.flatnonzero(at < 0)
    if len(left):
        scores = {p: (i, s) for p, i, s in model.pieces}
        other = [np.array(encode_long(u, scores, model), np.int32) for u in units.take(pa.array(left)).to_pylist()]
        at[left] = len(order) + np.arange(len(left))
        flat, sizes = np.concatenate([flat, *other]), np.concatenate([sizes, [len(x) for x in other]])
    made = at[made]
    word_ids = _joined(flat, np.cumsum(sizes) - sizes, sizes, made)
    bounds = np.concatenate([[0], np.cumsum(sizes[made])])[np.concatenate([[0], np.cumsum(lengths)])]
    starts, sizes = bounds[:-1], np.diff(bounds)
    out = [_joined(word_ids, starts, sizes, words[a : a + OUT_ROWS]) for a in range(0, len(words), OUT_ROWS)]
    ends = np.concatenate([[0], np.cumsum(sizes[words])])[np.concatenate([[0], ends])]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *out])))


def _spell(model: PieceModel, carry: list[str], arrow_schema, shares: int):
    def run(blocks, answers):
        import pyarrow as pa

        # without a packed row: a block that only the first reading made
        texts = pa.concat_tables([arrow_schema.empty_table(), *(unpack(p.as_py()) for p in blocks.column("packed"))])
        ids = _spelled(texts.column("_text").combine_chunks(), answers, model, shares)
        out = pa.Table.from_arrays([*[texts.column(c) for c in carry], ids], names=[*carry, "ids"])
        del texts, ids
        release()
        return out

    return run


def encode(docs: DataFrame, model: PieceModel, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``ids`` of every row of ``docs``, beside the columns named by ``carry``."""
    own = [F.col(f"`{c}`") for c in carry]
    rows = docs.select(*own, F.col("text").alias("_text"))
    kinds = dict(rows.dtypes)
    # shares of units as many as the session's shuffles have partitions, so that each fits a task
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = materialise(
        rows.mapInArrow(_units(model.units, shares), "block long, share int, units binary"), "units", "zstd"
    )
    # dealt once for both readers (all columns, so that the exchange is one), in a fixed number
    # of partitions: few bytes of units make much work below
    found = found.repartition(shares, "share")
    distinct = found.mapInArrow(_distinct, "unit string")
    known = cut_units(distinct.repartition(shares, "unit"), model).withColumn(
        "share", (F.crc32(F.col("unit").cast("binary")) % shares).cast("int")
    )
    answers = (
        found.groupBy("share").cogroup(known.groupBy("share"))
        .applyInArrow(_answered, "block long, share int, digest long, cuts binary")
    )
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in carry] + ["ids array<int>"])
    return (
        rows.mapInArrow(_packed, "block long, packed binary").groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_spell(model, list(carry), to_arrow_schema(rows.schema), shares), schema)
    )


def decode(encoded: DataFrame, model: PieceModel) -> DataFrame:
    """``encoded(..., ids)`` with the text that the ids spell as ``decoded``."""
    # one literal, folded when planned; in hex, as byte pieces need not be characters by themselves
    spelled = F.split(F.lit(",".join(b.hex() for b in model.spelled)), ",")
    body = F.unhex(F.array_join(F.transform(F.col("ids"), lambda i: F.element_at(spelled, i + 1)), ""))
    text = F.coalesce(F.make_valid_utf8(body.cast("string")), F.lit(""))
    without_first = let(text, lambda t: F.when(F.startswith(t, F.lit(" ")), F.substr(t, F.lit(2))).otherwise(t))
    return encoded.withColumn("decoded", without_first)
