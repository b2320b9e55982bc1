"""Operator 13: language-model scores by context-tree weighting over bytes.

A text is the bytes of its words (A-Z lower-cased), each but the last followed by a
space, closed by one line feed, and preceded by ``depth`` line feeds as context. A byte is
eight binary decisions, highest bit first; each decision has a tree of contexts, the last
0 to ``depth`` bytes, of its own. A node with ``a`` zeros and ``b`` ones in the training
texts has the Krichevsky-Trofimov block probability ``KT(a, b)``, and its weighted
probability is ``KT`` at full depth, else ``KT / 2 + (product of its children) / 2``. A
decision's probability then mixes the nodes on its path: each stops with its posterior
weight ``(KT / 2) / weighted`` and otherwise passes on to the deeper one. Contexts that
no training text holds are nodes without counts, whose estimate is 1/2.

As the probability of a byte depends on its ``depth`` predecessors alone, the model is a
table of all distinct windows of ``depth + 1`` bytes of the corpus, those of held-out
texts with a count of zero. It grows with the corpus and stays distributed:

* texts are written once as bytes, packed in blocks of about ``BLOCK_BYTES`` of one input partition;
* each block gives its distinct windows and words, with training counts, and Spark adds
  them up;
* windows are dealt by the last two context bytes; a task climbs from full depth
  to the two-byte nodes, whole subtrees at a time (at most 256 ** (depth - 1) windows). Two-byte
  nodes meet by their last byte, and the at most 256 * 255 one-byte nodes pass the driver, which
  folds the root;
* windows and words go back to the blocks that hold them, one row a distinct one,
  and texts are scored there.

The baseline is the smoothed unigram model of the same training texts, the end being a
token. Rows are scored one by one: no group of equal texts or ids meets in a task.

Defined cases: NULL, empty and blank texts are the end token alone. A NULL id counts as
training. Repeated rows count and are scored as often as they stand there. Without
training texts every decision has probability 1/2. An empty table gives an empty
result. Texts of any length are read whole. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.blocks import ROW_BYTES, blocked, numbers, pack, unpack
from textlab.llm.common import materialise

BLOCK_BYTES = 16 << 20
#: Bytes whose windows one step holds.
STEP_BYTES = 2 << 20
#: Windows after which a task climbs through the subtrees it holds.
STEP_WINDOWS = 1 << 19
OUT_ROWS = 1 << 16
END = b"\n"


@dataclass(frozen=True)
class ContextTree:
    """``depth`` context bytes, at most 6; ids with ``crc32 mod folds == held`` don't train."""

    depth: int = 4
    folds: int = 5
    held: int = 1


def _bodies(batches: Iterator) -> Iterator:
    """Texts as bytes."""
    import re

    import pyarrow as pa

    words = re.compile(rb"[^\x20\x09-\x0D]+").findall
    for batch in batches:
        sizes, bodies = [], []
        for t in batch.column("text"):
            found = words((t.as_py() or "").encode("utf-8").lower())
            sizes.append(len(found) + 1)
            bodies.append(b" ".join(found) + END)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("held_out"), pa.array(sizes, pa.int64()),
                pa.array(bodies, pa.binary()),
            ],
            names=["doc_id", "held_out", "n_tokens", "body"],
        )


def _blocks(batches: Iterator) -> Iterator:
    import pyarrow as pa
    import pyarrow.compute as pc

    number = numbers()
    sizes = lambda b: ROW_BYTES + pc.binary_length(b.column("body")).to_numpy(zero_copy_only=False)
    for block in blocked(_bodies(batches), sizes, BLOCK_BYTES):
        yield pa.RecordBatch.from_arrays(
            [pa.array([next(number)], pa.int64()), pa.array([pack(block)], pa.binary())], names=["block", "packed"]
        )


def _windows(bodies: Iterator[bytes], depth: int) -> Iterator[tuple[Any, Any, Any]]:
    """Steps of (windows, starts, rows): the codes of all windows of some texts in order, where
    each text's (or piece of a long text's) windows start, and which row it is."""
    import numpy as np

    held, size = [], 0

    def step() -> tuple[Any, Any, Any]:
        data = np.frombuffer(b"".join(s for _, s in held), np.uint8).astype(np.int64)
        lengths = np.array([len(s) for _, s in held])
        last = np.ones(len(data), bool)  # bytes that are predicted, not the context before
        begin = np.cumsum(lengths) - lengths
        last[(begin[:, None] + np.arange(depth)).reshape(-1)] = False
        code = np.zeros(len(data) - depth, np.int64)
        for k in range(depth + 1):
            code = (code << 8) | data[k : len(data) - depth + k]
        counts = lengths - depth
        return code[last[depth:]], np.cumsum(counts) - counts, np.array([r for r, _ in held])

    for row, body in enumerate(bodies):
        for at in range(0, len(body), STEP_BYTES):
            before = body[max(0, at - depth) : at]
            held.append((row, END * (depth - len(before)) + before + body[at : at + STEP_BYTES]))
            size += len(held[-1][1])
            if size >= STEP_BYTES:
                yield step()
                held.clear()
                size = 0
    if held:
        yield step()


def _tokens(body: bytes) -> list[bytes]:
    return [*body[:-1].split(b" "), END] if len(body) > 1 else [END]


def _counted(codes: Any, weight: int = 1) -> tuple[Any, Any]:
    """Distinct codes with ``weight`` times their number."""
    import numpy as np

    ordered = np.sort(codes)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
    return ordered[starts], weight * np.diff([*starts, len(ordered)]).astype(np.int64)


def _added(parts: list) -> tuple[Any, Any]:
    """Distinct codes and the sums of their counts."""
    import numpy as np

    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    sums = np.zeros(len(codes), np.int64)
    np.add.at(sums, at, np.concatenate([n for _, n in parts]))
    return codes, sums


def _units(depth: int):
    """Distinct words and windows of each block with their training counts."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("packed"), strict=True):
                rows = unpack(packed.as_py())
                bodies = rows.column("body").to_pylist()
                trains = ~rows.column("held_out").to_numpy()
                words, others, grams = Counter(), set(), []
                for body, t in zip(bodies, trains.tolist(), strict=True):
                    (words if t else others).update(_tokens(body))
                words.update(dict.fromkeys(others, 0))
                for codes, starts, texts in _windows(bodies, depth):
                    trained = np.repeat(trains[texts], np.diff([*starts, len(codes)]))
                    grams += [_counted(codes[trained]), _counted(codes[~trained], 0)]
                    if len(grams) > 8:
                        grams = [_added(grams)]
                codes, sums = _added(grams)
                w, g = len(words), len(codes)
                whole = pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(w + g, block), pa.int64()),
                        pa.array([*words, *[None] * g], pa.binary()),
                        pa.array(np.concatenate([np.zeros(w, np.int64), codes]), mask=np.arange(w + g) < w),
                        pa.array(np.concatenate([np.fromiter(words.values(), np.int64, w), sums])),
                    ],
                    names=["block", "word", "gram", "n"],
                )
                for at in range(0, w + g, OUT_ROWS):
                    yield whole.slice(at, OUT_ROWS)

    return run


def log_kt(zeros: Any, ones: Any) -> Any:
    """Natural logarithm of the Krichevsky-Trofimov block probability."""
    import numpy as np

    def log_gamma(x: Any) -> Any:
        values, at = np.unique(x, return_inverse=True)
        return np.array([math.lgamma(v) for v in values.tolist()])[at]

    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def climb(nodes: Any, zeros: Any, ones: Any, log_w: Any, bits: int) -> tuple:
    """From sorted nodes to their parents, whose keys are the lowest ``bits`` bits of theirs.

    Returns the parents' keys, counts and weighted log probabilities, their posterior
    weights of stopping, and each node's parent."""
    import numpy as np

    parent = nodes & ((1 << bits) - 1)
    order = np.argsort(parent, kind="stable")
    ordered = parent[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    starts = np.flatnonzero(new)
    up = np.empty(len(nodes), np.int64)
    up[order] = np.cumsum(new) - 1
    zeros, ones, below = (np.add.reduceat(x[order], starts) for x in (zeros, ones, log_w))
    own = log_kt(zeros, ones)
    log_w = np.logaddexp(own, below) - math.log(2)
    return ordered[starts], zeros, ones, log_w, np.exp(own - math.log(2) - log_w), up


def subtree(codes: Any, counts: Any, plane: int, depth: int, top: int) -> tuple:
    """One bit plane of whole subtrees given by their sorted windows.

    Returns each window's probability of its own bit mixed from full depth up to
    ``top`` context bytes, and the nodes there (keys, zeros, ones, log weighted)."""
    import numpy as np

    # windows in order keep each node's windows together
    key, bit = codes >> (8 - plane), (codes >> (7 - plane)) & 1
    new = np.concatenate([[True], key[1:] != key[:-1]])
    starts = np.flatnonzero(new)
    at = np.cumsum(new) - 1
    ones = np.add.reduceat(counts * bit, starts)
    zeros = np.add.reduceat(counts, starts) - ones
    nodes, log_w = key[starts], log_kt(zeros, ones)

    def estimate() -> Any:
        return (np.where(bit == 1, ones[at], zeros[at]) + 0.5) / (zeros[at] + ones[at] + 1.0)

    p = estimate()
    for d in range(depth - 1, top - 1, -1):
        nodes, zeros, ones, log_w, stop, up = climb(nodes, zeros, ones, log_w, 8 * d + plane)
        at = up[at]
        p = stop[at] * estimate() + (1.0 - stop[at]) * p
    return p, (nodes, zeros, ones, log_w)


_LOW = "gram long, p array<double>, plane int, node long, zeros long, ones long, log_w double"


def _low(depth: int):
    """Windows sorted by their last two context bytes: their mixtures, and the two-byte nodes."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def out(codes: Any, counts: Any) -> Iterator:
            order = np.argsort(codes)
            codes, counts = codes[order], counts[order]
            p = np.empty((len(codes), 8))
            for plane in range(8):
                p[:, plane], nodes = subtree(codes, counts, plane, depth, 2)
                n = len(nodes[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.float64())),
                        pa.array(np.full(n, plane), pa.int32()), pa.array(nodes[0], pa.int64()),
                        pa.array(nodes[1], pa.int64()), pa.array(nodes[2], pa.int64()), pa.array(nodes[3]),
                    ],
                    names=["gram", "p", "plane", "node", "zeros", "ones", "log_w"],
                )
            n = len(codes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(codes, pa.int64()),
                    pa.ListArray.from_arrays(np.arange(0, 8 * n + 1, 8, dtype=np.int32), p.reshape(-1)),
                    pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.int64())] * 3, pa.nulls(n, pa.float64()),
                ],
                names=["gram", "p", "plane", "node", "zeros", "ones", "log_w"],
            )

        held, size = [], 0
        for batch in batches:
            held.append((batch.column("gram").to_numpy(), batch.column("n").to_numpy()))
            size += batch.num_rows
            if size >= STEP_WINDOWS:
                codes, counts = (np.concatenate(x) for x in zip(*held, strict=True))
                tail = (codes >> 8) & 0xFFFF
                whole = int(np.flatnonzero(tail != tail[-1])[-1]) + 1 if tail[0] != tail[-1] else 0
                if whole:
                    yield from out(codes[:whole], counts[:whole])
                held = [(codes[whole:], counts[whole:])]
                size = len(codes) - whole
        if size:
            yield from out(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _middle(key: tuple, table: Any) -> Any:
    """Two-byte nodes that share their last byte: the one-byte nodes with their weights."""
    import numpy as np
    import pyarrow as pa

    out = []
    plane_of, node, zeros, ones, log_w = (table.column(c).to_numpy() for c in table.column_names[1:])
    for plane in range(8):
        mine = np.flatnonzero(plane_of == plane)
        if len(mine):
            mine = mine[np.argsort(node[mine])]
            nodes, z, o, w, stop, _ = climb(node[mine], zeros[mine], ones[mine], log_w[mine], 8 + plane)
            out.append([np.full(len(nodes), plane), nodes, z, o, w, stop])
    plane_of, nodes, z, o, w, stop = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table(
        {
            "plane": pa.array(plane_of, pa.int32()), "node": pa.array(nodes, pa.int64()),
            "zeros": pa.array(z, pa.int64()), "ones": pa.array(o, pa.int64()),
            "log_w": pa.array(w), "stop": pa.array(stop),
        }
    )


def mixing_top(nodes: Any) -> tuple[Any, Any]:
    """What one and no context byte add: a decision's probability is ``a + b * p`` with arrays
    ``a, b`` by (context byte, byte, plane) and ``p`` the mixture from two bytes on.

    ``nodes`` has a row (plane, node, zeros, ones, log_w, stop) for each one-byte node."""
    import numpy as np

    a, b = np.zeros((256, 256, 8)), np.zeros((256, 256, 8))
    byte = np.arange(256)
    for plane in range(8):
        mine = sorted((r for r in nodes if r["plane"] == plane), key=lambda r: r["node"])
        node = np.array([r["node"] for r in mine], np.int64)
        zeros, ones, log_w, stop = (np.array([r[c] for r in mine]) for c in ("zeros", "ones", "log_w", "stop"))
        root, z0, o0, _, stop0, _ = climb(node, zeros, ones, log_w, plane)
        # dense by (context, prefix): unseen ones are never asked for
        shape = (256, 1 << plane)
        s1, one1 = np.zeros(shape), np.full(shape, 0.5)
        s1.reshape(-1)[node] = stop
        one1.reshape(-1)[node] = (ones + 0.5) / (zeros + ones + 1.0)
        s0, one0 = np.zeros(shape[1]), np.full(shape[1], 0.5)
        s0[root], one0[root] = stop0, (o0 + 0.5) / (z0 + o0 + 1.0)
        prefix, bit = byte >> (8 - plane), (byte >> (7 - plane)) & 1
        k0, k1 = s0[prefix], s1[:, prefix]
        e0 = np.where(bit, one0[prefix], 1 - one0[prefix])
        e1 = np.where(bit, one1[:, prefix], 1 - one1[:, prefix])
        a[:, :, plane] = k0 * e0 + (1 - k0) * k1 * e1
        b[:, :, plane] = (1 - k0) * (1 - k1)
    return a, b


def _log10(a: Any, b: Any):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            code = batch.column("gram").to_numpy()
            p = batch.column("p").flatten().to_numpy().reshape(-1, 8)
            at = ((code >> 8) & 255, code & 255)
            value = np.log10(a[at] + b[at] * p).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("gram"), pa.array(value)], names=["gram", "value"])

    return run


def window_table(grams: DataFrame, cfg: ContextTree) -> DataFrame:
    """``gram, value``: log10 probability of each distinct window's last byte given the others."""
    dealt = grams.withColumn("_tail", F.shiftright("gram", 8).bitwiseAND(0xFFFF))
    low = materialise(
        dealt.repartition("_tail").sortWithinPartitions("_tail").select("gram", "n").mapInArrow(_low(cfg.depth), _LOW),
        "tree", "zstd",
    )
    nodes = low.filter(F.col("plane").isNotNull())
    last = F.expr("shiftright(node, plane)").bitwiseAND(255)
    top = (
        nodes.select(last.alias("last"), "plane", "node", "zeros", "ones", "log_w")
        .groupBy("last")
        .applyInArrow(_middle, "plane int, node long, zeros long, ones long, log_w double, stop double")
        .collect()  # at most 256 * 255 rows
    )
    if not top:
        return grams.select("gram", F.lit(0.0).alias("value"))
    return low.filter(F.col("gram").isNotNull()).select("gram", "p").mapInArrow(
        _log10(*mixing_top(top)), "gram long, value double"
    )


class _Values:
    """Values by distinct code. Codes that share a slot move on to the next, smaller table."""

    def __init__(self, codes: Any, values: Any) -> None:
        import numpy as np

        self.codes, self.values, self.tables = codes, values, []
        left = np.arange(len(codes), dtype=np.int32)
        while len(left):
            bits = max(8, (2 * len(left)).bit_length())
            table = np.zeros(1 << bits, np.int32)
            self.tables.append((bits, table))
            slot = self._slot(codes[left], len(self.tables) - 1)
            table[slot] = left
            left = left[table[slot] != left]

    def _slot(self, codes: Any, turn: int) -> Any:
        import numpy as np

        h = codes.astype(np.uint64) * np.uint64((0x9E3779B97F4A7C15 * (2 * turn + 1)) & (1 << 64) - 1)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(64 - self.tables[turn][0])).astype(np.int64)

    def of(self, codes: Any) -> Any:
        import numpy as np

        out = np.full(len(codes), np.nan)
        left = np.arange(len(codes))
        for turn, (_, table) in enumerate(self.tables):
            mine = codes if turn == 0 else codes[left]
            at = table[self._slot(mine, turn)]
            hit = self.codes[at] == mine
            out[left[hit]] = self.values[at[hit]]
            left = left[~hit]
        return out


def _score(depth: int, tokens: int, kinds: int):
    """Base and model scores of a block's texts from its words' counts and windows' values."""

    def run(blocks: Any, units: Any) -> Any:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pa.concat_tables(unpack(p.as_py()) for p in blocks.column("packed"))
        is_word = pc.is_valid(units.column("word"))
        known = units.filter(is_word)
        counts = zip(known.column("word").to_pylist(), known.column("value").to_pylist(), strict=True)
        spread = math.log10(tokens + 0.5 * (kinds + 1))
        cost = {w: math.log10(c + 0.5) - spread for w, c in counts}
        grams = units.filter(pc.invert(is_word))
        values = _Values(*(grams.column(c).to_numpy() for c in ("gram", "value")))
        bodies = texts.column("body").to_pylist()
        new = math.log10(0.5) - spread  # of words that no training text holds, and of no other
        base, seen = [], []
        for body in bodies:
            costs = list(map(cost.__getitem__, _tokens(body)))
            base.append(math.fsum(costs))
            seen.append(len(costs) - costs.count(new))
        score = np.zeros(len(bodies))
        for found, starts, rows in _windows(bodies, depth):
            np.add.at(score, rows, np.add.reduceat(values.of(found), starts))
        size = np.array([len(b) for b in bodies], np.float64)
        return pa.table(
            {
                "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"),
                "n_tokens": texts.column("n_tokens"), "n_known": pa.array(seen, pa.int64()),
                "train_tokens": pa.array([tokens] * len(bodies), pa.int64()), "base_score": pa.array(base, pa.float64()),
                "score": pa.array(score),
                "bits_per_byte": pa.array(-score * math.log2(10) / size),
            }
        )

    return run


def score(docs: DataFrame, cfg: ContextTree = ContextTree()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` of every row."""
    if not 2 < cfg.depth < 7:
        raise ValueError("depth must be 3 to 6")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % cfg.folds
    marked = docs.select("doc_id", "text", F.coalesce(remainder == cfg.held, F.lit(False)).alias("held_out"))
    kind = dict(docs.dtypes)["doc_id"]
    blocks = materialise(marked.mapInArrow(_blocks, "block long, packed binary"), "blocks", "zstd")
    units = materialise(blocks.mapInArrow(_units(cfg.depth), "block long, word binary, gram long, n long"), "units", "zstd")
    words = units.filter(F.col("word").isNotNull())
    grams = units.filter(F.col("gram").isNotNull())
    counted = words.groupBy("word").agg(F.sum("n").cast("double").alias("value"))
    tokens, kinds = counted.agg(
        F.coalesce(F.sum(F.col("value").cast("long")), F.lit(0)), F.count_if(F.col("value") > 0)
    ).first()
    table = window_table(grams.groupBy("gram").agg(F.sum("n").alias("n")), cfg)
    back = (
        words.select("block", "word").join(counted, "word")
        .select("block", "word", F.lit(None).cast("long").alias("gram"), "value")
        .unionByName(
            grams.select("block", "gram").join(table, "gram")
            .select("block", F.lit(None).cast("binary").alias("word"), "gram", "value")
        )
    )
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double"
    )
    return blocks.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        _score(cfg.depth, tokens, kinds), schema
    )
