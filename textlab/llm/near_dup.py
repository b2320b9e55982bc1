"""Operator 3: near duplicates by a chosen-path set similarity join.

A document's set is its distinct word shingles. Documents with equal sets form one
class; classes get ``slots`` minwise tokens. In each of ``trees`` trees a class goes from
a node to one child a picked slot, named by its token there: down to ``depth`` one
slot a level, which no other tree and no other level picks, so trees miss a pair
independently; then ``branch`` slots of all, by the node's own hash. From
``depth`` on, nodes of at most ``leaf`` classes are compared exhaustively; larger
ones branch again. Two classes of similarity s meet below one picked slot with
probability s: 24 trees of depth 5 all miss a pair at 0.85 with probability 8e-7.
A branching keeps it with 1 - (1 - s) ** 2: were all its nodes large down to
``deepest``, and no pivot joined it, the miss would be 1.8e-6.

Comparing a node takes two passes. First a spanning forest of its likely pairs (by
their tokens, ``margin`` below the threshold) is confirmed on the full sets of 64-bit
shingle hashes, which joins nearly all of a group. Nodes whose classes then share a
component are done; in the others all full sets are compared, and what links different
components is kept. So a group of near copies costs links in proportion to its size,
and no link between components is left out.

Nodes that stay large hold near copies as a rule. Each of their classes is first
confirmed against the likeliest of the ``pivots`` classes that each of its nodes puts
up. Nodes of one component are then done. Where all but ``leaf`` classes are of one component, these few are compared
with everything else, in blocks; other nodes branch on, and at depth ``deepest`` what
is left is compared block by block, all against all, over many tasks. Nothing is
capped.

Defined cases: a NULL or blank text has an empty set and is linked with nothing; a
text shorter than a shingle is one shingle. Repeated rows are copies of each
other. Rows with a NULL doc_id link like others; a component's id is its smallest
doc_id (NULL if all are). An empty table gives an empty result. Extra columns are
ignored (``distinct_documents`` keeps them).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.common import ascii_lower, let, materialise, words
from textlab.llm.components import components

GAP = re.compile(rb"[\x20\x09-\x0D]")
BASE = 0xD6E8FEB86659FD93


@dataclass(frozen=True)
class NearDup:
    """Pairs with ``100 * intersection >= percent * union`` are linked.

    ``slots`` are at least ``trees * depth``: each tree has its own."""

    shingle: int = 3
    percent: int = 85
    slots: int = 128
    trees: int = 24
    branch: int = 2
    depth: int = 5
    deepest: int = 7
    leaf: int = 2048
    pivots: int = 3
    margin: float = 0.12

    def __post_init__(self) -> None:
        if self.slots < self.trees * self.depth:
            raise ValueError(f"{self.trees} trees of depth {self.depth} need {self.trees * self.depth} slots")

    @property
    def likely(self) -> float:
        return self.percent / 100 - self.margin


def shingles(text: Column, n: int) -> Column:
    """64-bit hashes of all word shingles, repeats included."""
    hashes = F.transform(words(ascii_lower(F.coalesce(text, F.lit("")))), lambda w: F.xxhash64(w))

    def cut(h: Column) -> Column:
        window = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, n)]))
        return (
            F.when(F.size(h) == 0, h)
            .when(F.size(h) < n, F.array(F.xxhash64(h, F.lit("short"))))
            .otherwise(F.slice(window, F.lit(1), F.greatest(F.size(h) - (n - 1), F.lit(0))))
        )

    return let(hashes, cut)


# --- sketches and paths, in numpy -------------------------------------------------


def _multipliers(slots: int):
    import numpy as np

    return np.random.default_rng(1).integers(0, 1 << 31, slots, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minwise(values, slots: int):
    """``slots`` 16-bit minwise tokens of a non-empty set of 64-bit hashes."""
    import numpy as np

    h = values.view(np.uint64)
    h = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)
    a = _multipliers(slots)
    least = np.full(slots, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(h), 4096):
        part = h[at : at + 4096, None] * a[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return ((least ^ (least >> np.uint32(16))) & np.uint32(0xFFFF)).astype(np.uint16)


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def paths(tokens, trees: int, depth: int):
    """Nodes at ``depth``, a row a class and a column a tree: ``tokens`` are n x slots.

    On level d tree t reads slot ``t * depth + d``."""
    import numpy as np

    nodes = np.tile(_mix(np.arange(1, trees + 1, dtype=np.uint64)), (len(tokens), 1))
    for level in range(depth):
        slot = np.arange(trees, dtype=np.uint64) * np.uint64(depth) + np.uint64(level)
        token = tokens[:, level : trees * depth : depth].astype(np.uint64)
        nodes = _mix(nodes * np.uint64(0x9E3779B97F4A7C15) + (slot << np.uint64(16)) + token + np.uint64(1))
    return nodes


def children(nodes, tokens, branch: int):
    """Child nodes, ``branch`` a row: ``nodes`` of n rows, ``tokens`` n x slots."""
    import numpy as np

    slots = tokens.shape[1]
    # odd strides over a power of two, or any: picks of one node differ as long as branch <= slots
    first = _mix(nodes) % np.uint64(slots)
    stride = np.uint64(1) + _mix(nodes ^ np.uint64(0x9E37)) % np.uint64(max(1, slots - 1))
    out = []
    for j in range(branch):
        slot = (first + np.uint64(j) * stride) % np.uint64(slots)
        token = np.take_along_axis(tokens, slot.astype(np.int64)[:, None], axis=1)[:, 0].astype(np.uint64)
        out.append(_mix(nodes * np.uint64(0x9E3779B97F4A7C15) + (slot << np.uint64(16)) + token + np.uint64(j + 1)))
    return np.stack(out, axis=1)


def hash_tables(slice_bits: int = 18) -> tuple:
    """A random odd number per byte (0 for gaps between words; A-Z as a-z), powers of
    an odd base and their inverses, as many as a slice has bytes."""
    import numpy as np

    of_byte = np.random.default_rng(2).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    of_byte[65:91] = of_byte[97:123]
    of_byte[[9, 10, 11, 12, 13, 32]] = 0
    return of_byte, _powers(BASE, 1 << slice_bits), _powers(pow(BASE, -1, 1 << 64), 1 << slice_bits)


def _powers(base: int, n: int):
    import numpy as np

    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(raw: bytes, tables: tuple):
    """64-bit hashes of the words of a UTF-8 text in order, A-Z like a-z.

    A word's hash is a polynomial over its bytes, mixed. Long texts are taken in
    slices that end at a gap, so only the hashes grow with the text.
    """
    import numpy as np

    of_byte, powers, inverse = tables
    size, at, out = len(powers), 0, []
    while at < len(raw):
        end = at + size
        if end < len(raw):
            gap = GAP.search(raw, end)
            end = gap.start() if gap else len(raw)
        values = of_byte[np.frombuffer(raw, np.uint8, min(end, len(raw)) - at, at)]
        word = values != 0
        starts = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
        if len(starts):
            up, down = powers, inverse
            if len(values) > len(up):
                up, down = _powers(BASE, len(values)), _powers(pow(BASE, -1, 1 << 64), len(values))
            sums = np.add.reduceat(values * up[: len(values)], starts, dtype=np.uint64)
            out.append(_mix(sums * down[starts]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(raw: bytes, n: int, tables: tuple):
    """The distinct shingles of a text, as sorted 64-bit hashes."""
    import numpy as np

    h = word_hashes(raw, tables)
    if not len(h):
        return h
    width = min(n, len(h))
    least = len(h) - width + 1
    out = h[:least] ^ np.uint64(width)
    for j in range(1, width):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + least])
    return np.unique(out)


def _sketch(slots: int, shingle: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tables = hash_tables()
        for batch in batches:
            n, key, tokens = [], [], []
            for text in batch.column("_s"):
                own = shingle_set(text.as_py() or b"", shingle, tables)
                n.append(len(own))
                key.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                tokens.append(minwise(own, slots).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()),
                 pa.array(key, pa.binary()), pa.array(tokens, pa.binary())],
                names=["doc_id", "th", "n", "key", "tokens"],
            )

    return run


def _matrix(column, slots: int):
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, slots)


def _descend(cfg: NearDup, levels: int, roots: bool):
    """Rows ``(node, key)`` of the paths ``levels`` down from the roots, or further down from ``node``."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            tokens = _matrix(batch.column("tokens"), cfg.slots)
            rows = np.arange(len(tokens))
            if roots:
                nodes, rows = paths(tokens, cfg.trees, levels).reshape(-1), np.repeat(rows, cfg.trees)
            else:
                nodes = batch.column("node").to_numpy().astype(np.int64).view(np.uint64)
                for _ in range(levels):
                    nodes = children(nodes, tokens[rows], cfg.branch).reshape(-1)
                    rows = np.repeat(rows, cfg.branch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes.view(np.int64)), batch.column("key").take(pa.array(rows))], names=["node", "key"]
            )

    return run


def _shares(slots: int):
    """Share of equal tokens of each row's two classes."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            same = (_matrix(batch.column("tokens"), slots) == _matrix(batch.column("_ptokens"), slots)).mean(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("_pivot"), pa.array(same)], names=["key", "pivot", "share"]
            )

    return run


def forest(weight, least: float) -> list:
    """Index pairs of a heaviest spanning forest, of edges of at least ``least``.

    ``weight`` is symmetric; edges of weight 2 join what is joined already.
    """
    import numpy as np

    k, out = len(weight), []
    left, best, source = np.ones(k, bool), np.full(k, -1.0), np.zeros(k, np.int64)
    for _ in range(k):
        v = int(np.argmax(np.where(left, best, -2)))
        if least <= best[v] < 2:
            out.append((int(source[v]), v))
        left[v] = False
        better = left & (weight[v] > best)
        best[better] = weight[v][better]
        source[better] = v
    return out


def _compatible(labels, sizes, percent: int):
    """Which pairs may be links by their sizes, and which have one label."""
    import numpy as np

    _, number = np.unique(labels, return_inverse=True)
    sizes = np.asarray(sizes, np.int64)
    fits = 100 * np.minimum.outer(sizes, sizes) >= percent * np.maximum.outer(sizes, sizes)
    return fits, number[:, None] == number[None, :]


def likely_pairs(labels, sizes, tokens, cfg: NearDup):
    """A spanning forest of a node's index pairs that may be links, of different labels."""
    import numpy as np

    k = len(sizes)
    fits, same = _compatible(labels, sizes, cfg.percent)
    weight = np.zeros((k, k), np.float32)
    step = max(1, (1 << 22) // (k * cfg.slots))
    for at in range(0, k, step):
        equal = tokens[at : at + step, None] == tokens[None, at:]
        weight[at : at + step, at:] = equal.sum(axis=2, dtype=np.uint16) / np.float32(cfg.slots)
    weight = np.maximum(weight, weight.T)
    weight[~fits] = 0
    weight[same] = 2
    return forest(weight, cfg.likely)


def _compare(cfg: NearDup, exact: bool):
    """Pairs of each node; rows come sorted by node, one node is held at a time.

    Exactly, on full sets: links. Else, on tokens: a forest of likely pairs.
    """
    last = "set" if exact else "tokens"

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held, node = [], None

        def done():
            labels = np.array([r[1] for r in held], object)
            if len(held) < 2 or (labels == labels[0]).all():
                return []
            if exact:
                pairs = exact_links(labels, [r[3] for r in held], cfg.percent)
            else:
                tokens = np.frombuffer(b"".join(r[3] for r in held), np.uint16).reshape(-1, cfg.slots)
                pairs = likely_pairs(labels, np.array([r[2] for r in held]), tokens, cfg)
            return [tuple(sorted((held[a][0], held[b][0]))) for a, b in pairs]

        def table(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([x[c] for x in found], pa.binary()) for c in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("node", "key", "label", "n")]
            if exact:
                columns.append([x.values.to_numpy() for x in batch.column(last)])
            else:
                columns.append(batch.column(last).to_pylist())
            for row in zip(*columns, strict=True):
                if row[0] != node:
                    found += done()
                    held, node = [], row[0]
                held.append(row[1:])
            yield table(found)
        yield table(done())

    return run


def exact_links(labels, sets: list, percent: int):
    """Index pairs of linked sets of different labels: a spanning forest of a node's links.

    Intersections of all pairs come from products of 0/1 matrices over the shingles
    that two or more of the sets hold, a few thousand columns at a time.
    """
    import numpy as np

    k = len(sets)
    n = np.array([len(x) for x in sets])
    fits, joined = _compatible(labels, n, percent)
    if not (fits & ~joined).any():
        return []
    flat, owner = np.concatenate(sets), np.repeat(np.arange(k), n)
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    numbers = np.cumsum(times > 1) - 1
    column, owner = numbers[column[shared]], owner[shared]
    both = np.zeros((k, k), np.int32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        lo, hi = np.searchsorted(column, [at, at + 4096])
        m = np.zeros((k, 4096), np.float32)
        m[owner[lo:hi], column[lo:hi] - at] = 1
        both += (m @ m.T).astype(np.int32)
    union = n[:, None] + n[None, :] - both
    weight = (fits & (100 * both.astype(np.int64) >= percent * union)).astype(np.float32)
    weight[joined] = 2
    return forest(weight, 1)


# --- the join ----------------------------------------------------------------------


class _Join:
    def __init__(self, docs: DataFrame, cfg: NearDup):
        self.docs, self.cfg, self.spark = docs, cfg, docs.sparkSession
        self.sketches = materialise(
            docs.select("doc_id", F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("_s"))
            .mapInArrow(_sketch(cfg.slots, cfg.shingle), "doc_id long, th long, n long, key binary, tokens binary"),
            "sketches",
        )
        one = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("th").alias("th"))
        self.classes = materialise(
            self.sketches.filter("n > 0").groupBy("key")
            .agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.min(one).alias("one")),
            "classes",
        )
        self.sets: DataFrame | None = None
        self.links: DataFrame | None = None
        self.tried: DataFrame | None = None
        self.labels: DataFrame | None = None

    def _keep_sets(self, keys: DataFrame) -> None:
        """Full sets of the classes that share a node with others; the text moves once."""
        chosen = keys.select(F.col("key").alias("_k")).distinct().join(self.classes, F.col("_k") == F.col("key")).select(
            "key", F.col("one.id").alias("_i"), F.col("one.th").alias("_t")
        )
        text = self.docs.select(F.col("doc_id").alias("_d"), F.xxhash64("text").alias("_x"), "text")
        rows = text.join(
            chosen.hint("shuffle_hash"), F.col("_d").eqNullSafe(F.col("_i")) & (F.col("_x") == F.col("_t"))
        )
        # rows equal in id and text give the same set
        self.sets = materialise(
            rows.select("key", F.array_distinct(shingles(F.col("text"), self.cfg.shingle)).alias("set"))
            .dropDuplicates(["key"]),
            "sets",
        )

    def _confirm(self, pairs: DataFrame) -> None:
        """Test candidate pairs ``(a, b)`` on full sets; update links and labels."""
        new = pairs.select("a", "b").filter("a <> b").distinct()
        if self.tried is not None:
            old = self.tried.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
            new = new.join(old, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left_anti")
        left = self.sets.select(F.col("key").alias("_k1"), F.col("set").alias("_s1"))
        right = self.sets.select(F.col("key").alias("_k2"), F.col("set").alias("_s2"))
        both = F.size(F.array_intersect("_s1", "_s2"))
        tested = materialise(
            new.join(right, F.col("b") == F.col("_k2")).join(left, F.col("a") == F.col("_k1")).select(
                "a", "b",
                (100 * both >= self.cfg.percent * (F.size("_s1") + F.size("_s2") - both)).alias("linked"),
            ),
            "tested",
        )
        self.tried = tested if self.tried is None else self.tried.unionByName(tested)
        links = self.tried.filter("linked").select("a", "b")
        self.labels = components(links)

    def _labelled(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the component's ``label`` of each key."""
        if self.labels is None:
            return rows.withColumn("label", F.col("key"))
        known = self.labels.select(F.col("vertex").alias("_v"), F.col("least").alias("_l"))
        return rows.join(known, F.col("key") == F.col("_v"), "left").withColumn(
            "label", F.coalesce("_l", "key")
        ).drop("_v", "_l")

    def _with_tokens(self, rows: DataFrame) -> DataFrame:
        own = self.classes.select(F.col("key").alias("_ck"), "n", "tokens")
        return rows.join(own, F.col("key") == F.col("_ck")).drop("_ck")

    def _sorted(self, rows: DataFrame) -> DataFrame:
        return rows.repartition("node").sortWithinPartitions("node", "key")

    @staticmethod
    def _sizes(rows: DataFrame) -> DataFrame:
        """``_node, _n``: nodes of two classes or more; of nodes with equal members, one."""
        return (
            rows.groupBy("node")
            .agg(F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64("key")).alias("_members"))
            .filter("_n > 1").groupBy("_n", "_members").agg(F.min("node").alias("_node"))
            .select("_node", "_n")
        )

    def _split(self, rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """The rows of small and of large nodes; single and repeated nodes are left out."""
        sized = materialise(
            rows.join(self._sizes(rows), F.col("node") == F.col("_node")).select("node", "key", "_n"), name
        )
        small = sized.filter(F.col("_n") <= self.cfg.leaf).select("node", "key")
        return small, sized.filter(F.col("_n") > self.cfg.leaf).select("node", "key")

    def _open(self, rows: DataFrame) -> DataFrame:
        """Rows of the nodes whose classes are not all of one component, with labels."""
        labelled = self._labelled(rows)
        mixed = labelled.groupBy(F.col("node").alias("_node")).agg(
            F.min("label").alias("_lo"), F.max("label").alias("_hi")
        ).filter("_lo <> _hi").select("_node")
        return labelled.join(mixed, F.col("node") == F.col("_node")).drop("_node")

    def _best_pivots(self, large: DataFrame, pivots: DataFrame) -> DataFrame:
        """Of each class the likeliest of the pivots of all its nodes, one pair a class.

        This only joins groups early; what it passes over is compared later.
        """
        near = (
            large.join(pivots, F.col("node") == F.col("_node"))
            .select("key", F.explode("_pivots").alias("_pivot")).filter("key <> _pivot").distinct()
        )
        own = self.classes.select(F.col("key").alias("_pk"), F.col("tokens").alias("_ptokens"))
        both = self._with_tokens(near).join(own, F.col("_pivot") == F.col("_pk"))
        shares = both.select("key", "_pivot", "tokens", "_ptokens").mapInArrow(
            _shares(self.cfg.slots), "key binary, pivot binary, share double"
        )
        return (
            shares.groupBy("key").agg(F.max(F.struct("share", "pivot")).alias("_best"))
            .filter(F.col("_best.share") >= self.cfg.likely)
            .select(F.least("key", "_best.pivot").alias("a"), F.greatest("key", "_best.pivot").alias("b"))
        )

    def _near_done(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Open rows ``(node, key, label)`` of large nodes, as blocks and as rows to branch.

        Where few classes are not of the node's largest component, each block holds a
        share of that component and all the others. Pairs inside the component need no
        comparing, so the work is in proportion to the node.
        """
        leaf = self.cfg.leaf
        by_label = rows.groupBy(F.col("node").alias("_node"), F.col("label").alias("_label")).agg(
            F.count(F.lit(1)).alias("_k")
        )
        most = by_label.groupBy("_node").agg(
            F.max(F.struct("_k", "_label")).alias("_most"), F.sum("_k").alias("_all")
        ).select("_node", "_most._k", "_most._label", "_all")
        sized = materialise(rows.join(most, F.col("node") == F.col("_node")), "open")
        few = F.col("_all") - F.col("_k") <= leaf
        parts = F.ceil(F.col("_k") / leaf).cast("int")
        own = F.pmod(F.xxhash64("key"), parts).cast("int")
        block = F.when(F.col("label") == F.col("_label"), F.array(own)).otherwise(
            F.sequence(F.lit(0), parts - 1)
        )
        blocks = sized.filter(few).select("node", "key", F.explode(block).alias("_block")).select(
            F.xxhash64("node", "_block", F.lit("few")).alias("node"), "key"
        )
        return blocks, sized.filter(~few).select("node", "key")

    def _blocks(self, rows: DataFrame) -> DataFrame:
        """All pairs of blocks of each large node, as nodes of at most about two leaves."""
        half = max(1, self.cfg.leaf // 2)
        counts = rows.groupBy(F.col("node").alias("_node")).agg(
            F.ceil(F.count(F.lit(1)) / half).cast("int").alias("_m")
        )
        own = rows.join(counts, F.col("node") == F.col("_node")).withColumn(
            "_block", F.pmod(F.xxhash64("key"), F.col("_m")).cast("int")
        )
        other = F.explode(F.sequence(F.lit(0), F.col("_m") - 1))
        return own.select("node", "key", "_block", other.alias("_other")).select(
            F.xxhash64("node", F.least("_block", "_other"), F.greatest("_block", "_other")).alias("node"), "key"
        )

    def run(self) -> None:
        cfg = self.cfg
        rows = materialise(
            self.classes.select("key", "tokens").mapInArrow(
                _descend(cfg, cfg.depth, True), "node long, key binary"
            ),
            "nodes",
        )
        small, large = self._split(rows, "sized")
        self._keep_sets(small.unionByName(large).select("key"))
        leaves, depth = [small], cfg.depth
        while not large.isEmpty():
            # the same order in all nodes: the nodes that a group meets in mostly put up the same pivots
            first = [F.min(F.struct(F.xxhash64("key", F.lit(i)), F.col("key")))["key"] for i in range(cfg.pivots)]
            pivot = large.groupBy(F.col("node").alias("_node")).agg(F.array(*first).alias("_pivots"))
            self._confirm(self._best_pivots(large, pivot))
            blocks, wide = self._near_done(self._open(large))
            leaves.append(blocks)
            if depth == cfg.deepest:
                leaves.append(self._blocks(wide))
                break
            below = self._with_tokens(wide).select("node", "key", "tokens").mapInArrow(
                _descend(cfg, 1, False), "node long, key binary"
            )
            small, large = self._split(materialise(below.distinct(), "nodes"), "sized")
            leaves.append(small)
            depth += 1
        every = leaves[0]
        for more in leaves[1:]:
            every = every.unionByName(more)
        likely = self._sorted(self._with_tokens(self._open(every))).select(
            "node", "key", "label", "n", "tokens"
        ).mapInArrow(_compare(cfg, False), "a binary, b binary")
        self._confirm(likely)
        own = self.sets.select(F.col("key").alias("_k"), "set")
        rest = self._open(every).join(own, F.col("key") == F.col("_k"))
        exact = self._sorted(rest.withColumn("n", F.size("set"))).select(
            "node", "key", "label", "n", "set"
        ).mapInArrow(_compare(cfg, True), "a binary, b binary")
        more = materialise(exact.distinct(), "links")
        self.labels = components(self.tried.filter("linked").select("a", "b").unionByName(more))

    def result(self) -> DataFrame:
        """``doc_id, th, n_shingles, component_id, kept`` and ``first``: whether the row has the
        least id, then text hash, of its component (a text without shingles is its own)."""
        named = self._labelled(self.classes.select("key", "one"))
        least = named.groupBy(F.col("label").alias("_l")).agg(F.min("one").alias("_least"))
        of_class = named.join(least, F.col("label") == F.col("_l")).select(
            F.col("key").alias("_k"), F.col("_least.id").alias("_component"), F.col("_least.th").alias("_least_th")
        )
        return self.sketches.join(of_class, F.col("key") == F.col("_k"), "left").select(
            "doc_id", "th", F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("_component")).otherwise(F.col("doc_id")).alias("component_id"),
            F.when(F.col("n") > 0, F.col("th") == F.col("_least_th")).otherwise(True).alias("_least_text"),
        ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
            "doc_id", "th", "n_shingles", "component_id", "kept", (F.col("kept") & F.col("_least_text")).alias("first")
        )


def near_duplicates(docs: DataFrame, cfg: NearDup = NearDup()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    join = _Join(docs, cfg)
    join.run()
    return join.result().drop("th", "first")


def distinct_documents(docs: DataFrame, cfg: NearDup = NearDup()) -> DataFrame:
    """One document of each component, in the columns they came with: that of the least id,
    NULL last, then of the least text hash; of rows equal in both, one."""
    join = _Join(docs, cfg)
    join.run()
    kept = join.result().filter("first").select(F.col("doc_id").alias("_kid"), F.col("th").alias("_kth")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"))
    return (
        rows.join(
            kept.hint("shuffle_hash"),
            F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_th") == F.col("_kth")),
        )
        .dropDuplicates(["_id", "_th"]).select("_row.*")
    )
