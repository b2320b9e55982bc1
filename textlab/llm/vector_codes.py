"""Operator 11: vector codes over integers, with distances taken in the Walsh-Hadamard domain.

Components become integers ``floor(scale * x)``; a vector is cut into ``parts`` equal
consecutive parts and each part is replaced by the number of its codebook's nearest
entry. Parts and entries are zero-padded to a power of two ``m`` and transformed by the
integer Walsh-Hadamard matrix, which multiplies every squared distance by exactly ``m``.
Squared differences of coefficients are added in sequency order (fewest sign changes
first): after the first ones the entry that leads gets its whole distance as a bound, and
every entry whose sum already exceeds the bound leaves. Ties with the bound stay, so the
result, the least distance and the least index at it, is exact; no floating point is
used after the first floor.

What moves: each round one pass over the vectors without a shuffle of theirs; a task adds up
its parts by entry and sends at most ``parts * entries`` sums. Codebooks (``parts *
entries`` short vectors) pass the driver. Errors by label are pre-aggregated and joined
back; the label's side is salted over ``SALTS`` rows, so a label that holds a
third of all rows is spread over as many tasks.

Defined cases: vectors that are NULL or hold NULL or non-finite components are dropped.
Shorter vectors are zero-padded to the longest one, and all to a multiple of ``parts``, so
empty vectors are zero vectors. Ids may repeat (each row gets its code) or be NULL; the
first codebook takes rows by id, NULL last, then by vector. With fewer than ``entries``
rows the codebooks have as many entries as there are rows. An empty table gives an empty
result. Extra columns are ignored. Components whose scaled size reaches ``2 ** 30 / m`` are
an error: the sums would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.common import materialise

SALTS = 16
#: Rows whose distances one step holds: rows * parts * entries numbers.
STEP_ROWS = 2048


@dataclass(frozen=True)
class VectorCodes:
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


def hadamard(m: int) -> Any:
    """The Walsh-Hadamard matrix of a power of two, rows by their number of sign changes."""
    import numpy as np

    h = np.ones((1, 1), np.int64)
    while len(h) < m:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1))]


def _padded(width: int) -> int:
    return 1 << max(0, (width - 1).bit_length())


def _transformed(parts: Any) -> Any:
    """Coefficients of the last axis in sequency order, after padding it with zeros."""
    import numpy as np

    width = parts.shape[-1]
    m = _padded(width)
    padded = np.zeros((*parts.shape[:-1], m), np.int64)
    padded[..., :width] = parts
    return padded @ hadamard(m).T


def nearest_entries(parts: Any, books: Any) -> tuple[Any, Any]:
    """Index and squared distance of the nearest entry: ``parts`` (rows, parts, width) against
    ``books`` (parts, entries, width), ties to the lower index."""
    import numpy as np

    rows, n_parts, _ = parts.shape
    x, c = _transformed(parts), _transformed(books)
    m, entries = x.shape[-1], c.shape[1]
    lead = max(1, m // 4)
    total = np.zeros((rows, n_parts, entries), np.int64)
    for j in range(lead):
        total += (x[:, :, None, j] - c[None, :, :, j]) ** 2
    # the leader's whole distance bounds what the others may reach
    first = total.argmin(axis=2)
    chosen = c[np.arange(n_parts)[None, :], first]
    bound = ((x - chosen) ** 2).sum(axis=2)
    row, part, entry = np.nonzero(total <= bound[:, :, None])
    sums = total[row, part, entry]
    for j in range(lead, m):
        sums += (x[row, part, j] - c[part, entry, j]) ** 2
        alive = sums <= bound[row, part]
        row, part, entry, sums = row[alive], part[alive], entry[alive], sums[alive]
    # survivors come by (row, part, entry): the first of the least is the lowest index
    group = row * n_parts + part
    order = np.lexsort((entry, sums, group))
    starts = order[np.unique(group[order], return_index=True)[1]]
    return entry[starts].reshape(rows, n_parts), (sums[starts] // m).reshape(rows, n_parts)


def _integers(batch: Any, cfg: VectorCodes, width: int) -> Any:
    """(rows, parts, width) integers of a batch's vectors, zero-padded."""
    import numpy as np
    import pyarrow.compute as pc

    vectors = batch.column("vec")
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * cfg.scale)
    limit = (1 << 30) // _padded(width)
    if len(flat) and np.abs(flat).max() >= limit:
        raise ValueError(f"a component's scaled size reaches {limit}")
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(sizes), cfg.parts * width), np.int64)
    out[row, np.arange(len(flat)) - starts[row]] = flat
    return out.reshape(len(sizes), cfg.parts, width)


def _steps(batches: Iterator, cfg: VectorCodes, width: int) -> Iterator:
    for batch in batches:
        for at in range(0, batch.num_rows, STEP_ROWS):
            step = batch.slice(at, STEP_ROWS)
            yield step, _integers(step, cfg, width)


def _sums(books: Any, cfg: VectorCodes, width: int):
    """One row a used entry of the task: its parts' number and componentwise sums."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        count = np.zeros(books.shape[:2], np.int64)
        total = np.zeros(books.shape, np.int64)
        for _, parts in _steps(batches, cfg, width):
            entry, _ = nearest_entries(parts, books)
            part = np.broadcast_to(np.arange(cfg.parts), entry.shape)
            np.add.at(count, (part, entry), 1)
            np.add.at(total, (part, entry), parts)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry], pa.int64()),
                pa.array(list(total[part, entry]), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    return run


def _codes(books: Any, cfg: VectorCodes, width: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for step, parts in _steps(batches, cfg, width):
            entry, error = nearest_entries(parts, books)
            codes = ["".join(f"{e:02x}" for e in row) for row in entry.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    step.column("vec_id"), step.column("label"), pa.array(codes, pa.string()),
                    pa.array(error.sum(axis=1).astype(np.int64), pa.int64()),
                ],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def finite_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, vec`` of the rows that take part, components as doubles."""
    vec = F.col("embedding").cast("array<double>")
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embeddings.select("vec_id", "label", vec.alias("vec")).filter(F.col("vec").isNotNull() & ~odd)


def fit(vectors: DataFrame, cfg: VectorCodes = VectorCodes()) -> Any:
    """Codebooks as integers (parts, entries, width); None for an empty table."""
    import numpy as np
    import pyarrow as pa

    longest = vectors.agg(F.max(F.size("vec"))).first()[0]
    if longest is None:
        return None
    width = -(-longest // cfg.parts)
    head = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(cfg.entries).select("vec").collect()
    first = pa.RecordBatch.from_arrays([pa.array([r[0] for r in head], pa.list_(pa.float64()))], names=["vec"])
    books = np.ascontiguousarray(_integers(first, cfg, width).swapaxes(0, 1))
    for _ in range(cfg.rounds):
        sums = (
            vectors.select("vec")
            .mapInArrow(_sums(books, cfg, width), "part int, entry int, n long, sums array<long>")
            .select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
            .groupBy("part", "entry", "at")
            .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        )
        books = books.copy()
        for r in sums.collect():  # at most one row a component of the codebooks
            books[r["part"], r["entry"], r["at"]] = int(r["s"]) // r["n"]
    return books


def codebooks_digest(books: Any) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, books: Any, cfg: VectorCodes = VectorCodes()) -> DataFrame:
    """``vec_id, label, code, error`` of ``vectors(vec_id, label, vec)``."""
    kind = dict(vectors.dtypes)
    schema = f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long"
    return vectors.select("vec_id", "label", "vec").mapInArrow(_codes(books, cfg, books.shape[2]), schema)


def compress(embeddings: DataFrame, cfg: VectorCodes = VectorCodes()) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector that takes part."""
    vectors = finite_vectors(embeddings)
    books = fit(vectors, cfg)
    if books is None:
        empty = vectors.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.select(
            "*", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256")
        ).limit(0)
    coded = materialise(encode(vectors, books, cfg), "codes")
    by_label = (
        coded.groupBy("label").agg(F.sum("error").alias("label_error"))
        .select(
            F.col("label").alias("_label"), "label_error",
            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
        )
    )
    salt = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")
    return (
        coded.withColumn("_s", salt)
        .join(by_label, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_s") == F.col("_salt")))
        .select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
    )
