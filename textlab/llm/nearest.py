"""Operator 8: exact nearest neighbours by a block matrix join of int8 tiles.

Queries and candidates are dealt into blocks by a hash of their id; every (query
block, candidate block) pair is one tile and one task's work. A tile multiplies
int8-quantised vectors, bounds each product's error by the norms of what
quantisation cut off, keeps the pairs whose upper bound reaches the k-th best
lower bound, and recomputes these in float64 on the original vectors. Each tile's
k best a query then meet in heaps of k.

The result is exact: the bounds only skip pairs that cannot be among the k best.

Defined cases: vectors that are NULL, zero, or hold a NULL or non-finite component
take no part; vectors of different length are not compared. ``vec_id`` is the
key: of repeated ids the smallest vector counts, rows with a NULL id take no part.
Fewer than k candidates: all are returned. Ties go to the smaller id. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERY_BLOCK, CANDIDATE_BLOCK = 512, 4096
#: Up to here a float32 matrix product of int8 values is exact.
EXACT_DIM = 1024
SCHEMA = "query_id long, vec_id long, score double"


def _quantised(x):
    """int8 values as float32, scale, and norms of the vector, its image and the rest."""
    import numpy as np

    scale = np.abs(x).max(axis=1) / 127.0
    q = np.rint(x / scale[:, None])
    image = q * scale[:, None]
    norm = lambda a: np.sqrt((a * a).sum(axis=1))
    return q.astype(np.int8), scale, norm(x), norm(image), norm(x - image)


def _products(a, b):
    import numpy as np

    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DIM):
        part = slice(at, at + EXACT_DIM)
        total += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return total


def search_tile(qid, q, cid, c, k: int):
    """The k best candidates of each query of a tile: lists of query ids, ids, scores."""
    import numpy as np

    qq, qs, qn, _, qe = _quantised(q)
    cq, cs, cn, ci, ce = _quantised(c)
    near = _products(qq, cq) * qs[:, None] * cs[None, :]
    # x.y = x'.y' + ex.y' + x.ey, and a little for the rounding of these numbers
    slack = (qe[:, None] * ci[None, :] + qn[:, None] * ce[None, :]) + 1e-9 * qn[:, None] * cn[None, :]
    out_q, out_c, out_s = [], [], []
    for i in range(len(qid)):
        other = cid != qid[i]
        low = np.where(other, near[i] - slack[i], -np.inf)
        cut = np.partition(low, len(low) - k)[len(low) - k] if len(low) > k else -np.inf
        alive = np.flatnonzero(other & ~(near[i] + slack[i] < cut))
        exact = np.einsum("ij,j->i", c[alive], q[i])
        best = np.lexsort((cid[alive], -exact))[:k]
        out_q.append(np.full(len(best), qid[i]))
        out_c.append(cid[alive][best])
        out_s.append(exact[best])
    return out_q, out_c, out_s


def _tile(k: int):
    def run(_, queries, candidates):
        import numpy as np
        import pandas as pd

        if not len(queries) or not len(candidates):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64"}
            )
        parts = search_tile(
            queries["vec_id"].to_numpy("int64"), np.stack(queries["vec"].to_numpy()).astype(np.float64),
            candidates["vec_id"].to_numpy("int64"), np.stack(candidates["vec"].to_numpy()).astype(np.float64), k,
        )
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, parts), strict=True)))

    return run


def _merge(k: int):
    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        heaps: dict[int, list] = {}
        for b in batches:
            for q, v, s in zip(b["query_id"].tolist(), b["vec_id"].tolist(), b["score"].tolist(), strict=True):
                heap = heaps.setdefault(q, [])
                if len(heap) < k:
                    heapq.heappush(heap, (s, -v))
                elif (s, -v) > heap[0]:
                    heapq.heapreplace(heap, (s, -v))
        rows = [
            (q, rank, -v, s)
            for q, heap in heaps.items()
            for rank, (s, v) in enumerate(sorted(heap, reverse=True), 1)
        ]
        yield pd.DataFrame(rows, columns=["query_id", "rank", "vec_id", "score"]).astype(
            {"query_id": "int64", "rank": "int32", "vec_id": "int64", "score": "float64"}
        )

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vec``: the vectors that take part, one row an id."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select("vec_id", "embedding")
        .filter(F.col("vec_id").isNotNull() & v.isNotNull())
        .filter(finite & F.exists(v, lambda x: x != 0))
        .groupBy("vec_id").agg(F.min(F.col("embedding").cast("array<double>")).alias("vec"))
    )


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest by inner product.

    ``is_query`` picks the queries from ``vec_id``. Tiles hold about 512 queries and
    4,096 candidates at any table size.
    """
    rows = usable(vectors).withColumn("dim", F.size("vec"))
    n, n_q = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(is_query.cast("long")), F.lit(0))).first()
    q_blocks, c_blocks = max(1, -(-n_q // QUERY_BLOCK)), max(1, -(-n // CANDIDATE_BLOCK))
    own = lambda m: F.pmod(F.xxhash64("vec_id"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    queries = rows.filter(is_query).select("vec_id", "vec", "dim", own(q_blocks).alias("qb")).select(
        "*", every(c_blocks).alias("cb")
    )
    candidates = rows.select("vec_id", "vec", "dim", own(c_blocks).alias("cb")).select(
        "*", every(q_blocks).alias("qb")
    )
    found = (
        queries.groupBy("qb", "cb", "dim").cogroup(candidates.groupBy("qb", "cb", "dim"))
        .applyInPandas(_tile(k), SCHEMA)
    )
    merged = found.repartition("query_id").mapInPandas(
        _merge(k), "query_id long, rank int, vec_id long, score double"
    )
    return merged
