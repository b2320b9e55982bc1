"""Operator 5: supervised subword embeddings for document quality.

A document is the average of learned vectors of its hashed words and byte 3- and
4-grams inside words (word ends marked), whole texts throughout; a softmax over
two classes reads the average. Training is stochastic gradient descent in numpy, in
one task, on a bounded sample of labelled documents: the ``sample`` smallest by a
hash of ``doc_id``, of repeated ids the text of the least hash that has a word. What
reaches that task is each sampled document's distinct bucket numbers and shares, at
most ``2 ** bits`` of them, once an id. The model (``2 ** bits`` by
``dim`` numbers) is all that passes the driver; executors score Arrow batches
with one number a bucket, as the average and the softmax are linear up to the end.

Defined cases: a NULL or empty text has no features and gets the score of the bias
alone. Labels that are NULL, other than 0 or 1, or contradict each other for one id
are not learned from; without labels of both classes every score is the share of
label 1 (0.5 without any). Repeated rows are scored one by one. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Trainer:
    """``sample`` bounds the labelled rows the model is fitted on."""

    sample: int = 6144
    bits: int = 17
    dim: int = 16
    epochs: int = 4
    rate: float = 1.0
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """``vectors`` of the buckets, ``readout`` (2 x dim) and ``bias`` of the softmax."""

    vectors: object
    readout: object
    bias: object
    bits: int

    def margins(self):
        """Of each bucket what it adds to the log odds of label 1."""
        import numpy as np

        return (self.vectors @ (self.readout[1] - self.readout[0])).astype(np.float64)

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def features(text: str, bits: int):
    """Bucket numbers of all words and their byte 3- and 4-grams."""
    import numpy as np

    raw = np.frombuffer(b" " + text.encode("utf-8", "replace") + b" ", np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    b = np.where(blank, 32, raw).astype(np.uint32)
    shift = np.uint32(32 - bits)
    mix = np.uint32(2654435761)
    found = []
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    if len(starts):
        word_no = np.cumsum(blank[:-1] & ~blank[1:])
        inside = np.flatnonzero(~blank)
        offset = inside - starts[word_no[inside - 1] - 1]
        powers = np.cumprod(np.full(64, 31, np.uint32), dtype=np.uint32)
        parts = (b[inside] + np.uint32(1)) * powers[offset & 63] + offset.astype(np.uint32)
        firsts = np.searchsorted(inside, starts)
        h = np.add.reduceat(parts, firsts, dtype=np.uint32)
        h ^= h >> np.uint32(15)
        found.append((h * mix) >> shift)
        if len(b) >= 3:
            h = (b[:-2] * np.uint32(961) + b[1:-1] * np.uint32(31) + b[2:]) * np.uint32(0x85EBCA6B)
            h = h[~blank[1:-1]]
            h ^= h >> np.uint32(13)
            found.append((h * mix) >> shift)
        if len(b) >= 4:
            h = (b[:-3] * np.uint32(29791) + b[1:-2] * np.uint32(961) + b[2:-1] * np.uint32(31) + b[3:])
            h = (h * np.uint32(0xC2B2AE35))[~(blank[1:-2] | blank[2:-1])]
            h ^= h >> np.uint32(14)
            found.append((h * mix) >> shift)
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


def fit_numpy(examples: list, labels: list[int], cfg: Trainer) -> Model:
    """SGD over ``examples`` of (bucket numbers, shares); one epoch is one shuffled pass."""
    import numpy as np

    rng = np.random.default_rng(cfg.seed)
    vectors = rng.uniform(-1, 1, (1 << cfg.bits, cfg.dim)).astype(np.float32) / cfg.dim
    readout = np.zeros((2, cfg.dim), np.float32)
    ones = sum(labels)
    if not labels:
        prior = 0.5
    else:
        prior = ones / len(labels)
    edge = 1e-6
    logit = float(np.log(max(prior, edge) / max(1 - prior, edge)))
    bias = np.array([-logit / 2, logit / 2], np.float32)
    if 0 < ones < len(labels):
        readout = rng.uniform(-1, 1, readout.shape).astype(np.float32)
        steps, total = 0, cfg.epochs * len(labels)
        for _ in range(cfg.epochs):
            for i in rng.permutation(len(labels)):
                rate = np.float32(cfg.rate * (1 - steps / total))
                ids, share = examples[i]
                rows = vectors[ids]
                hidden = share @ rows
                z = readout @ hidden + bias
                p = np.exp(z - z.max())
                p /= p.sum()
                p[labels[i]] -= 1
                back = p @ readout
                readout -= rate * np.outer(p, hidden)
                bias -= np.float32(0.05) * rate * p
                # the average spreads the step over all features; the largest share scales it back
                vectors[ids] = rows - (rate / share.max()) * np.outer(share, back) * np.float32(0.05)
                steps += 1
    return Model(vectors, readout, bias, cfg.bits)


def _featurise(bits: int):
    """Features of each row; of rows of one id, all of one text, the first in the task."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        seen = set()
        for batch in batches:
            new = []
            for i, d in enumerate(batch.column("doc_id").to_pylist()):
                if d not in seen:
                    seen.add(d)
                    new.append(i)
            batch = batch.take(pa.array(new, pa.int64()))
            ids, shares = [], []
            for t in batch.column("text"):
                found, n = np.unique(features(t.as_py(), bits), return_counts=True)
                ids.append(found.astype(np.int32).tobytes())
                shares.append((n / max(1, n.sum())).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())],
                names=["doc_id", "label", "ids", "shares"],
            )

    return run


def _train(cfg: Trainer):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        rows = []
        for b in batches:
            for d, y, i, s in zip(*(b.column(c).to_pylist() for c in ("doc_id", "label", "ids", "shares")), strict=True):
                if i:
                    rows.append((d, y, i, s))
        rows.sort()
        examples = [(np.frombuffer(i, np.int32), np.frombuffer(s, np.float32)) for _, _, i, s in rows]
        m = fit_numpy(examples, [y for _, y, _, _ in rows], cfg)
        blobs = [[x.astype(np.float32).tobytes()] for x in (m.vectors, m.readout, m.bias)]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in blobs], names=["v", "r", "b"])

    return run


def fit(docs: DataFrame, labels: DataFrame, cfg: Trainer = Trainer()) -> Model:
    """``labels(doc_id, label)``: the rows that may be learned from."""
    import numpy as np

    clean = (
        labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_other"))
        .filter("label = _other")
    )
    sample = clean.orderBy(F.xxhash64("doc_id"), "doc_id").limit(cfg.sample).select(
        F.col("doc_id").alias("_id"), F.col("label").cast("int").alias("label")
    )
    # the sample has at most cfg.sample rows of two numbers
    chosen = docs.select("doc_id", "text").filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).join(
        F.broadcast(sample), F.col("doc_id") == F.col("_id")
    ).select("doc_id", "label", "text", F.xxhash64("text").alias("_th"))
    # one text a sampled id, by two numbers a row; the rows of that text are reduced before they move
    least = chosen.groupBy(F.col("doc_id").alias("_lid")).agg(F.min("_th").alias("_lth"))
    rows = (
        chosen.join(F.broadcast(least), (F.col("doc_id") == F.col("_lid")) & (F.col("_th") == F.col("_lth")))
        .select("doc_id", "label", "text")
        .mapInArrow(_featurise(cfg.bits), "doc_id long, label int, ids binary, shares binary")
        .dropDuplicates(["doc_id"])
    )
    one = rows.repartition(1).mapInArrow(_train(cfg), "v binary, r binary, b binary").collect()
    if not one:
        return fit_numpy([], [], cfg)
    vectors, readout, bias = (np.frombuffer(x, np.float32) for x in one[0])
    return Model(vectors.reshape(-1, cfg.dim), readout.reshape(2, -1), bias, cfg.bits)


def _scorer(margins, offset: float, bits: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            odds = np.full(batch.num_rows, offset)
            for i, t in enumerate(batch.column("text")):
                found = features(t.as_py() or "", bits)
                if len(found):
                    odds[i] += margins[found].mean()
            score = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score)],
                names=["doc_id", "held_out", "score"],
            )

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        _scorer(model.margins(), model.offset(), model.bits), "doc_id long, held_out boolean, score double"
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
