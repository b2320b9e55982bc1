"""Operator 9: token counts through a digest cache.

A document's content digest is the SHA-256 of its text (NULL counts as ''); the
tokenizer's digest covers its file and library version. Counts are looked up in
a Parquet cache by both digests. One document of each missing content is
encoded, in Arrow batches on the executors, and appended to the cache; all
documents then take their count from it.

Only digests are grouped, with map-side pre-aggregation, so a text that a third
of the rows share is one row a task there. Texts move once, joined by document id
to the contents that are missing.

Defined cases: NULL and '' have no tokens. Repeated rows each get a row. An
empty table gives an empty result and appends nothing. A NULL doc_id is kept.
Batches hold at most ``BATCH_CHARS`` characters or one text. Extra columns are
ignored. A cache that two runs filled at once may hold a key twice, with the
same count; a lookup takes it once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.llm.common import materialise

BATCH_CHARS = 1 << 20
_LOADED: dict[str, object] = {}


def _counter(path: str):
    """``list of texts -> list of counts``; a worker loads the file once."""
    if path not in _LOADED:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _LOADED[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            _LOADED[path] = lambda texts: [
                len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)
            ]
    return _LOADED[path]


def tokenizer_digest(path: str) -> str:
    import sentencepiece
    import tokenizers

    library = sentencepiece if path.endswith(".model") else tokenizers
    with open(path, "rb") as f:
        body = hashlib.sha256(f.read()).hexdigest()
    return hashlib.sha256(f"{library.__name__} {library.__version__} {body}".encode()).hexdigest()


def _encode(path: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        count = _counter(path)
        for batch in batches:
            texts = batch.column("text")
            counts: list[int] = []
            part: list[str] = []
            chars = 0
            for t in texts:
                t = t.as_py()
                if part and chars + len(t) > BATCH_CHARS:
                    counts += count(part)
                    part, chars = [], 0
                part.append(t)
                chars += len(t)
            counts += count(part) if part else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array(counts, pa.int64())], names=["content", "n_tokens"]
            )

    return run


def _cached(spark: SparkSession, path: str, tokenizer: str) -> DataFrame | None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    cache = spark.read.schema("content string, tokenizer string, n_tokens long").parquet(path)
    return (
        cache.filter(F.col("tokenizer") == tokenizer)
        .groupBy("content").agg(F.max("n_tokens").alias("_n"))
        .withColumnRenamed("content", "_c")
    )


def token_counts(docs: DataFrame, model_path: str, cache_path: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document; fills ``cache_path``."""
    spark = docs.sparkSession
    version = tokenizer_digest(model_path)
    text = F.coalesce(F.col("text"), F.lit(""))
    digests = materialise(
        docs.select(
            "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("content")
        ),
        "token-digests",
    )
    contents = digests.groupBy("content").agg(F.min_by("doc_id", F.struct("doc_id")).alias("_id"))
    stored = _cached(spark, cache_path, version)
    if stored is not None:
        contents = contents.join(stored, F.col("content") == F.col("_c"), "left_anti")
    wanted = contents.select(F.col("_id"), F.col("content").alias("_content"))
    misses = (
        docs.select("doc_id", text.alias("text"), F.sha2(text, 256).alias("content"))
        .join(
            wanted.hint("shuffle_hash"),
            F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content")),
        )
        .select("content", "text")
    )
    fresh = misses.mapInArrow(_encode(model_path), "content string, n_tokens long")
    fresh.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    counts = _cached(spark, cache_path, version)
    return digests.join(counts, F.col("content") == F.col("_c"), "left").select(
        "doc_id", "n_bytes", F.col("_n").alias("n_tokens"), (F.col("_n") > limit).alias("over_limit")
    )
