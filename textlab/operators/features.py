"""Term-keyed text features: exact TF-IDF, capped vocabularies, sublinear / L2 weights.

These compute what ``HashingTF + IDF`` approximates, keyed by the term itself
(no hash collisions, inspectable, checkable in SQL), as Spark joins and
aggregates:

* ``(doc, term)`` pairs are counted by a hash aggregate on both columns with
  map-side partial aggregation, so neither a common term nor a document id shared
  by many rows lands in one task; per-document norms are aggregates joined back;
* document frequencies are a ``groupBy(term)`` whose partial aggregation folds a
  hot term (say, present in a third of all documents) to one row per task before
  the shuffle;
* the document-frequency table grows with the vocabulary, so it is never
  broadcast by hint: AQE switches to a broadcast only when the measured table is
  small, and otherwise splits skewed term partitions of the sort-merge join;
* a capped vocabulary (``max_features``) has a proven size bound and is broadcast.

The document count N is the document frequency of a per-document marker row,
read as a scalar subquery (one value, no driver round trip) over the same
aggregation. The term-count table is written once (see :func:`materialized`), so the
text is cleaned, tokenised and counted once however many branches read it.

The mirror's weights shuffle no (id, term) pairs: rows are counted where they are, and
only each batch's distinct terms with their counts are shuffled.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.functions.tokens import unigrams_and_bigrams
from textlab.session import scratch_path

# executors need not have this package: its functions travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values ----------------------------------------------------------------
DEFAULT_VOCAB_SIZE = 1 << 16
DEFAULT_MIN_DF = 2
SLICE_TOKENS = 1 << 21  # of the rows that are counted at once
SLICE_CHARS = 1 << 23  # of the rows that are weighed at once
SLICE_TEXT = 1 << 20  # characters of cleaned texts that are cut and counted at once
SHORTEST_WORD = 2  # characters of a word of a cleaned text (the mirror's token rule)
# ---------------------------------------------------------------------------------


def _tf_with_marker(docs: DataFrame, id_col: str, terms_col: str) -> DataFrame:
    """``(id, term, tf)`` plus one marker row ``(id, NULL, 1)`` per document.

    The marker's document frequency is the document count N (empty documents
    included), so N comes out of the same aggregation as every other document
    frequency instead of a second pass over the text. The pair count is a hash
    aggregate on ``(id, term)`` with map-side partial aggregation: neither a
    common term nor a document id shared by many rows lands in a single task.
    """
    terms = F.coalesce(F.col(terms_col), F.array().cast("array<string>"))
    marked = F.concat(terms, F.array(F.lit(None).cast("string")))
    exploded = docs.select(id_col, F.explode(marked).alias("term"))
    return exploded.groupBy(id_col, "term").agg(F.count(F.lit(1)).cast("bigint").alias("tf"))


def materialized(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder, as compressed Parquet, and read it back.

    A table with several consumers would be computed once for each: Catalyst pushes
    different filters into the branches, so their exchanges are not reused. Written once
    (``spark.checkpoint.dir``, never an executor's own disk), the text is cleaned once, and a
    lost executor does not send the job back to the raw text.
    """
    path = scratch_path(df.sparkSession, "features")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- counting within a row ---------------------------------------------------------
# Where an id stands for one row, its terms are counted where the row is, by Arrow and
# numpy on batches of rows: no (id, term) pair is shuffled. Rows whose id repeats are
# merged by the aggregates below.


def _giving_back(run):
    """``run`` on batches of rows, after each of which freed memory goes back to the system:
    a worker that waits for its next task holds little."""

    def giving(batches):
        import pyarrow as pa

        def taken():
            for batch in batches:
                yield batch
                pa.default_memory_pool().release_unused()

        yield from run(taken())
        pa.default_memory_pool().release_unused()

    return giving


def _row_slices(tokens) -> list[tuple[int, int]]:
    """Ranges of rows with at most ``SLICE_TOKENS`` tokens or ``SLICE_TEXT`` characters each, or one row."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if pa.types.is_list(tokens.type):
        sizes, most = np.diff(tokens.offsets.to_numpy()), SLICE_TOKENS
    else:
        sizes, most = pc.fill_null(pc.binary_length(tokens), 0).to_numpy(zero_copy_only=False), SLICE_TEXT
    ends = np.cumsum([0] + (sizes + 1).tolist())
    out, at = [], 0
    while at < len(tokens):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        out.append((at, to))
        at = to
    return out


def _words(texts, stop_words: list[str]):
    """``(row, code, names)`` of the words of cleaned texts (a-z, 0-9 and spaces): the row and the
    number of each, and the distinct words by number. Stop words and single characters are left out."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    tokens = pc.split_pattern(texts, " ")
    row = np.repeat(np.arange(len(texts)), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
    coded = tokens.flatten().dictionary_encode()
    code, names = coded.indices.to_numpy(), coded.dictionary.cast(pa.string())
    long = pc.greater_equal(pc.binary_length(names), SHORTEST_WORD)
    kept = pc.and_(long, pc.invert(pc.is_in(names, value_set=pa.array(stop_words, pa.string()))))
    is_kept = kept.to_numpy(zero_copy_only=False)
    here = is_kept[code]
    number = np.cumsum(is_kept) - 1
    return row[here], number[code[here]].astype(np.int64), names.filter(kept)


def _coded(tokens, pairs: bool, stop_words: list[str] | None = None):
    """``(row, code, names)`` of the tokens of some rows and, with ``pairs``, of their neighbouring
    pairs joined by a space: the row and the number of each, and the distinct terms by number.
    ``tokens`` are lists, or cleaned texts whose words without ``stop_words`` are the tokens."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if pa.types.is_list(tokens.type):
        flat = tokens.flatten()
        row = np.repeat(np.arange(len(tokens)), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
        if flat.null_count:
            row, flat = row[pc.is_valid(flat).to_numpy(zero_copy_only=False)], flat.drop_null()
        coded = flat.dictionary_encode()
        code, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    else:
        row, code, names = _words(tokens, stop_words or [])
    if pairs and len(code):
        n = len(names)
        near = row[1:] == row[:-1]
        coded = pa.array((code[:-1] * n + code[1:])[near]).dictionary_encode()
        both, at = coded.dictionary.to_numpy(), coded.indices.to_numpy().astype(np.int64)
        joined = pc.binary_join_element_wise(names.take(pa.array(both // n)), names.take(pa.array(both % n)), " ")
        names = pa.concat_arrays([names, joined])
        row, code = np.concatenate([row, row[1:][near]]), np.concatenate([code, at + n])
    return row, code, names


def _count_batches(pairs: bool, stop_words: list[str] | None):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lists = batch.column("_tokens")
            for a, b in _row_slices(lists):
                row, code, names = _coded(lists.slice(a, b - a), pairs, stop_words)
                n = len(names)
                if not n:
                    continue
                once = pa.array(row * n + code).unique().to_numpy() % n
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(np.bincount(once, minlength=n)), pa.array(np.bincount(code, minlength=n))],
                    names=["term", "df", "cf"],
                )

    return run


def row_term_counts(docs: DataFrame, tokens: Column, pairs: bool = False, stop_words: list[str] | None = None) -> DataFrame:
    """``(term, df, cf)`` where every row is a document: rows with the term, its total count.
    With ``pairs`` the terms are the tokens and their bigrams. ``tokens`` are lists of tokens, or
    cleaned texts (a-z, 0-9 and spaces only): their words of two characters or more, without
    ``stop_words``, are the tokens, cut by Arrow."""
    run = _giving_back(_count_batches(pairs, stop_words))
    parts = docs.select(tokens.alias("_tokens")).mapInArrow(run, "term string, df long, cf long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def repeated_ids(docs: DataFrame, id_col: str) -> DataFrame | None:
    """The ids that more than one row has (NULL is an id), or None when there are none."""
    again = materialized(docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > F.lit(1)))
    return None if again.isEmpty() else again.select(F.col(id_col).alias("_again"))


def rows_by_id(docs: DataFrame, id_col: str, again: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose id is theirs alone, and the others (None when there are none)."""
    if again is None:
        return docs, None
    same = F.col(id_col).eqNullSafe(F.col("_again"))
    return docs.join(again, same, "left_anti"), docs.join(again, same, "left_semi")


def fitted_vocabulary(
    docs: DataFrame, id_col: str, tokens: Column, pairs: bool, size: int, min_df: int, again: DataFrame | None
) -> tuple[DataFrame, int]:
    """:func:`vocabulary` of the documents' terms, and the number of documents (distinct ids)."""
    single, merged = rows_by_id(docs, id_col, again)
    counts, n = row_term_counts(single, tokens, pairs), single.count()
    if merged is not None:
        terms = unigrams_and_bigrams(tokens) if pairs else tokens
        tf = term_frequencies(merged.select(id_col, terms.alias("_terms")), id_col, "_terms")
        both = counts.unionByName(document_frequencies(tf))
        counts, n = both.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")), n + again.count()
    return top_counts(counts.filter(F.col("df") >= F.lit(min_df)), size), n


def _vectors(size: int, ends, index, values):
    """One sparse vector a row as Arrow structs: row i has the entries ``ends[i]`` to ``ends[i + 1]``."""
    import numpy as np
    import pyarrow as pa

    n, ends = len(ends) - 1, pa.array(ends, pa.int32())
    parts = {
        "type": pa.array(np.zeros(n, np.int8)), "size": pa.array(np.full(n, size, np.int32)),
        "indices": pa.ListArray.from_arrays(ends, pa.array(index, pa.int32())),
        "values": pa.ListArray.from_arrays(ends, pa.array(values, pa.float64())),
    }
    return pa.StructArray.from_arrays(list(parts.values()), names=list(parts))


def _weigh_batches(
    terms: list[str], idf_of: list[float] | None, keep: list[str], pairs: bool, out: str, coefficients, stop_words: list[str] | None
):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        vocab, weight = pa.array(terms, pa.string()), None if idf_of is None else np.array(idf_of, np.float64)
        factor = None if coefficients is None else np.nan_to_num(np.array(coefficients, np.float64))
        for batch in batches:
            lists = batch.column("_tokens")
            for a, b in _row_slices(lists):
                row, code, names = _coded(lists.slice(a, b - a), pairs, stop_words)
                known = pc.fill_null(pc.index_in(names, value_set=vocab), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                index = known[code]
                key, n = np.unique((row * len(vocab) + index)[index >= 0], return_counts=True)
                row, index = key // max(len(vocab), 1), key % max(len(vocab), 1)
                values = n.astype(np.float64)
                if weight is not None:
                    values = (1.0 + np.log(values)) * weight[index]
                    norm = np.sqrt(np.bincount(row, values * values, b - a))
                    values = values / np.where(norm > 0, norm, 1.0)[row]
                ends = pa.array(np.searchsorted(row, np.arange(b - a + 1)), pa.int32())
                made = {}
                if out == "dot":
                    made["dot"] = pa.array(np.bincount(row, values * factor[index], b - a), pa.float64())
                elif out == "vector":
                    made["vector"] = _vectors(len(vocab), ends, index, values)
                elif out == "counts":
                    made["tf"] = _vectors(len(vocab), ends, index, values)
                    made["log_tf"] = _vectors(len(vocab), ends, index, 1.0 + np.log(values))
                else:
                    made["terms"] = pa.ListArray.from_arrays(ends, vocab.take(pa.array(index)))
                    made["values"] = pa.ListArray.from_arrays(ends, pa.array(values, pa.float64()))
                kept = [batch.column(c).slice(a, b - a) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, *made.values()], names=[*keep, *made])

    return run


def murmur3(terms, seed: int = 42):
    """MurmurHash3 (x86, 32 bits, signed) of each string of an Arrow array, as ``HashingTF`` takes it."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    terms = terms.cast(pa.large_string())
    n = pc.binary_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(-n, kind="stable")  # the longest first: those with another four bytes are in front
    n = n[order]
    start = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset :][: len(n)][order]
    data = np.frombuffer(terms.buffers()[2] or b"", np.uint8)

    def rotated(x, by):
        return (x << np.uint32(by)) | (x >> np.uint32(32 - by))

    def mixed(k):
        return rotated(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)

    def byte(at, shift):
        return data[at].astype(np.uint32) << np.uint32(shift)

    h = np.full(len(n), seed, np.uint32)
    fours = n // 4
    for i in range(int(fours[0]) if len(n) else 0):
        m = int(np.searchsorted(-fours, -i))
        at = start[:m] + 4 * i
        k = byte(at, 0) | byte(at + 1, 8) | byte(at + 2, 16) | byte(at + 3, 24)
        h[:m] = rotated(h[:m] ^ mixed(k), 13) * np.uint32(5) + np.uint32(0xE6546B64)
    k = np.zeros(len(n), np.uint32)
    for i in range(3):
        more = n % 4 > i
        k[more] ^= byte((start + fours * 4 + i)[more], 8 * i)
    h ^= mixed(k) ^ n.astype(np.uint32)
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ (h >> np.uint32(shift))) * np.uint32(by)
    out = np.empty(len(n), np.int32)
    out[order] = h.view(np.int32)
    return out


def _hashed_sums(weights, stop_words: list[str]):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        stop = pa.array(stop_words, pa.string())
        for batch in batches:
            texts = batch.column("_text").cast(pa.large_string())
            ends = np.cumsum(np.append(0, pc.binary_length(texts).to_numpy(zero_copy_only=False) + 1))
            at = 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_CHARS, "right")) - 1)
                part = texts.slice(at, to - at)
                # no token follows the last one that holds a character; '' is one empty token
                cut = pc.ascii_rtrim(part, " ")
                blank = pc.and_(pc.equal(cut, ""), pc.not_equal(part, "")).to_numpy(zero_copy_only=False)
                tokens = pc.split_pattern(cut, " ")
                n = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
                coded = tokens.flatten().dictionary_encode()
                names = coded.dictionary.cast(pa.string())
                weight = weights[murmur3(names).astype(np.int64) % len(weights)]
                weight[pc.is_in(names, value_set=stop).to_numpy(zero_copy_only=False)] = 0.0
                sums = np.bincount(np.repeat(np.arange(to - at), n), weight[coded.indices.to_numpy()], to - at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").slice(at, to - at), pa.array(np.where(blank, 0.0, sums))], names=["_row", "_sum"]
                )
                at = to

    return run


def hashed_sums(docs: DataFrame, text: Column, weights, stop_words: list[str], keep: list[Column]) -> DataFrame:
    """The ``keep`` columns and ``_sum``: of every row the weights of its tokens' hashed buckets, stop
    words left out. ``text`` holds a-z, 0-9 and spaces only, as cleaned texts do; its tokens are
    ``Tokenizer``'s, its buckets ``HashingTF``'s."""
    rows = docs.select(F.struct(*keep).alias("_row"), text.alias("_text"))
    schema = T.StructType([rows.schema["_row"], T.StructField("_sum", T.DoubleType())])
    return rows.mapInArrow(_hashed_sums(weights, stop_words), schema).select("_row.*", "_sum")


def _hashed_vectors(size: int, stop_words: list[str], keep: list[str]):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        stop = pa.array(stop_words, pa.string())
        for batch in batches:
            for a, b in _row_slices(batch.column("_text")):
                part = batch.column("_text").slice(a, b - a)
                # no token follows the last one that holds a character; '' is one empty token
                cut = pc.ascii_rtrim(part, " ")
                some = pc.fill_null(pc.or_(pc.not_equal(cut, ""), pc.equal(part, "")), False).to_numpy(zero_copy_only=False)
                tokens = pc.split_pattern(cut, " ")
                n = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
                coded = tokens.flatten().dictionary_encode()
                names, code = coded.dictionary.cast(pa.string()), coded.indices.to_numpy()
                bucket = murmur3(names).astype(np.int64) % size
                kept = ~pc.is_in(names, value_set=stop).to_numpy(zero_copy_only=False)
                here = kept[code] & np.repeat(some, n)
                key, times = np.unique(np.repeat(np.arange(b - a), n)[here] * size + bucket[code[here]], return_counts=True)
                ends = np.searchsorted(key, np.arange(b - a + 1) * size)
                made = _vectors(size, ends, key % size, times.astype(np.float64))
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(a, b - a) for c in keep], made], names=[*keep, "vector"])

    return run


def hashed_vectors(docs: DataFrame, text: Column, size: int, stop_words: list[str]) -> DataFrame:
    """``docs`` with the sparse ``vector`` of each row's token counts by hashed bucket, stop words left
    out. ``text`` holds a-z, 0-9 and spaces only, as in :func:`hashed_sums`."""
    schema = T.StructType([*docs.schema.fields, *ADDED["vector"]])
    run = _giving_back(_hashed_vectors(size, stop_words, docs.columns))
    return docs.withColumn("_text", text).mapInArrow(run, schema)


#: What :func:`row_weights` adds, by its ``out``.
ADDED = {
    "terms": [T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("values", T.ArrayType(T.DoubleType()))],
    "vector": [T.StructField("vector", VectorUDT())],
    "counts": [T.StructField("tf", VectorUDT()), T.StructField("log_tf", VectorUDT())],
    "dot": [T.StructField("dot", T.DoubleType())],
}


def row_weights(
    docs: DataFrame,
    tokens: Column,
    terms: list[str],
    idf_of: list[float] | None,
    out: str,
    pairs: bool = False,
    coefficients: list[float] | None = None,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """``docs`` with each row's weights over a capped vocabulary ``terms`` (a model parameter):
    the L2-normalised ``(1 + ln tf) * idf``, or the plain count where there is no idf.

    ``out``: ``terms`` and ``values`` (arrays), one sparse ``vector``, the weights' ``dot``
    product with the coefficients, or the ``counts`` as sparse vectors ``tf`` and ``log_tf``
    (``1 + ln tf``). ``tokens`` and ``stop_words`` as in :func:`row_term_counts`."""
    schema = T.StructType([*docs.schema.fields, *ADDED[out]])
    run = _giving_back(_weigh_batches(terms, idf_of, docs.columns, pairs, out, coefficients, stop_words))
    return docs.withColumn("_tokens", tokens).mapInArrow(run, schema)


def _split_marker(tf_all: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    tf = tf_all.filter(F.col("term").isNotNull())
    dfreq_all = document_frequencies(tf_all)
    # An aggregate over the whole (small) table rather than a filter on the
    # grouping key, which the optimizer would push below the aggregation into a
    # separate scan of the term counts.
    n = dfreq_all.agg(F.max(F.when(F.col("term").isNull(), F.col("df"))).cast("double")).scalar()
    return tf, dfreq_all.filter(F.col("term").isNotNull()), n


def term_frequencies(docs: DataFrame, id_col: str, terms_col: str) -> DataFrame:
    """``(id, term, tf)`` for every term occurrence list; documents with no terms give no rows."""
    exploded = docs.select(id_col, F.explode(F.col(terms_col)).alias("term"))
    return exploded.groupBy(id_col, "term").agg(F.count(F.lit(1)).cast("bigint").alias("tf"))


def document_frequencies(tf: DataFrame) -> DataFrame:
    """``(term, df, cf)``: documents containing the term and its total count."""
    return tf.groupBy("term").agg(
        F.count(F.lit(1)).cast("bigint").alias("df"), F.sum("tf").cast("bigint").alias("cf")
    )


def idf(df_col: Column, n_docs: Column, min_doc_freq: int = DEFAULT_MIN_DF) -> Column:
    """MLlib's IDF: ``ln((N + 1) / (df + 1))``, and 0 for terms below ``min_doc_freq``."""
    return F.when(df_col >= F.lit(min_doc_freq), F.log((n_docs + F.lit(1.0)) / (df_col + F.lit(1.0)))).otherwise(
        F.lit(0.0)
    )


def tfidf_terms(
    docs: DataFrame,
    id_col: str,
    terms_col: str,
    min_doc_freq: int = DEFAULT_MIN_DF,
) -> DataFrame:
    """Exact term-keyed TF-IDF with MLlib semantics (raw tf times IDF, no normalisation).

    Output ``(id, term, tf, df, idf, weight)``, doubles rounded to 6 places.
    """
    tf, dfreq, n = _split_marker(materialized(_tf_with_marker(docs, id_col, terms_col)))
    dfreq = dfreq.select("term", "df")
    w = idf(F.col("df"), n, min_doc_freq)
    return tf.join(dfreq, "term").select(
        id_col,
        "term",
        "tf",
        "df",
        F.round(w, 6).alias("idf"),
        F.round(F.col("tf") * w, 6).alias("weight"),
    )


def vocabulary(tf: DataFrame, size: int = DEFAULT_VOCAB_SIZE, min_df: int = DEFAULT_MIN_DF) -> DataFrame:
    """Top ``size`` terms by corpus count among those in at least ``min_df`` documents.

    Ties break by term, so the cut is deterministic. A plain ``orderBy().limit()``
    would merge up to (partitions x size) rows in one task, so candidates are
    pruned first by an exact count threshold:

    1. terms per corpus-count value: a table with one row per distinct count,
       at most ``sqrt(2 * total tokens)`` rows (distinct positive counts sum to at
       most the total), so a window over it is bounded;
    2. the threshold T is the smallest count with fewer than ``size`` terms
       strictly above it, i.e. the count of the ``size``-th term;
    3. only terms with count >= T enter the top-k; the final rank window runs
       over at most ``size`` rows.

    The document-frequency table is read twice (threshold, top-k), so it is
    written once (:func:`materialized`).
    """
    return top_counts(document_frequencies(tf).filter(F.col("df") >= F.lit(min_df)), size)


def top_counts(counts: DataFrame, size: int) -> DataFrame:
    """``(rank, term, cf, df)`` of the ``size`` terms of ``counts(term, df, cf)`` with the largest cf."""
    dfreq = materialized(counts)
    per_count = dfreq.groupBy("cf").agg(F.count(F.lit(1)).alias("_terms"))
    above = F.coalesce(
        F.sum("_terms").over(Window.orderBy(F.col("cf").desc()).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    threshold = (
        per_count.select("cf", above.alias("_above")).filter(F.col("_above") < F.lit(size)).agg(F.min("cf")).scalar()
    )
    top = (
        dfreq.filter(F.col("cf") >= threshold)
        .orderBy(F.col("cf").desc(), F.col("term").asc())
        .limit(size)
    )
    return top.select(
        F.row_number().over(Window.orderBy(F.col("cf").desc(), F.col("term").asc())).alias("rank"),
        "term",
        "cf",
        "df",
    )


def tfidf_sublinear_l2(
    docs: DataFrame,
    id_col: str,
    terms_col: str,
    max_features: int = DEFAULT_VOCAB_SIZE,
    min_df: int = DEFAULT_MIN_DF,
    pairs: bool = False,
) -> DataFrame:
    """The mirror's weights: capped vocabulary, ``1 + ln(tf)``, smooth IDF
    ``ln((1 + N) / (1 + df)) + 1``, then each document scaled to unit L2 norm.

    Output ``(id, term, weight)`` rounded to 6 places. The vocabulary is at most
    ``max_features`` rows and goes to every task. A row whose id is its own is counted and
    scaled where it is; rows that share an id are one document, counted by hash aggregates.
    ``docs`` is read several times: write it first (:func:`materialized`) where it is
    expensive. With ``pairs`` the terms are the tokens of ``terms_col`` and their bigrams.
    """
    again = repeated_ids(docs, id_col)
    tokens = F.coalesce(F.col(terms_col), F.array().cast("array<string>"))
    top, n = fitted_vocabulary(docs, id_col, tokens, pairs, max_features, min_df, again)
    smooth_idf = F.log((F.lit(1.0) + F.lit(float(n))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    vocab = materialized(top.select("term", smooth_idf.alias("idf")))
    rows = vocab.collect()  # at most max_features
    single, merged = rows_by_id(docs, id_col, again)
    # a NULL id has no weights
    own = single.filter(F.col(id_col).isNotNull()).select(id_col, F.col(terms_col).alias("_own"))
    found = row_weights(own, F.col("_own"), [r.term for r in rows], [r.idf for r in rows], "terms", pairs)
    out = found.select(id_col, F.inline(F.arrays_zip("terms", "values"))).select(
        id_col, F.col("terms").alias("term"), F.round("values", 6).alias("weight")
    )
    if merged is None:
        return out
    terms = unigrams_and_bigrams(tokens) if pairs else tokens
    tf = term_frequencies(merged.select(id_col, terms.alias("_terms")), id_col, "_terms")
    raw = tf.join(F.broadcast(vocab), "term").select(
        id_col, "term", ((F.lit(1.0) + F.log(F.col("tf"))) * F.col("idf")).alias("w")
    )
    norms = raw.groupBy(id_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return out.unionByName(
        raw.join(norms, id_col).select(id_col, "term", F.round(F.col("w") / F.col("norm"), 6).alias("weight"))
    )
