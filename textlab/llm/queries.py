"""The registered queries of this package: each operator over its whole table.

``QUERIES`` maps names to ``(spark, sf_dir) -> DataFrame``, ``ORACLES`` to DuckDB SQL
where SQL expresses the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.llm import (
    collocations,
    context_tree,
    line_dedup,
    mixing,
    near_dup,
    nearest,
    pieces,
    quality_classifier,
    quality_rules,
    token_counts,
    url_filter,
    vector_codes,
    warc_zip,
)
from textlab.llm.common import read
from textlab.session import scratch_path

TOKENIZER = "piece_bpe_32k.model"
RULES = [
    url_filter.Rule("allow", "com/"),
    url_filter.Rule("block", "example.com/en/"),
    url_filter.Rule("allow", "www.example.com/en/"),
    url_filter.Rule("block", "net/es/"),
    url_filter.Rule("block", "net/fr/"),
]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of documents labelled good and not toxic."""
    return read(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0").select("doc_id")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), RULES)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number of pieces, a hash of the ids, and whether they decode to the
    text (the model spells U+2581 and the space alike)."""
    model = pieces.load(tokenizer_path())
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "text", F.md5(F.translate(F.coalesce("text", F.lit("")), "▁", " ")).alias("text_md5")
    )
    decoded = pieces.decode(pieces.encode(docs, model, ("doc_id", "text_md5")), model)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
        (F.md5("decoded") == F.col("text_md5")).alias("round_trip"),
    )


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"), near_dup.NearDup(shingle=3, percent=85))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"), trusted(spark, sf_dir))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality_classifier.fit(docs, labels.filter(~quality_classifier.held_out(F.col("doc_id"))))
    return quality_classifier.score(docs, model)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warc_zip.write_packages(read(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc_zip.read_packages(
        packages, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        read(spark, sf_dir, "documents"), tokenizer_path(), scratch_path(spark, "token-cache")
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.queue(mixing.sized(read(spark, sf_dir, "documents"))).drop("uid", "source")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read(spark, sf_dir, "embeddings"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_url_filters": op1,
    "op2_sentencepiece": op2,
    "op3_minhash_near_dedup": op3,
    "op4_quality_rules": op4,
    "op5_quality_classifier": op5,
    "op6_warc": op6,
    "op7_line_dedup": op7,
    "op8_nearest_neighbours": op8,
    "op9_token_counts": op9,
    "op10_mixing": op10,
    "op11_vector_codes": op11,
    "op12_collocations": op12,
    "op13_lm_scoring": op13,
    "pipeline": pipeline,
}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES = {
    "op3_minhash_near_dedup": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.replace("coalesce(text, '')",
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w
), x AS (SELECT doc_id, unnest(s) AS t, len(s) AS n FROM s), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, min(r.b) AS component_id, min(r.b) = s.doc_id AS kept
FROM s JOIN r ON r.a = s.doc_id GROUP BY s.doc_id, s""",
    "op6_warc": """
WITH d AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), m AS (SELECT h, max(page_id) AS last FROM d GROUP BY h)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, ((i // 4) * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM d JOIN m USING (h)""",
    "op8_nearest_neighbours": """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20""",
    "op10_mixing": rf"""
WITH RECURSIVE b AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents
), g AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM b GROUP BY source
), l AS (
  SELECT *, 2 * source_size / w AS level,
    (sum(source_size) OVER () * 150 / 100.0::DOUBLE
      - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2 * source_size / w, no
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY 2 * source_size / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM g
), t AS (
  SELECT source, source_size, no,
    least(2.0::DOUBLE * source_size, w * (SELECT arg_min(share, level) FROM l WHERE share <= level)) AS target FROM l
), q AS (
  SELECT doc_id, size, source_size, target, no, k,
    sum(size) OVER (PARTITION BY no ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) AS c
  FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source
), f AS (
  SELECT q.*, (c + e * source_size)::BIGINT / target AS finish FROM q, (VALUES (0), (1)) AS x(e)
  WHERE size > 0 AND target > 0
), o AS (
  SELECT *, sum(size) OVER (ORDER BY finish, no, k, doc_id ROWS UNBOUNDED PRECEDING) AS total FROM f
), taken AS (
  SELECT doc_id, sum(size)::BIGINT AS taken FROM o
  WHERE total * 100 <= 150 * (SELECT sum(size) FROM b) GROUP BY doc_id
)
SELECT q.doc_id, size, source_size, target, coalesce(taken, 0) AS taken
FROM q LEFT JOIN taken USING (doc_id)""",
    "op11_vector_codes": """
WITH v AS (
  SELECT vec_id, label, len(embedding) // 16 AS d, row_number() OVER (ORDER BY vec_id) - 1 AS no,
    list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
), p AS (
  SELECT vec_id, label, no, part, x[part * d + 1 : part * d + d] AS y FROM v, range(0, 16) AS r(part)
), c0 AS (SELECT part, no AS entry, y AS c FROM p WHERE no < 64),
a1 AS (
  SELECT p.part, p.no, any_value(p.y) AS y, arg_min(entry, e * 64 + entry) AS entry
  FROM (SELECT p.*, entry, list_sum(list_transform(list_zip(y, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS e
    FROM p JOIN c0 USING (part)) p GROUP BY p.part, p.no
), m1 AS (
  SELECT part, entry, list(f ORDER BY i) AS c FROM (
    SELECT part, entry, i, (sum(y[i])::BIGINT - ((sum(y[i])::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS f
    FROM a1, (SELECT unnest(range(1, (SELECT max(d) FROM v) + 1)) AS i) GROUP BY part, entry, i) GROUP BY part, entry
), c1 AS (SELECT part, entry, coalesce(m1.c, c0.c) AS c FROM c0 LEFT JOIN m1 USING (part, entry)),
a2 AS (
  SELECT p.part, p.no, any_value(p.y) AS y, arg_min(entry, e * 64 + entry) AS entry
  FROM (SELECT p.*, entry, list_sum(list_transform(list_zip(y, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS e
    FROM p JOIN c1 USING (part)) p GROUP BY p.part, p.no
), m2 AS (
  SELECT part, entry, list(f ORDER BY i) AS c FROM (
    SELECT part, entry, i, (sum(y[i])::BIGINT - ((sum(y[i])::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS f
    FROM a2, (SELECT unnest(range(1, (SELECT max(d) FROM v) + 1)) AS i) GROUP BY part, entry, i) GROUP BY part, entry
), c2 AS (SELECT part, entry, coalesce(m2.c, c1.c) AS c FROM c1 LEFT JOIN m2 USING (part, entry)),
a3 AS (
  SELECT no, part, arg_min(entry, e * 64 + entry) AS entry, min(e) AS e
  FROM (SELECT p.no, p.part, entry, list_sum(list_transform(list_zip(y, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS e
    FROM p JOIN c2 USING (part)) p GROUP BY no, part
), g AS (
  SELECT no, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(e)::BIGINT AS error FROM a3 GROUP BY no
), h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM g JOIN v USING (no), h""",
    "op12_collocations": r"""
WITH p AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
  FROM p, (SELECT unnest(range(1, 6)) AS k)
), f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (
  SELECT c.lang, c.phrase, c.k AS words, c.f AS a, j, l.f AS l, r.f AS r, n,
    ((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT f.*, unnest(range(1, k)) AS j, string_split(phrase, ' ') AS w FROM f WHERE k > 1) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1 : j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[j + 1 : c.k], ' ')
  JOIN t ON t.lang = c.lang
), b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
s AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i : i + x - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT f.*, unnest(range(2, k)) AS x FROM f WHERE k > 2) f, (SELECT unnest(range(1, 5)) AS i)
  WHERE i + x - 1 <= k GROUP BY 1, 2
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.lang = b.lang AND s.phrase = b.phrase AND 100 * s.f >= 100 * b.a)
QUALIFY rank <= 2000""",
}
