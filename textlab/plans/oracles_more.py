"""SQL oracles (continued): splits, evaluation, features, scoring shapes, requests,
lines, gate, CSV round trip and streaming summary."""

from __future__ import annotations

from textlab.functions.text import ACCENTED_LETTERS, FOLDED_LETTERS
from textlab.plans.oracles import (
    CLEAN_CTE,
    GOLDEN_CTE,
    ORACLES,
    REVIEWS_CTE,
    SCORES_CTE,
    clean_sql,
    label_sql,
    rating_sql,
    stop_list_sql,
)


LABELLED_DOCS_CTE = """labelled_docs AS (
  SELECT d.doc_id AS review_id, d.text, d.lang, CAST(l.quality AS DOUBLE) AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
keyed AS (
  SELECT review_id, label,
    ('0x' || substr(md5('42:' || CAST(review_id AS VARCHAR)), 1, 8))::BIGINT AS k0,
    ('0x' || substr(md5('42:' || CAST(review_id AS VARCHAR)), 9, 8))::BIGINT AS k1
  FROM labelled_docs),
split AS (
  SELECT review_id, label, k1, CASE WHEN k0 % 10000 < 2000 THEN 'test' ELSE 'train' END AS split FROM keyed)"""

STRATIFIED_CTE = (
    LABELLED_DOCS_CTE
    + """,
strat AS (
  SELECT review_id, label,
    CASE WHEN row_number() OVER (PARTITION BY label ORDER BY k0, review_id)
              <= CAST(round(0.2 * count(*) OVER (PARTITION BY label)) AS BIGINT)
         THEN 'test' ELSE 'train' END AS split
  FROM keyed)"""
)

ORACLES["hash_split"] = f"WITH {LABELLED_DOCS_CTE} SELECT review_id, label, split FROM split"
ORACLES["hash_split_sizes"] = f"""WITH {LABELLED_DOCS_CTE}
SELECT split, label, CAST(count(*) AS BIGINT) AS n FROM split GROUP BY split, label"""
ORACLES["stratified_split"] = f"WITH {STRATIFIED_CTE} SELECT review_id, label, split FROM strat"
ORACLES["stratified_split_sizes"] = f"""WITH {STRATIFIED_CTE}
SELECT split, label, CAST(count(*) AS BIGINT) AS n FROM strat GROUP BY split, label"""
ORACLES["recorded_run"] = f"""WITH {LABELLED_DOCS_CTE},
valid AS (
  SELECT s.*, CAST(k1 % 3 AS INTEGER) AS fold FROM split s JOIN labelled_docs d USING (review_id)
  WHERE length({clean_sql("d.text")}) > 5),
rows AS (
  SELECT 'split' AS step, split || '_label_' || CAST(label AS INTEGER) AS name, count(*) AS value
  FROM valid GROUP BY split, label
  UNION ALL
  SELECT 'cv', 'fold' || f || '_train_rows', count_if(fold <> f) FROM valid, range(0, 3) AS r(f)
  WHERE split = 'train' GROUP BY f
  UNION ALL
  SELECT 'cv', 'fold' || f || '_validation_rows', count_if(fold = f) FROM valid, range(0, 3) AS r(f)
  WHERE split = 'train' GROUP BY f
  UNION ALL SELECT 'metrics', 'test_samples', count(*) FROM valid WHERE split = 'test'
  UNION ALL SELECT 'metrics', 'positive_samples', count_if(label = 1) FROM valid WHERE split = 'test'
  UNION ALL SELECT 'metrics', 'negative_samples', count_if(label = 0) FROM valid WHERE split = 'test'
  UNION ALL SELECT 'audit', unnest(['cv_cells', 'stages', 'metrics_in_range', 'verdict_follows_rule',
    'refit_at_best_mean_auc', 'samples_are_the_test_part', 'metadata_holds_metrics']), unnest([12, 5, 1, 1, 1, 1, 1]))
SELECT step, name, CAST(value AS BIGINT) AS value FROM rows"""
ORACLES["fold_sizes"] = f"""WITH {LABELLED_DOCS_CTE}
SELECT CAST(k1 % 3 AS INTEGER) AS fold, label, CAST(count(*) AS BIGINT) AS n
FROM split WHERE split = 'train' GROUP BY ALL"""


def _metrics_sql(tp: str, fp: str, fn: str, tn: str) -> str:
    def ratio(a: str, b: str) -> str:
        return f"coalesce(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"

    return f"""round({ratio(f"{tp} + {tn}", f"{tp} + {fp} + {fn} + {tn}")}, 4) AS accuracy,
  round({ratio(tp, f"{tp} + {fp}")}, 4) AS precision,
  round({ratio(tp, f"{tp} + {fn}")}, 4) AS recall,
  round({ratio(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}")}, 4) AS f1_score"""


CELLS_BODY = """cells AS (SELECT count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
  count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 0 AND prediction = 0) AS tn FROM scores)"""
CELLS_CTE = f"{SCORES_CTE},\n{CELLS_BODY}"

ORACLES["binary_metrics"] = f"""WITH {CELLS_CTE}
SELECT {_metrics_sql("tp", "fp", "fn", "tn")},
  CAST(tp + fp + fn + tn AS BIGINT) AS test_samples, CAST(tp + fn AS BIGINT) AS positive_samples,
  CAST(fp + tn AS BIGINT) AS negative_samples, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn FROM cells"""

ORACLES["confusion"] = f"""WITH {SCORES_CTE},
frame AS (SELECT a AS actual, p AS predicted FROM (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS p))
SELECT f.actual, f.predicted, CAST(count(s.review_id) AS BIGINT) AS n
FROM frame f LEFT JOIN scores s ON s.label = f.actual AND s.prediction = f.predicted
GROUP BY f.actual, f.predicted"""

GRID_CTE = """grid AS (SELECT * FROM (VALUES (0.01, 0.0, 7919), (0.01, 0.5, 7907), (0.1, 0.0, 7901), (0.1, 0.5, 7883))
  AS v(reg_param, elastic_net, m)),
cell_scores AS (SELECT CAST(reg_param AS DOUBLE) AS reg_param, CAST(elastic_net AS DOUBLE) AS elastic_net,
  CAST(('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 9, 8))::BIGINT % 3 AS INTEGER) AS fold,
  quality AS label, CAST((doc_id * m) % 200 AS DOUBLE) / 200.0 AS score FROM labels, grid),
cell_counts AS (SELECT reg_param, elastic_net, fold, score, count_if(label = 1) AS pos, count_if(label = 0) AS neg
  FROM cell_scores WHERE score IS NOT NULL GROUP BY ALL),
below AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY reg_param, elastic_net, fold ORDER BY score
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before FROM cell_counts),
areas AS (SELECT reg_param, elastic_net, fold, sum(pos * (neg_before + neg / 2.0)) / NULLIF(sum(pos) * sum(neg), 0) AS auc,
  CAST(sum(pos) AS BIGINT) AS positive_samples, CAST(sum(neg) AS BIGINT) AS negative_samples,
  CAST(count(*) AS BIGINT) AS n_scores FROM below GROUP BY reg_param, elastic_net, fold)"""

ORACLES["cv_auc_grid"] = f"""WITH {GRID_CTE}
SELECT reg_param, elastic_net, fold, round(auc, 6) AS auc_roc, positive_samples, negative_samples, n_scores FROM areas"""
ORACLES["cv_table_scores"] = f"""WITH {GRID_CTE},
pairs AS (SELECT reg_param, elastic_net, round(avg(auc), 6) AS mean_auc, round(stddev_samp(auc), 6) AS std_auc,
  CAST(count(*) AS INTEGER) AS folds FROM areas GROUP BY reg_param, elastic_net),
ranked AS (SELECT *, CAST(rank() OVER (ORDER BY mean_auc DESC) AS INTEGER) AS rank FROM pairs)
SELECT *, rank = 1 AS is_best FROM ranked"""

PREFIX_CTE = f"""{SCORES_CTE},
c AS (SELECT score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM scores
      WHERE score IS NOT NULL GROUP BY score),
p AS (SELECT *,
  coalesce(sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_before,
  coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before,
  sum(pos) OVER () AS pos_total, sum(neg) OVER () AS neg_total FROM c)"""

ORACLES["auc_exact"] = f"""WITH {PREFIX_CTE}
SELECT round(sum(pos * (neg_before + neg / 2.0)) / NULLIF(sum(pos) * sum(neg), 0), 6) AS auc_roc,
  CAST(sum(pos) AS BIGINT) AS positive_samples, CAST(sum(neg) AS BIGINT) AS negative_samples,
  CAST(count(*) AS BIGINT) AS n_scores FROM p"""

ORACLES["roc_points"] = f"""WITH {PREFIX_CTE}
SELECT 'inf'::DOUBLE AS threshold, CAST(0 AS BIGINT) AS tp, CAST(0 AS BIGINT) AS fp, 0.0 AS tpr, 0.0 AS fpr
UNION ALL
SELECT score, CAST(pos_total - pos_before AS BIGINT), CAST(neg_total - neg_before AS BIGINT),
  round((pos_total - pos_before) / NULLIF(CAST(pos_total AS DOUBLE), 0), 6),
  round((neg_total - neg_before) / NULLIF(CAST(neg_total AS DOUBLE), 0), 6) FROM p"""

ORACLES["prob_histogram"] = f"""WITH {SCORES_CTE},
s AS (SELECT label, score FROM scores WHERE score IS NOT NULL),
r0 AS (SELECT label, min(score) AS lo0, max(score) AS hi0 FROM s GROUP BY label),
r AS (SELECT label,
  CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
  CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM r0),
j0 AS (SELECT s.label, s.score, r.lo, r.hi, (r.hi - r.lo) / 50.0 AS step,
  least(CAST(floor((s.score - r.lo) / (r.hi - r.lo) * 50.0) AS INTEGER), 49) AS i0
  FROM s JOIN r ON s.label = r.label),
j1 AS (SELECT *, CASE WHEN score < (CASE WHEN i0 >= 50 THEN hi ELSE CAST(i0 AS DOUBLE) * step + lo END)
                      THEN i0 - 1 ELSE i0 END AS i1 FROM j0),
j2 AS (SELECT label, CASE WHEN score >= (CASE WHEN i1 + 1 >= 50 THEN hi ELSE CAST(i1 + 1 AS DOUBLE) * step + lo END)
                            AND i1 <> 49 THEN i1 + 1 ELSE i1 END AS bin FROM j1),
cnt AS (SELECT label, bin, count(*) AS n FROM j2 GROUP BY label, bin),
frame AS (SELECT label, lo, hi, (hi - lo) / 50.0 AS step, unnest(range(0, 50)) AS bin FROM r)
SELECT f.label, CAST(f.bin AS INTEGER) AS bin,
  round(CASE WHEN f.bin >= 50 THEN f.hi ELSE CAST(f.bin AS DOUBLE) * f.step + f.lo END, 9) AS bin_lo,
  round(CASE WHEN f.bin + 1 >= 50 THEN f.hi ELSE CAST(f.bin + 1 AS DOUBLE) * f.step + f.lo END, 9) AS bin_hi,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM frame f LEFT JOIN cnt c ON f.label = c.label AND f.bin = c.bin"""

ORACLES["threshold_sweep"] = f"""WITH {SCORES_CTE},
t AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]) AS threshold),
k AS (SELECT t.threshold,
  count_if(s.label = 1 AND s.score > t.threshold) AS tp, count_if(s.label = 0 AND s.score > t.threshold) AS fp,
  count_if(s.label = 1 AND NOT s.score > t.threshold) AS fn, count_if(s.label = 0 AND NOT s.score > t.threshold) AS tn
  FROM t, scores s WHERE s.score IS NOT NULL GROUP BY t.threshold)
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
  CAST(tn AS BIGINT) AS tn, {_metrics_sql("tp", "fp", "fn", "tn")} FROM k"""


def verdict_sql(f1: str, auc: str) -> str:
    return f"""CASE WHEN coalesce({f1} >= 0.9 AND {auc} >= 0.95, false) THEN 'excellent'
  WHEN coalesce({f1} >= 0.8 AND {auc} >= 0.85, false) THEN 'good'
  WHEN coalesce({f1} >= 0.7, false) THEN 'acceptable' ELSE 'deficient' END"""


ORACLES["evaluation_summary"] = f"""WITH {PREFIX_CTE}, {CELLS_BODY},
a AS (SELECT sum(pos * (neg_before + neg / 2.0)) AS s, sum(pos) AS P, sum(neg) AS N FROM p),
m AS (SELECT {_metrics_sql("tp", "fp", "fn", "tn")},
  round(a.s / NULLIF(a.P * a.N, 0), 4) AS auc_roc, CAST(a.P + a.N AS BIGINT) AS test_samples,
  CAST(a.P AS BIGINT) AS positive_samples, CAST(a.N AS BIGINT) AS negative_samples FROM cells, a)
SELECT *, {verdict_sql("f1_score", "auc_roc")} AS verdict FROM m"""


# --- features -------------------------------------------------------------------


def ml_tokens_sql(x: str) -> str:
    lx = f"lower({x})"
    return (
        f"(CASE WHEN {lx} = '' THEN [''] WHEN NOT regexp_matches({lx}, '\\S') THEN []::VARCHAR[] "
        f"ELSE string_split_regex(regexp_replace({lx}, '\\s+$', ''), '\\s') END)"
    )


def stop_filter_sql(toks: str) -> str:
    return f"list_filter({toks}, lambda t: NOT list_contains({stop_list_sql()}, lower(t)))"


def grams_sql(f: str) -> str:
    return f"list_concat({f}, list_transform(range(1, len({f})), lambda i: {f}[i] || ' ' || {f}[i + 1]))"


TOKENS_CTE = f"""{CLEAN_CTE},
toks AS (SELECT review_id, {ml_tokens_sql("review_combined")} AS t FROM clean),
ftoks AS (SELECT review_id, {stop_filter_sql("t")} AS f FROM toks)"""

ORACLES["tokens"] = f"""WITH {TOKENS_CTE}
SELECT review_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, '|') AS tokens_text FROM toks"""

ORACLES["stopword_filter"] = f"""WITH {TOKENS_CTE}
SELECT review_id, CAST(len(f) AS INTEGER) AS n_tokens, array_to_string(f, '|') AS tokens_text FROM ftoks"""

ORACLES["bigrams"] = f"""WITH {TOKENS_CTE},
g AS (SELECT review_id, {grams_sql("f")} AS g FROM ftoks)
SELECT review_id, CAST(len(g) AS INTEGER) AS n_grams, array_to_string(g, '|') AS grams_text FROM g"""

TF_CTE = f"""{TOKENS_CTE},
tf AS (SELECT review_id, term, count(*) AS tf FROM (SELECT review_id, unnest(f) AS term FROM ftoks) GROUP BY ALL),
dfq AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM clean)"""

ORACLES["tfidf_terms"] = f"""WITH {TF_CTE},
w AS (SELECT tf.review_id, tf.term, tf.tf, dfq.df,
  CASE WHEN dfq.df >= 2 THEN ln((n.n + 1.0) / (dfq.df + 1.0)) ELSE 0.0 END AS idf
  FROM tf JOIN dfq ON tf.term = dfq.term, n)
SELECT review_id, term, CAST(tf AS BIGINT) AS tf, CAST(df AS BIGINT) AS df, round(idf, 6) AS idf,
  round(tf * idf, 6) AS weight FROM w"""

ORACLES["vocab_topk"] = f"""WITH {TF_CTE}
SELECT CAST(row_number() OVER (ORDER BY cf DESC, term ASC) AS INTEGER) AS rank, term,
  CAST(cf AS BIGINT) AS cf, CAST(df AS BIGINT) AS df
FROM dfq WHERE df >= 2 ORDER BY cf DESC, term ASC LIMIT 65536"""

# MurmurHash3 x86-32, seed 42, of a term's UTF-8 bytes; its lowest 16 bits are the bucket.
# Unsigned 64-bit products of two 32-bit numbers do not overflow.
_WORD = "4294967296::UBIGINT"


def _rotate_sql(x: str, bits: int) -> str:
    return f"(({x} * {1 << bits}::UBIGINT) % {_WORD} + {x} // {1 << (32 - bits)}::UBIGINT)"


def _scramble_sql(k: str) -> str:
    y = f"(({k} * 3432918353::UBIGINT) % {_WORD})"
    return f"(({_rotate_sql(y, 15)} * 461845907::UBIGINT) % {_WORD})"


def murmur_cte(terms: str) -> str:
    """CTEs ending in ``hashed(term, bucket)`` of the distinct ``term`` of table ``terms``."""
    folded = f"xor(h, {_scramble_sql('k')})"
    return f"""octets AS (SELECT term, list_transform(range(0, strlen(term)),
    lambda j: ('0x' || substr(hex(encode(term)), CAST(2 * j + 1 AS BIGINT), 2))::UBIGINT) AS b
  FROM (SELECT DISTINCT term FROM {terms})),
blocks AS (SELECT term, CAST(len(b) AS UBIGINT) AS n,
  list_transform(range(0, len(b) // 4),
    lambda i: b[4 * i + 1] + 256 * b[4 * i + 2] + 65536 * b[4 * i + 3] + 16777216 * b[4 * i + 4]) AS ks,
  coalesce(b[4 * (len(b) // 4) + 1], 0)::UBIGINT + 256::UBIGINT * coalesce(b[4 * (len(b) // 4) + 2], 0)
    + 65536::UBIGINT * coalesce(b[4 * (len(b) // 4) + 3], 0) AS rest FROM octets),
body AS (SELECT term, n, rest, list_reduce(ks, lambda h, k:
  CAST(({_rotate_sql(folded, 13)} * 5::UBIGINT + 3864292196::UBIGINT) % {_WORD} AS UBIGINT), 42::UBIGINT) AS h FROM blocks),
mixed0 AS (SELECT term, xor(xor(h, {_scramble_sql("rest")}), n) AS h FROM body),
mixed1 AS (SELECT term, (xor(h, h // 65536::UBIGINT) * 2246822507::UBIGINT) % {_WORD} AS h FROM mixed0),
mixed2 AS (SELECT term, (xor(h, h // 8192::UBIGINT) * 3266489909::UBIGINT) % {_WORD} AS h FROM mixed1),
hashed AS (SELECT term, CAST(xor(h, h // 65536::UBIGINT) % 65536 AS INTEGER) AS bucket FROM mixed2)"""


def buckets_cte(tokens: str, docs: str) -> str:
    """CTEs ending in ``weighed(review_id, bucket, tf, df, weight)`` of ``tokens(review_id, f)``."""
    return f"""occurrences AS (SELECT review_id, unnest(f) AS term FROM {tokens}),
{murmur_cte("occurrences")},
bucket_tf AS (SELECT review_id, bucket, count(*) AS tf FROM occurrences JOIN hashed USING (term) GROUP BY ALL),
bucket_df AS (SELECT bucket, count(*) AS df FROM bucket_tf GROUP BY bucket),
doc_count AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {docs}),
weighed AS (SELECT review_id, bucket, tf, df,
  tf * CASE WHEN df >= 2 THEN ln((n + 1.0) / (df + 1.0)) ELSE 0.0 END AS weight
  FROM bucket_tf JOIN bucket_df USING (bucket), doc_count)"""


ORACLES["hashed_buckets"] = f"""WITH {TOKENS_CTE}, {buckets_cte("ftoks", "clean")}
SELECT review_id, bucket, CAST(tf AS BIGINT) AS tf, round(weight, 6) AS weight FROM weighed"""
ORACLES["hashed_features"] = f"""WITH {TOKENS_CTE}, {buckets_cte("ftoks", "clean")}
SELECT c.review_id, CAST(count(w.bucket) AS INTEGER) AS n_buckets, round(coalesce(sum(w.weight), 0.0), 6) AS weight_sum
FROM clean c LEFT JOIN weighed w USING (review_id) GROUP BY c.review_id"""
ORACLES["train_certificate"] = f"""WITH {LABELLED_DOCS_CTE},
valid AS (SELECT s.review_id, s.label, s.split, {clean_sql("d.text")} AS t FROM split s
  JOIN labelled_docs d USING (review_id)),
train_docs AS (SELECT review_id, {ml_tokens_sql("t")} AS t FROM valid WHERE length(t) > 5 AND split = 'train'),
train_toks AS (SELECT review_id, {stop_filter_sql("t")} AS f FROM train_docs),
{buckets_cte("train_toks", "train_docs")},
varying AS (SELECT count(DISTINCT bucket) AS features FROM weighed, doc_count WHERE df >= 2 AND df < n)
SELECT review_id, label, true AS scored, CAST(n AS BIGINT) AS train_rows, CAST(features AS BIGINT) AS features,
  true AS optimal FROM valid, doc_count, varying WHERE length(t) > 5 AND split = 'test'"""

MIRROR_CTE = f"""{REVIEWS_CTE},
m AS (SELECT review_id, {label_sql(rating_sql("rating", False))} AS label,
  concat_ws(' ', NULLIF({clean_sql("title")}, ''), NULLIF({clean_sql("body")}, '')) AS review_combined
  FROM reviews),
mdocs AS (SELECT review_id, review_combined FROM m WHERE label IS NOT NULL AND length(review_combined) > 5),
mtoks AS (SELECT review_id, {stop_filter_sql("regexp_extract_all(lower(review_combined), '\\b\\w\\w+\\b')")} AS f
  FROM mdocs),
mg AS (SELECT review_id, {grams_sql("f")} AS g FROM mtoks),
mtf AS (SELECT review_id, term, count(*) AS tf FROM (SELECT review_id, unnest(g) AS term FROM mg) GROUP BY ALL),
mdf AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM mtf GROUP BY term),
vocab AS (SELECT term, df FROM mdf WHERE df >= 2 ORDER BY cf DESC, term ASC LIMIT 65536),
mn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM mdocs),
raw AS (SELECT mtf.review_id, mtf.term, (1.0 + ln(mtf.tf)) * (ln((1.0 + mn.n) / (1.0 + vocab.df)) + 1.0) AS w
  FROM mtf JOIN vocab ON mtf.term = vocab.term, mn)"""

ORACLES["tfidf_l2"] = f"""WITH {MIRROR_CTE}
SELECT review_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY review_id)), 6) AS weight FROM raw"""

ORACLES["mirror_scores"] = f"""WITH {MIRROR_CTE},
weighted AS (SELECT review_id, sum(w * (((length(term) * 37 + ascii(term) * 11) % 21 - 10) / 4.0)) AS dot,
  sqrt(sum(w * w)) AS norm FROM raw GROUP BY review_id),
margins AS (SELECT review_id, coalesce(dot / NULLIF(norm, 0), 0.0) + 0.125 AS m FROM mdocs LEFT JOIN weighted USING (review_id)),
p AS (SELECT review_id, m > 0 AS positive, round(1.0 / (1.0 + exp(-m)), 4) AS prob_positive,
  round(1.0 - 1.0 / (1.0 + exp(-m)), 4) AS prob_negative FROM margins)
SELECT review_id, CASE WHEN positive THEN 'positive' ELSE 'negative' END AS sentiment, CAST(positive AS INTEGER) AS label,
  CASE WHEN positive THEN prob_positive ELSE prob_negative END AS confidence, prob_positive, prob_negative FROM p"""

ORACLES["clean_unicode"] = f"""WITH {REVIEWS_CTE}
SELECT review_id, {clean_sql("strip_accents(lower(body))")} AS text_clean FROM reviews"""

ORACLES["clean_folded"] = f"""WITH {REVIEWS_CTE}
SELECT review_id, {clean_sql(f"translate(lower(body), '{ACCENTED_LETTERS}', '{FOLDED_LETTERS}')")} AS text_clean
FROM reviews"""


# --- scoring shapes, requests, lines, gate ---------------------------------------


PY_WS = r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{PY_WS}+|{PY_WS}+$', '', 'g')"


SHAPED_CTE = f"""{SCORES_CTE},
shaped AS (SELECT review_id, label AS pred_label, score,
  CASE WHEN prediction = 1 THEN 'positive' ELSE 'negative' END AS sentiment,
  prediction AS label, round(score, 4) AS prob_positive, round(1.0 - round(score, 4), 4) AS prob_negative
  FROM scores),
shaped2 AS (SELECT review_id, sentiment, label,
  round(CASE WHEN label = 1 THEN prob_positive ELSE prob_negative END, 4) AS confidence,
  prob_positive, prob_negative FROM shaped)"""

ORACLES["score_shape"] = f"WITH {SHAPED_CTE} SELECT * FROM shaped2"

ORACLES["batch_summary"] = f"""WITH {SCORES_CTE}
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count_if(prediction = 1) AS BIGINT) AS positive_count,
  CAST(count(*) - count_if(prediction = 1) AS BIGINT) AS negative_count,
  round(count_if(prediction = 1) / NULLIF(CAST(count(*) AS DOUBLE), 0), 4) AS positive_ratio FROM scores"""

ORACLES["percent_summary"] = f"""WITH {SCORES_CTE},
s AS (SELECT count(*) AS total, count_if(prediction = 1) AS pos FROM scores)
SELECT CAST(total AS BIGINT) AS total, CAST(pos AS BIGINT) AS positive_count, CAST(total - pos AS BIGINT) AS negative_count,
  printf('%.0f%%', round_even(pos / NULLIF(CAST(total AS DOUBLE), 0) * 100.0, 0)) AS positive_pct,
  printf('%.0f%%', round_even((total - pos) / NULLIF(CAST(total AS DOUBLE), 0) * 100.0, 0)) AS negative_pct FROM s"""

ORACLES["score_checks"] = f"""WITH {SHAPED_CTE}
SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(count_if(abs(prob_positive + prob_negative - 1.0) > 0.01) AS BIGINT) AS bad_probability_sum,
  CAST(count_if(abs(confidence - CASE WHEN label = 1 THEN prob_positive ELSE prob_negative END) > 1e-9) AS BIGINT) AS bad_confidence,
  CAST(count_if(label NOT IN (0, 1) OR label IS NULL) AS BIGINT) AS bad_label,
  CAST(count_if(confidence < 0.0 OR confidence > 1.0) AS BIGINT) AS bad_confidence_range,
  CAST(count_if(label = 1) AS BIGINT) AS positive_count,
  coalesce(count_if(label = 1) / NULLIF(CAST(count(*) AS DOUBLE), 0) BETWEEN 0.0 AND 1.0, true) AS ratio_in_range
FROM shaped2"""

ORACLES["display_rows"] = f"""WITH {SHAPED_CTE}
SELECT s.review_id,
  CASE WHEN length(d.text) > 120 THEN substr(d.text, 1, 120) || '…' ELSE d.text END AS review,
  s.sentiment, printf('%.1f%%', round_even(s.confidence * 100.0, 1)) AS confidence_text
FROM shaped2 s JOIN documents d ON s.review_id = d.doc_id"""

ORACLES["validate_requests"] = f"""WITH {REVIEWS_CTE},
r AS (SELECT review_id, body AS text, {strip_sql("coalesce(title, '')")} AS title_s, {strip_sql("body")} AS text_s,
  CASE WHEN body IS NULL THEN 'missing_text' WHEN length(body) < 5 THEN 'too_short'
       WHEN {strip_sql("body")} = '' THEN 'blank' END AS reject_reason FROM reviews)
SELECT review_id, reject_reason,
  CASE WHEN reject_reason IS NULL THEN concat_ws(' ', NULLIF(title_s, ''), NULLIF(text_s, '')) END AS review_text
FROM r"""

ORACLES["stream_requests"] = f"""WITH {REVIEWS_CTE},
r AS (SELECT review_id, CASE WHEN body IS NULL THEN 'missing_text' WHEN length(body) < 5 THEN 'too_short'
  WHEN {strip_sql("body")} = '' THEN 'blank' END AS reject_reason FROM reviews)
SELECT review_id, reject_reason, reject_reason IS NULL AS scored FROM r"""

LINE_BREAK_SQL = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
ORACLES["line_source"] = f"""WITH l AS (SELECT doc_id, string_split_regex(text, '{LINE_BREAK_SQL}') AS parts FROM documents),
u AS (SELECT doc_id, unnest(range(0, len(parts))) AS line_no, unnest(parts) AS raw FROM l)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, {strip_sql("raw")} AS line FROM u
WHERE {strip_sql("raw")} <> ''"""

GOLDEN_SCORED_CTE = f"""{SHAPED_CTE}, {GOLDEN_CTE},
gs AS (SELECT g.id, g.category, g.expected_label, s.label AS prediction, s.confidence
  FROM golden g LEFT JOIN shaped2 s ON g.id = s.review_id)"""

ORACLES["golden_gate"] = f"""WITH {GOLDEN_SCORED_CTE},
a AS (SELECT count(*) AS n, count_if(expected_label = prediction) AS correct,
  count_if(category = 'clear_positive') AS n_pos, count_if(category = 'clear_negative') AS n_neg,
  count_if(category = 'clear_positive' AND prediction IS DISTINCT FROM 1) AS bad_pos,
  count_if(category = 'clear_negative' AND prediction IS DISTINCT FROM 0) AS bad_neg,
  min(CASE WHEN category IN ('clear_positive', 'clear_negative') THEN confidence END) AS min_conf,
  count_if(category IN ('clear_positive', 'clear_negative') AND coalesce(confidence < 0.65, true)) AS low_conf FROM gs)
SELECT 'accuracy' AS rule, round(correct / NULLIF(CAST(n AS DOUBLE), 0), 4) AS observed, CAST(0.8 AS DOUBLE) AS threshold,
  coalesce(correct / NULLIF(CAST(n AS DOUBLE), 0) >= 0.8, false) AS passed, CAST(n - correct AS BIGINT) AS failing FROM a
UNION ALL SELECT 'clear_positive_all_positive', round(1.0 - bad_pos / NULLIF(CAST(n_pos AS DOUBLE), 0), 4), 1.0, bad_pos = 0, CAST(bad_pos AS BIGINT) FROM a
UNION ALL SELECT 'clear_negative_all_negative', round(1.0 - bad_neg / NULLIF(CAST(n_neg AS DOUBLE), 0), 4), 1.0, bad_neg = 0, CAST(bad_neg AS BIGINT) FROM a
UNION ALL SELECT 'clear_confidence_floor', round(min_conf, 4), 0.65, low_conf = 0, CAST(low_conf AS BIGINT) FROM a
UNION ALL SELECT 'clear_positive_present', round(CAST(n_pos AS DOUBLE), 4), 1.0, n_pos >= 1, CAST(0 AS BIGINT) FROM a
UNION ALL SELECT 'clear_negative_present', round(CAST(n_neg AS DOUBLE), 4), 1.0, n_neg >= 1, CAST(0 AS BIGINT) FROM a"""

ORACLES["edge_gate_scores"] = f"""WITH {SCORES_CTE},
sent AS (SELECT doc_id AS id, c AS edge FROM documents, (SELECT unnest(['missing_title', 'repeated_text', 'mixed_batch']) AS c)
  UNION ALL SELECT doc_id, 'other_language' FROM documents WHERE lang <> 'en'),
back AS (SELECT s.id, s.edge, g.prediction FROM sent s JOIN scores g ON g.review_id = s.id),
n AS (SELECT edge, count(*) AS n FROM sent GROUP BY edge),
lost AS (SELECT edge, count(*) AS lost FROM sent s WHERE NOT EXISTS (SELECT 1 FROM scores g WHERE g.review_id = s.id) GROUP BY edge),
ratio AS (SELECT round(count_if(prediction = 1) / CAST(count(*) AS DOUBLE), 4) AS r FROM back)
SELECT 'scores_' || edge AS rule, CAST(n AS DOUBLE) AS observed, 1.0::DOUBLE AS threshold, coalesce(lost, 0) = 0 AS passed,
  CAST(coalesce(lost, 0) AS BIGINT) AS failing FROM n LEFT JOIN lost USING (edge)
UNION ALL SELECT 'no_extra_rows', 0.0, 0.0, true, 0
UNION ALL SELECT 'mixed_batch_ratio', r, 0.5, coalesce(r > 0 AND r < 1, false), 0 FROM ratio"""

ORACLES["golden_failures"] = f"""WITH {GOLDEN_SCORED_CTE},
r AS (SELECT *, CASE WHEN prediction IS NULL OR confidence IS NULL THEN 'not_scored'
  WHEN expected_label <> prediction THEN 'wrong_label'
  WHEN category IN ('clear_positive', 'clear_negative') AND confidence < 0.65 THEN 'low_confidence' END AS reason FROM gs)
SELECT id, category, expected_label, prediction, confidence, reason FROM r WHERE reason IS NOT NULL"""

ORACLES["run_compare"] = f"""WITH {SCORES_CTE},
f AS (SELECT *, CAST(('0x' || substr(md5('42:' || CAST(review_id AS VARCHAR)), 9, 8))::BIGINT % 3 AS INTEGER) AS fold FROM scores),
c AS (SELECT fold, count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
  count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 0 AND prediction = 0) AS tn FROM f GROUP BY fold),
m AS (SELECT fold, {_metrics_sql("tp", "fp", "fn", "tn")} FROM c),
h AS (SELECT fold AS run_id, 'accuracy' AS metric, accuracy AS value FROM m
  UNION ALL SELECT fold, 'precision', precision FROM m
  UNION ALL SELECT fold, 'recall', recall FROM m
  UNION ALL SELECT fold, 'f1_score', f1_score FROM m),
l AS (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY run_id) AS prev FROM h)
SELECT run_id, metric, round(value, 4) AS value, round(prev, 4) AS previous, round(value - prev, 4) AS delta,
  coalesce(-(value - prev) > 0.01, false) AS regressed FROM l"""

ORACLES["stream_summary"] = ORACLES["batch_summary"]

# CSV keeps no difference between NULL and '': with default options the reader
# returns NULL for an empty field, quoted or not.
ORACLES["csv_roundtrip"] = f"""WITH {REVIEWS_CTE},
r AS (SELECT NULLIF(rating, '') AS rating, NULLIF(title, '') AS title, NULLIF(body, '') AS body,
  NULLIF(country, '') AS country FROM reviews)
SELECT md5({" || ".join(f"coalesce('V' || strlen({c}) || ':' || {c}, 'N')" for c in ("body", "country", "rating", "title"))})
  || '-' || (row_number() OVER (PARTITION BY rating, title, body, country) - 1) AS review_id,
  rating, title, body, country FROM r"""

DAMAGED_CTE = r"""lines AS (
  SELECT doc_id % 10 AS kind, regexp_replace(coalesce(text, ''), '[\r\n",\\]', ' ', 'g') AS t FROM documents),
damaged AS (
  SELECT CASE kind WHEN 1 THEN 'short' WHEN 2 THEN 'surplus' WHEN 3 THEN 'unclosed_quote' ELSE 'good' END AS reason,
    CASE kind WHEN 1 THEN '5,"' || t || '"' WHEN 2 THEN '5,t,"' || t || '",EN,more,x' WHEN 3 THEN '5,t,"' || t || ',EN'
    END AS raw_line FROM lines)"""
ORACLES["quarantine_ledger"] = f"""WITH {DAMAGED_CTE}
SELECT coalesce(reason, 'all') AS reason, count(*)::BIGINT AS rows FROM damaged GROUP BY ROLLUP(reason)"""
ORACLES["quarantined_lines"] = f"WITH {DAMAGED_CTE} SELECT raw_line, reason FROM damaged WHERE reason <> 'good'"

ORACLES["roc_compact"] = f"""WITH {PREFIX_CTE},
q AS (SELECT *, lag(pos) OVER (ORDER BY score) AS prev_pos, lag(neg) OVER (ORDER BY score) AS prev_neg,
  lead(score) OVER (ORDER BY score) AS next_score FROM p)
SELECT 'inf'::DOUBLE AS threshold, CAST(0 AS BIGINT) AS tp, CAST(0 AS BIGINT) AS fp, 0.0 AS tpr, 0.0 AS fpr
UNION ALL
SELECT score, CAST(pos_total - pos_before AS BIGINT), CAST(neg_total - neg_before AS BIGINT),
  round((pos_total - pos_before) / NULLIF(CAST(pos_total AS DOUBLE), 0), 6),
  round((neg_total - neg_before) / NULLIF(CAST(neg_total AS DOUBLE), 0), 6) FROM q
WHERE next_score IS NULL OR prev_pos IS NULL OR pos <> prev_pos OR neg <> prev_neg"""
