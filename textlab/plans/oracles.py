"""DuckDB SQL oracles, one per registered query that SQL can express.

The base tables are DuckDB views of the same parquet files. The review-shaped
views are rebuilt here as CTEs with the same formulas as
``textlab.sources.views``. DuckDB regex replacement needs the ``'g'`` flag.
"""

from __future__ import annotations

from textlab.functions.stopwords import english_stop_words, sql_string_list

# --- shared SQL fragments ----------------------------------------------------


def clean_sql(x: str) -> str:
    return (
        "trim(regexp_replace(regexp_replace(regexp_replace(lower(" + x + "), "
        "'<[^>]+>', ' ', 'g'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
    )


def rating_sql(x: str, zero_is_null: bool = True) -> str:
    r = f"TRY_CAST(regexp_extract({x}, '(\\d)', 1) AS INTEGER)"
    return f"NULLIF({r}, 0)" if zero_is_null else r


def label_sql(r: str) -> str:
    return f"(CASE WHEN {r} >= 4 THEN 1 WHEN {r} <= 2 THEN 0 END)"


REVIEWS_CTE = """reviews AS (
  SELECT doc_id AS review_id,
    CASE WHEN doc_id % 8 < 5 THEN 'Rated ' || CAST(doc_id % 8 + 1 AS VARCHAR) || ' out of 5 stars'
         WHEN doc_id % 8 = 5 THEN NULL
         WHEN doc_id % 8 = 6 THEN 'no rating'
         ELSE 'Rated 0 out of 5 stars' END AS rating,
    CASE WHEN doc_id % 11 = 0 THEN '<b>' || text || '</b>'
         WHEN doc_id % 5 = 0 THEN NULL
         WHEN doc_id % 5 = 1 THEN ''
         ELSE '<b>' || substr(text, 1, 40) || '</b>' END AS title,
    CASE WHEN doc_id % 11 = 0 THEN NULL
         WHEN doc_id % 5 <= 1 THEN '<br>' || text
         ELSE '<br>' || substr(text, 41) END AS body,
    upper(lang) AS country
  FROM documents)"""

LABELLED_CTE = (
    REVIEWS_CTE
    + """,
labelled AS (
  SELECT *, """
    + label_sql("rating_numeric")
    + """ AS label FROM (
    SELECT review_id, title, body, country, """
    + rating_sql("rating")
    + """ AS rating_numeric FROM reviews))"""
)

COMBINED_CTE = (
    LABELLED_CTE
    + """,
combined AS (
  SELECT review_id, label, rating_numeric, country,
    concat_ws(' ', """
    + clean_sql("title")
    + ", "
    + clean_sql("body")
    + """) AS review_combined
  FROM labelled)"""
)

CLEAN_CTE = (
    COMBINED_CTE
    + """,
clean AS (
  SELECT review_id, review_combined, CAST(label AS DOUBLE) AS label, rating_numeric, country
  FROM combined WHERE label IS NOT NULL AND length(review_combined) > 5)"""
)

SCORES_CTE = """scores AS (
  SELECT doc_id AS review_id, CAST(quality AS INTEGER) AS label,
    CAST((doc_id * 7919) % 200 AS DOUBLE) / 200.0 AS score,
    CASE WHEN CAST((doc_id * 7919) % 200 AS DOUBLE) / 200.0 > 0.5 THEN 1 ELSE 0 END AS prediction
  FROM labels)"""

GOLDEN_CTE = """golden AS (
  SELECT doc_id AS id, '' AS title, text,
    CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS expected_label,
    CASE WHEN n_chars < 400 THEN 'edge_case_short'
         WHEN lang = 'en' THEN 'clear_positive' ELSE 'clear_negative' END AS category
  FROM documents)"""


def stop_list_sql(keep_negations: bool = False) -> str:
    return "[" + sql_string_list(english_stop_words(keep_negations)) + "]"


# --- oracles -----------------------------------------------------------------

ORACLES: dict[str, str] = {}

ORACLES["clean_reviews"] = f"WITH {CLEAN_CTE} SELECT * FROM clean"

ORACLES["null_profile"] = f"""WITH {REVIEWS_CTE},
t AS (SELECT count(*) AS total_rows,
  count_if(rating IS NULL OR rating = '') AS n0,
  count_if(title IS NULL OR title = '') AS n1,
  count_if(body IS NULL OR body = '') AS n2 FROM reviews),
u AS (SELECT 'rating' AS column_name, n0 AS null_or_empty, total_rows FROM t
  UNION ALL SELECT 'title', n1, total_rows FROM t
  UNION ALL SELECT 'body', n2, total_rows FROM t)
SELECT column_name, CAST(null_or_empty AS BIGINT) AS null_or_empty, CAST(total_rows AS BIGINT) AS total_rows,
  round(coalesce(null_or_empty * 100.0 / NULLIF(total_rows, 0), 0.0), 4) AS pct_null_or_empty FROM u"""

ORACLES["rating_distribution"] = f"""WITH {REVIEWS_CTE}
SELECT rating, CAST(count(*) AS BIGINT) AS n FROM reviews GROUP BY rating ORDER BY rating NULLS FIRST"""

ORACLES["drop_reasons"] = f"""WITH {COMBINED_CTE}
SELECT CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count_if(label IS NULL) AS BIGINT) AS null_label,
  CAST(count_if(length(review_combined) <= 5) AS BIGINT) AS short_text,
  CAST(count_if(label IS NULL AND length(review_combined) <= 5) AS BIGINT) AS both,
  CAST(count_if(label IS NULL OR length(review_combined) <= 5) AS BIGINT) AS dropped,
  CAST(count_if(NOT (label IS NULL OR length(review_combined) <= 5)) AS BIGINT) AS kept
FROM combined"""

ORACLES["parse_label"] = f"""WITH {REVIEWS_CTE}
SELECT review_id, rating, rating_numeric, {label_sql("rating_numeric")} AS label
FROM (SELECT review_id, rating, {rating_sql("rating")} AS rating_numeric FROM reviews)"""

ORACLES["parse_label_mirror"] = f"""WITH {REVIEWS_CTE}
SELECT review_id, rating_numeric, {label_sql("rating_numeric")} AS label
FROM (SELECT review_id, {rating_sql("rating", False)} AS rating_numeric FROM reviews)"""

ORACLES["clean_text"] = f"""WITH {REVIEWS_CTE}
SELECT review_id, {clean_sql("title")} AS title_clean, {clean_sql("body")} AS text_clean FROM reviews"""

ORACLES["clean_pages"] = f"""SELECT page_id, html_clean, CAST(length(html_clean) AS BIGINT) AS n_chars
FROM (SELECT page_id, {clean_sql("html")} AS html_clean FROM pages)"""

ORACLES["combine_exact"] = f"""WITH {COMBINED_CTE}
SELECT review_id, review_combined, CAST(length(review_combined) AS INTEGER) AS n_chars FROM combined"""

ORACLES["combine_trimmed"] = f"""WITH {REVIEWS_CTE},
m AS (SELECT review_id, {label_sql(rating_sql("rating", False))} AS label,
  concat_ws(' ', NULLIF({clean_sql("title")}, ''), NULLIF({clean_sql("body")}, '')) AS review_combined
  FROM reviews)
SELECT review_id, review_combined, (label IS NOT NULL AND length(review_combined) > 5) AS kept FROM m"""

ORACLES["class_balance"] = f"""WITH {CLEAN_CTE},
per AS (SELECT label, CAST(count(*) AS BIGINT) AS n FROM clean GROUP BY label)
SELECT label, n, round(n * 100.0 / sum(n) OVER (), 4) AS pct FROM per"""

ORACLES["country_rollup"] = f"""WITH {CLEAN_CTE}
SELECT country, rating_numeric, CAST(grouping_id(country, rating_numeric) AS INTEGER) AS gid,
  CAST(count(*) AS BIGINT) AS n, round(avg(label), 6) AS positive_rate
FROM clean GROUP BY ROLLUP (country, rating_numeric)"""

ORACLES["label_domain"] = f"WITH {CLEAN_CTE} SELECT DISTINCT label FROM clean WHERE label IS NOT NULL"


def all_oracles() -> dict[str, str]:
    # modules below add more oracles
    from textlab.plans import oracles_more  # noqa: F401

    return dict(ORACLES)
