"""Building blocks of the SQL twins, written independently of the Spark operators.

Valid for an ANSI engine in which the given tables are views. ``sql(body, ...)`` puts the named
common table expressions, in order, before ``body``.
"""

from __future__ import annotations

from collections.abc import Sequence

from reviewlens.schema import V1_RULES, V2_RULES

PRODUCT = "CASE WHEN d.doc_id % 7 = 3 THEN 0 ELSE d.doc_id // 20 END"

REVIEWS = f"""
base AS (
  SELECT d.doc_id, d.text, d.lang, d.source, p.p_partkey, p.p_name, p.p_type, p.p_brand
  FROM documents d JOIN part p ON p.p_partkey = {PRODUCT}
), one AS (
  SELECT CASE WHEN doc_id % 9 = 4 THEN 'shopee' ELSE 'tiki' END AS platform,
    CAST(doc_id AS STRING) AS review_id,
    CAST(p_partkey AS STRING) AS product_id,
    p_name || ' ' || p_type || ' ' || p_brand || ' limited collector edition no ' || CAST(p_partkey AS STRING) AS product_name,
    'https://tiki.vn/product-p' || CAST(p_partkey AS STRING) || '.html' AS product_url,
    CASE WHEN doc_id % 11 = 0 THEN NULL ELSE p_type END AS category_name,
    p_type AS category_id,
    CAST(doc_id % 6 AS INT) AS rating,
    CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS title,
    CASE CAST(doc_id % 8 AS INT)
      WHEN 0 THEN 'ok'
      WHEN 1 THEN 'Sản phẩm tốt, giao hàng nhanh. ' || text
      WHEN 2 THEN 'Chất lượng tệ, kém. ' || text
      WHEN 3 THEN 'KHÔNG TỐT ' || text
      WHEN 4 THEN 'good but bad ' || text
      WHEN 5 THEN ''
      WHEN 6 THEN 'notebook cover ' || text
      ELSE text END AS content,
    CASE WHEN doc_id % 13 = 0 THEN NULL ELSE 'user' || CAST(doc_id % 17 AS STRING) END AS reviewer_name,
    CASE CAST(doc_id % 5 AS INT)
      WHEN 0 THEN ''
      WHEN 1 THEN '1753674740'
      WHEN 2 THEN '2020-01-01T00:00:00'
      WHEN 3 THEN '2020-01-01T00:00:00Z'
      ELSE '2025-11-05T07:58:35' END AS create_time,
    CAST(1762500000 + doc_id + (doc_id % 7) * 60 AS DOUBLE) AS crawled_at,
    CAST('category' AS STRING) AS source_type,
    p_type AS source_id
  FROM base
), reviews AS (
  SELECT * FROM one
  UNION ALL
  SELECT platform, review_id, product_id, product_name, product_url, category_name, category_id,
         CAST(5 AS INT) AS rating, title, content, reviewer_name, create_time,
         crawled_at + 100000 AS crawled_at, source_type, source_id
  FROM one WHERE CAST(review_id AS BIGINT) % 10 = 0
)"""

# First arrival per id.
RAW = """
raw AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY crawled_at) AS rn FROM reviews) r
  WHERE rn = 1
)"""


def _hits(words: Sequence[str]) -> str:
    return " + ".join(f"CASE WHEN position('{word}' IN lower(content)) > 0 THEN 1 ELSE 0 END" for word in words)


POS_V2, NEG_V2 = _hits(V2_RULES.positive_words), _hits(V2_RULES.negative_words)
POS_V1, NEG_V1 = _hits(V1_RULES.positive_words), _hits(V1_RULES.negative_words)


def rules(source: str, name: str = "scored") -> str:
    """The rule verdict on every row of ``source``: 0 negative, 1 positive, 2 neutral."""
    return f"""
{name}_hits AS (SELECT *, {POS_V2} AS pos, {NEG_V2} AS neg FROM {source}),
{name} AS (
  SELECT *, CASE WHEN rating >= 4 OR pos > neg THEN 1 WHEN rating <= 2 OR neg > pos THEN 0 ELSE 2 END AS pred_label
  FROM {name}_hits
)"""


def ratings(source: str, name: str) -> str:
    """The rating-only verdict."""
    return f"""
{name} AS (
  SELECT *, CASE WHEN rating >= 4 THEN 1 WHEN rating <= 2 THEN 0 ELSE 2 END AS pred_label FROM {source}
)"""


def text_rules(source: str, name: str = "scored") -> str:
    """The stand-in model's verdict: words of ``content`` alone."""
    return f"""
{name}_words AS (SELECT *, {POS_V2} AS pos, {NEG_V2} AS neg FROM {source}),
{name} AS (
  SELECT *, CASE WHEN pos > neg THEN 1 WHEN pos < neg THEN 0 ELSE 2 END AS pred_label FROM {name}_words
)"""


LABEL = "CASE pred_label WHEN 1 THEN 'Tốt' WHEN 0 THEN 'Không tốt' ELSE 'Trung bình' END"
PROBA = (
    "CASE pred_label WHEN 1 THEN '[0.1, 0.8, 0.1]' WHEN 0 THEN '[0.8, 0.1, 0.1]' ELSE '[0.2, 0.2, 0.6]' END"
)


def records(source: str, model: str, name: str) -> str:
    """Prediction records of every long enough row of a scored source."""
    return f"""
{name} AS (
  SELECT review_id, platform, product_id, category_id, category_name, rating,
    coalesce(reviewer_name, 'Anonymous') AS reviewer_name, title, content,
    title || ' ' || content AS text,
    CAST(pred_label AS INT) AS pred_label, {LABEL} AS pred_label_vn, {PROBA} AS pred_proba_vec,
    '{model}' AS model, CAST(1762508000 + CAST(review_id AS BIGINT) AS BIGINT) AS ts
  FROM {source} WHERE length(content) > 3
)"""


SCORED = rules("raw")
PRED = records("scored", "baseline", "pred")

# Long enough scored reviews with their product names.
EVAL = f"""
eval AS (SELECT *, {LABEL} AS pred_label_vn FROM scored WHERE length(content) > 3)"""

ODD = "substring(md5(review_id), 32, 1) IN ('1','3','5','7','9','b','d','f')"
SPLIT = ",".join(
    [
        f"\nhalf_a AS (SELECT * FROM raw WHERE NOT ({ODD}))",
        f"\nhalf_b AS (SELECT * FROM raw WHERE {ODD})",
        rules("half_a", "scored_a"),
        ratings("half_b", "scored_b"),
        records("scored_a", "baseline", "pred_a"),
        records("scored_b", "phobert", "pred_b"),
        "\nsplit AS (SELECT * FROM pred_a UNION ALL SELECT * FROM pred_b)",
    ]
)

V1 = f"""
v1_hits AS (SELECT *, {POS_V1} AS pos, {NEG_V1} AS neg FROM raw),
v1_scored AS (
  SELECT *, CASE WHEN rating >= 4 OR pos > neg THEN 2 WHEN rating <= 2 OR neg > pos THEN 0 ELSE 1 END AS cls
  FROM v1_hits
), v1 AS (
  SELECT review_id, CAST(cls AS INT) AS predicted_sentiment,
    CASE cls WHEN 2 THEN 'positive' WHEN 0 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
    CAST(CASE cls WHEN 1 THEN 0.5 ELSE 0.6 END AS DOUBLE) AS confidence,
    CAST(CASE cls WHEN 2 THEN 0.1 WHEN 0 THEN 0.6 ELSE 0.25 END AS DOUBLE) AS pred_proba_negative,
    CAST(CASE cls WHEN 1 THEN 0.5 ELSE 0.3 END AS DOUBLE) AS pred_proba_neutral,
    CAST(CASE cls WHEN 2 THEN 0.6 WHEN 0 THEN 0.1 ELSE 0.25 END AS DOUBLE) AS pred_proba_positive,
    'baseline' AS model,
    strftime(to_timestamp(1762508000 + CAST(review_id AS BIGINT)) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') AS timestamp,
    platform, coalesce(category_name, 'Unknown') AS category_name, product_name, product_id,
    coalesce(reviewer_name, 'Anonymous') AS reviewer_name, content, title, rating,
    CAST(length(content) AS INT) AS content_length, TRUE AS flink_processed
  FROM v1_scored WHERE length(content) > 3
)"""


def sql(body: str, *ctes: str) -> str:
    return f"WITH {','.join(ctes)}\n{body}" if ctes else body


def on_reviews(body: str, *more: str) -> str:
    return sql(body, REVIEWS, *more)


def on_raw(body: str, *more: str) -> str:
    return sql(body, REVIEWS, RAW, *more)


def on_scored(body: str, *more: str) -> str:
    return sql(body, REVIEWS, RAW, SCORED, *more)


def on_pred(body: str, *more: str) -> str:
    return sql(body, REVIEWS, RAW, SCORED, PRED, *more)


def on_eval(body: str, *more: str) -> str:
    return sql(body, REVIEWS, RAW, SCORED, EVAL, *more)


def on_split(body: str, *more: str) -> str:
    return sql(body, REVIEWS, RAW, SPLIT, *more)


def on_v1(body: str, *more: str) -> str:
    return sql(body, REVIEWS, RAW, V1, *more)


def arrivals_scored(body: str, *more: str) -> str:
    """Over the rule verdicts of every arrival, repeats included."""
    return sql(body, REVIEWS, rules("reviews"), *more)


# The arrival that came last per id.
LAST = """
last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY crawled_at DESC) AS rn FROM reviews) r
  WHERE rn = 1 AND length(content) > 3
)"""


def on_last(body: str, *more: str) -> str:
    """Over the rule verdicts of the last arrival per id."""
    return sql(body, REVIEWS, LAST, rules("last"), *more)
