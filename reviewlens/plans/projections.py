"""Projections, filters and scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from reviewlens import functions as R
from reviewlens.operators.documents import canonicalize
from reviewlens.operators.filters import (
    brand_match, by_product, filter_content, filter_recent, filter_text, recent, search_products, where_eq,
)
from reviewlens.operators.normalize import normalize, resolve_category
from reviewlens.operators.scoring import score_rules
from reviewlens.operators.views import content_display, display_predictions, display_reviews, fill_reviewer
from reviewlens.plans.catalog import query
from reviewlens.plans.data import (
    product_of,
    arrivals, cycle, predictions, predictions_v1, raw, split_predictions, table,
)
from reviewlens.plans.ingest import landed_review_pages
from reviewlens.plans.oracle import (
    PRED, PRODUCT, RAW, REVIEWS, SCORED, V1, on_pred, on_reviews, on_split, on_v1, sql,
)
from reviewlens.schema import LABEL_TRANSLATIONS, LABELS
from reviewlens.sources.pages import explode_pages

AS_OF = datetime(2025, 11, 30)
CRAWL_AS_OF = datetime(2025, 11, 7, 7, 30)
STOPWORDS = ("the", "and", "of", "de", "la", "der", "que")


def products(spark, sf_dir):
    """Every part as a shop product; its categories come in six shapes."""
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "doc_id")
    doc, kind = F.col("doc_id"), F.col("p_type")
    named = F.to_json(F.struct(doc.alias("id"), kind.alias("name")))
    shapes = cycle(
        6,
        {
            0: named,
            1: F.concat(F.lit("["), named, F.lit(',{"id":1,"name":"x"}]')),
            2: "[]",
            3: F.to_json(F.struct(kind.alias("name"))),
            4: F.concat(F.lit('["'), kind, F.lit('"]')),
        },
        F.lit(None).cast("string"),
    )
    return part.select(
        doc.alias("id"),
        F.when(doc % 7 != 0, F.col("p_name")).alias("name"),
        F.col("p_brand").alias("brand_name"),
        F.struct(F.lower(F.regexp_replace("p_brand", "#", "-")).alias("slug")).alias("brand"),
        F.try_parse_json(shapes).alias("categories"),
        kind.alias("p_type"),
    )


def _source_type():
    return F.when(F.col("doc_key") % 3 == 0, "brand").when(F.col("doc_key") % 3 == 1, "store").otherwise("category")


CATEGORY_ID = """CASE WHEN k % 6 IN (0, 1) THEN CAST(k AS VARCHAR) WHEN k % 6 IN (3, 4) THEN 'unknown'
  WHEN k % 3 = 2 THEN 'src' ELSE 'unknown' END"""
CATEGORY_NAME = "CASE WHEN k % 6 IN (0, 1) THEN p_type ELSE 'Unknown' END"


@query(
    "normalize_reviews",
    f"""
WITH j AS (SELECT d.*, p.*, p.p_partkey AS k FROM documents d JOIN part p ON p.p_partkey = {PRODUCT})
SELECT 'tiki' AS platform, CASE WHEN doc_id = 0 THEN '' ELSE CAST(doc_id AS VARCHAR) END AS review_id,
  CASE WHEN k = 0 THEN '' ELSE CAST(k AS VARCHAR) END AS product_id,
  CASE WHEN k % 7 = 0 THEN '' ELSE p_name END AS product_name,
  CASE WHEN k = 0 THEN '' ELSE 'https://tiki.vn/product-p' || CAST(k AS VARCHAR) || '.html' END AS product_url,
  {CATEGORY_ID} AS category_id, {CATEGORY_NAME} AS category_name,
  CAST(doc_id % 6 AS INT) AS rating, CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS title,
  CASE WHEN doc_id % 8 = 5 THEN md5('') ELSE md5(text) END AS content_md5,
  CASE WHEN doc_id % 13 = 0 THEN 'Anonymous' ELSE 'user' || CAST(doc_id % 17 AS VARCHAR) END AS reviewer_name,
  CASE WHEN doc_id % 5 = 0 THEN '' ELSE CAST(1753674740 + doc_id AS VARCHAR) END AS create_time,
  CAST(1762500000 + doc_id AS DOUBLE) AS crawled_at,
  CASE k % 3 WHEN 0 THEN 'brand' WHEN 1 THEN 'store' ELSE 'category' END AS source_type, 'src' AS source_id
FROM j""",
)
def normalize_reviews(spark, sf_dir):
    api = explode_pages(landed_review_pages(spark, sf_dir), "reviews")
    api = api.withColumn("doc_key", product_of(F.col("id")))
    api = api.withColumn("product_id", F.col("doc_key"))
    flat = normalize(api, products(spark, sf_dir), _source_type(), F.lit("src"), F.lit(1_762_500_000) + F.col("id"))
    return flat.withColumn("content", F.md5("content")).withColumnRenamed("content", "content_md5")


@query(
    "resolve_category",
    f"""
SELECT k, supplied, CASE WHEN k % 3 = 2 AND supplied <> '' THEN 'src' ELSE {CATEGORY_ID} END AS category_id,
  CASE WHEN k % 3 = 2 AND supplied <> '' THEN supplied ELSE {CATEGORY_NAME} END AS category_name
FROM (SELECT p_partkey AS k, p_type, CASE WHEN p_partkey % 5 = 0 THEN 'Given' ELSE '' END AS supplied FROM part) t""",
)
def resolve_category_query(spark, sf_dir):
    rows = products(spark, sf_dir).withColumn("doc_key", F.col("id"))
    rows = rows.withColumn("supplied", F.when(F.col("id") % 5 == 0, "Given").otherwise(""))
    found = resolve_category("categories", _source_type(), F.lit("src"), F.col("supplied"))
    return rows.withColumn("c", found).select(F.col("id").alias("k"), "supplied", "c.category_id", "c.category_name")


@query(
    "product_url",
    """
SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN ''
  ELSE 'https://tiki.vn/product-p' || CAST(p_partkey AS VARCHAR) || '.html' END AS product_url
FROM part""",
)
def product_url(spark, sf_dir):
    ident = F.when(F.col("p_partkey") % 10 == 0, "").otherwise(F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", R.product_url(ident).alias("product_url"))


SHOP_URL = """CASE page_id % 6 WHEN 0 THEN 'https://tiki.vn/thuong-hieu/b' || CAST(page_id AS VARCHAR) || '.html'
  WHEN 1 THEN 'https://tiki.vn/cua-hang/s' || CAST(page_id AS VARCHAR) || '-official/x'
  WHEN 2 THEN 'https://tiki.vn/thiet-bi/c' || CAST(page_id AS VARCHAR) || '?p=1'
  WHEN 3 THEN 'https://tiki.vn/camera' WHEN 4 THEN 'https://tiki.vn/x' ELSE url END"""


@query(
    "classify_source_url",
    f"""
SELECT page_id, u AS url,
  CASE WHEN contains(u, '/thuong-hieu/') THEN 'brand' WHEN contains(u, '/cua-hang/') THEN 'store'
    WHEN contains(u, '/c') THEN 'category' END AS source_type,
  CASE WHEN contains(u, '/thuong-hieu/') THEN nullif(regexp_extract(u, '/thuong-hieu/([^./]+)', 1), '')
    WHEN contains(u, '/cua-hang/') THEN nullif(regexp_extract(u, '/cua-hang/([^/]+)', 1), '')
    WHEN contains(u, '/c') THEN nullif(regexp_extract(u, '/c([0-9]+)', 1), '') END AS source_id
FROM (SELECT page_id, {SHOP_URL} AS u FROM pages) t""",
)
def classify_source_url(spark, sf_dir):
    urls = table(spark, sf_dir, "pages").select("page_id", F.expr(SHOP_URL.replace("VARCHAR", "STRING")).alias("url"))
    return urls.withColumn("c", R.classify_url(F.col("url"))).select("page_id", "url", "c.source_type", "c.source_id")


@query(
    "recent_reviews",
    on_reviews("""
SELECT review_id, crawled_at, create_time FROM reviews
WHERE NOT regexp_matches(create_time, '^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$')
  OR try_cast(create_time AS TIMESTAMP) >= TIMESTAMP '2024-11-30 00:00:00'"""),
)
def recent_reviews(spark, sf_dir):
    kept = filter_recent(arrivals(spark, sf_dir), 365, AS_OF)
    return kept.select("review_id", "crawled_at", "create_time")


@query(
    "recent_reviews_strict",
    on_reviews("""
SELECT review_id, crawled_at, create_time FROM reviews
WHERE CASE WHEN regexp_matches(create_time, '^[0-9]{10}$')
    THEN CAST(create_time AS BIGINT) >= 1761868800
  WHEN regexp_matches(create_time, '^[0-9]{4}-') THEN CAST(left(create_time, 19) AS TIMESTAMP) >= TIMESTAMP '2025-10-31 00:00:00'
  ELSE TRUE END"""),
)
def recent_reviews_strict(spark, sf_dir):
    kept = filter_recent(arrivals(spark, sf_dir), 30, AS_OF, mode="strict")
    return kept.select("review_id", "crawled_at", "create_time")


@query(
    "content_filter",
    on_reviews(
        "SELECT review_id, crawled_at, CAST(length(content) AS INT) AS chars FROM reviews WHERE length(content) > 3"
    ),
)
def content_filter(spark, sf_dir):
    return filter_content(arrivals(spark, sf_dir)).select(
        "review_id", "crawled_at", F.length("content").alias("chars")
    )


@query(
    "eval_text_filter",
    on_reviews(r"""
SELECT review_id, crawled_at FROM reviews
WHERE length(regexp_replace(title || ' ' || content, '^[ \t\n\r\f\v]+|[ \t\n\r\f\v]+$', '', 'g')) > 3"""),
)
def eval_text_filter(spark, sf_dir):
    return filter_text(arrivals(spark, sf_dir)).select("review_id", "crawled_at")


@query(
    "compose_text",
    on_reviews("SELECT review_id, crawled_at, md5(title || ' ' || content) AS text_md5 FROM reviews"),
)
def compose_text(spark, sf_dir):
    text = R.compose_text(F.col("title"), F.col("content"))
    return arrivals(spark, sf_dir).select("review_id", "crawled_at", F.md5(text).alias("text_md5"))


@query(
    "brand_filter",
    """
SELECT p_partkey, lower(p_brand) = 'brand#12' OR lower(replace(p_brand, '#', '-')) = 'brand#12'
    OR contains(lower(CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END), 'brand#12') AS long_brand,
  contains(lower(p_brand), '#1') AS short_brand,
  lower(replace(p_brand, '#', '-')) = 'brand-23' OR contains(lower(CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END), 'brand-23') AS slug_brand
FROM part""",
)
def brand_filter(spark, sf_dir):
    columns = (F.col("brand_name"), F.col("brand.slug"), F.col("name"))
    return products(spark, sf_dir).select(
        F.col("id").alias("p_partkey"),
        brand_match("Brand#12", *columns).alias("long_brand"),
        brand_match("#1", *columns).alias("short_brand"),
        brand_match("BRAND-23", *columns).alias("slug_brand"),
    )


@query(
    "prediction_doc_v2",
    on_pred("""
SELECT review_id, platform, product_id, category_id, category_name, rating, reviewer_name, title,
  md5(content) AS content_md5, md5(text) AS text_md5, pred_label, pred_label_vn, pred_proba_vec, model, ts
FROM pred"""),
)
def prediction_doc_v2(spark, sf_dir):
    hashed = {"content": "content_md5", "text": "text_md5"}
    rows = predictions(spark, sf_dir)
    return rows.withColumns({name: F.md5(name) for name in hashed}).withColumnsRenamed(hashed)


@query("prediction_doc_v1", on_v1("SELECT * REPLACE (md5(content) AS content) FROM v1"))
def prediction_doc_v1(spark, sf_dir):
    return predictions_v1(spark, sf_dir).withColumn("content", F.md5("content"))


def _cut(column: str, n: int) -> str:
    return f"CASE WHEN length({column}) > {n} THEN substring({column}, 1, {n}) || '...' ELSE {column} END"


@query(
    "display_projection",
    on_reviews(f"""
SELECT platform, coalesce(category_name, '') AS category_name, coalesce(reviewer_name, '') AS reviewer_name,
  {_cut("product_name", 40)} AS product_name, {_cut("content", 80)} AS content, create_time
FROM reviews"""),
)
def display_projection(spark, sf_dir):
    return display_reviews(arrivals(spark, sf_dir))


@query(
    "display_predictions",
    on_pred(f"""
SELECT platform, coalesce(category_name, '') AS category_name, reviewer_name, product_id, review_id, pred_label_vn,
  {_cut("text", 100)} AS content, model, ts AS timestamp
FROM pred"""),
)
def display_predictions_query(spark, sf_dir):
    return display_predictions(predictions(spark, sf_dir))


@query(
    "content_fallback",
    on_reviews(f"""
SELECT review_id, crawled_at, {_cut("coalesce(nullif(content, ''), product_name)", 100)} AS content_display
FROM reviews"""),
)
def content_fallback(spark, sf_dir):
    rows = arrivals(spark, sf_dir).withColumn("content", F.nullif("content", F.lit("")))
    return content_display(rows).select("review_id", "crawled_at", "content_display")


@query(
    "canonical_predictions",
    sql(
        """
SELECT review_id, model, pred_label, pred_label_vn, pred_proba_vec, ts, product_name, category_id, md5(text) AS text_md5
FROM pred_v2
UNION ALL
SELECT review_id, model, CASE predicted_sentiment WHEN 2 THEN 1 WHEN 1 THEN 2 ELSE 0 END,
  CASE sentiment_label WHEN 'positive' THEN 'Tích cực' WHEN 'negative' THEN 'Tiêu cực' ELSE 'Trung tính' END,
  CASE sentiment_label WHEN 'positive' THEN '[0.1, 0.6, 0.3]' WHEN 'negative' THEN '[0.6, 0.1, 0.3]'
    ELSE '[0.25, 0.25, 0.5]' END,
  CAST(1762508000 + CAST(review_id AS BIGINT) AS BIGINT), product_name, NULL, md5(title || ' ' || content)
FROM v1""",
        REVIEWS, RAW, SCORED, PRED, V1,
        "\npred_v2 AS (SELECT *, CAST(NULL AS VARCHAR) AS product_name FROM pred)",
    ),
)
def canonical_predictions(spark, sf_dir):
    both = canonicalize(predictions_v1(spark, sf_dir), predictions(spark, sf_dir))
    return both.select(
        "review_id", "model", "pred_label", "pred_label_vn", "pred_proba_vec", "ts", "product_name", "category_id",
        F.md5("text").alias("text_md5"),
    )


@query(
    "truncate_text",
    on_reviews(f"""
SELECT review_id, crawled_at, {_cut("product_name", 40)} AS n40, {_cut("product_name", 50)} AS n50,
  {_cut("content", 80)} AS n80, {_cut("content", 100)} AS n100
FROM reviews"""),
)
def truncate_text(spark, sf_dir):
    widths = {"n40": "product_name", "n50": "product_name", "n80": "content", "n100": "content"}
    cuts = [R.ellipsize(F.col(c), int(name[1:])).alias(name) for name, c in widths.items()]
    return arrivals(spark, sf_dir).select("review_id", "crawled_at", *cuts)


@query(
    "abbrev_id",
    """
SELECT doc_id, CASE WHEN doc_id % 13 < 2 THEN 'N/A' WHEN doc_id % 13 = 2 THEN CAST(doc_id AS VARCHAR) || '...'
  ELSE substring(md5(CAST(doc_id AS VARCHAR)), 1, 12) || '...' END AS short_id
FROM documents""",
)
def abbrev_id(spark, sf_dir):
    text = F.col("doc_id").cast("string")
    ident = cycle(13, {0: F.lit(None).cast("string"), 1: "", 2: text}, F.md5(text))
    return table(spark, sf_dir, "documents").select("doc_id", R.abbrev_id(ident).alias("short_id"))


@query(
    "fill_anonymous",
    on_reviews("""
SELECT review_id, crawled_at, coalesce(reviewer_name, 'Anonymous') AS reviewer_name,
  coalesce(category_name, '') AS category_name
FROM reviews"""),
)
def fill_anonymous(spark, sf_dir):
    return fill_reviewer(arrivals(spark, sf_dir)).select("review_id", "crawled_at", "reviewer_name", "category_name")


@query(
    "format_ts",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown,
  CASE WHEN event_id % 9 = 0 THEN 'N/A' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS from_epoch
FROM events""",
)
def format_ts(spark, sf_dir):
    stamp = F.col("ts").cast("timestamp")
    epoch = F.when(F.col("event_id") % 9 != 0, F.unix_timestamp(stamp))
    return table(spark, sf_dir, "events").select(
        "event_id",
        R.format_ts(stamp, epoch=False).alias("shown"),
        R.format_ts(epoch, missing="N/A").alias("from_epoch"),
    )


@query(
    "format_ts_text",
    on_reviews("""
SELECT review_id, crawled_at, CASE WHEN regexp_full_match(create_time, '[0-9]{9,10}')
  THEN strftime(to_timestamp(CAST(create_time AS BIGINT)) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') ELSE create_time END AS shown
FROM reviews"""),
)
def format_ts_text(spark, sf_dir):
    return arrivals(spark, sf_dir).select("review_id", "crawled_at", R.format_ts_text(F.col("create_time")).alias("shown"))


@query(
    "ingest_api_products",
    """
SELECT CAST(floor(p_partkey / 20) AS BIGINT) AS page_no,
  CAST(count(*) OVER (PARTITION BY floor(p_partkey / 20)) AS BIGINT) AS total,
  CAST(row_number() OVER (PARTITION BY floor(p_partkey / 20) ORDER BY p_partkey) - 1 AS INT) AS rank,
  p_partkey AS id, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS name, p_brand AS brand_name,
  lower(replace(p_brand, '#', '-')) AS slug
FROM part""",
)
def ingest_api_products(spark, sf_dir):
    """Product pages as landed, twenty products each."""
    item = F.struct("id", "name", "brand_name", "brand")
    pages = products(spark, sf_dir).groupBy(F.floor(F.col("id") / 20).alias("page_no")).agg(
        F.array_sort(F.collect_list(item)).alias("data")
    )
    body = F.to_json(F.struct("data", F.struct(F.size("data").alias("total")).alias("paging")))
    rows = explode_pages(pages.select("page_no", body.alias("body")), "products")
    return rows.select("page_no", "total", "rank", "id", "name", "brand_name", F.col("brand.slug").alias("slug"))


@query(
    "translate_label",
    on_v1("""
SELECT review_id, CASE WHEN CAST(review_id AS BIGINT) % 9 = 0 THEN 'Mixed'
  ELSE CASE sentiment_label WHEN 'positive' THEN 'Tích cực' WHEN 'negative' THEN 'Tiêu cực' ELSE 'Trung tính' END
  END AS label
FROM v1"""),
)
def translate_label(spark, sf_dir):
    odd = F.col("review_id").cast("bigint") % 9 == 0
    label = F.when(odd, "Mixed").otherwise(F.initcap("sentiment_label"))
    return predictions_v1(spark, sf_dir).select("review_id", R.translate(label, LABEL_TRANSLATIONS).alias("label"))


@query(
    "label_name",
    """
SELECT vec_id, CASE label WHEN 0 THEN 'Không tốt' WHEN 1 THEN 'Tốt' WHEN 2 THEN 'Trung bình'
  ELSE 'Unknown(' || CAST(label AS VARCHAR) || ')' END AS name
FROM embeddings""",
)
def label_name(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", R.label_name(F.col("label"), LABELS).alias("name"))


@query(
    "rating_badge",
    on_reviews("""
SELECT review_id, crawled_at, '⭐ ' || coalesce(CAST(nullif(rating, 0) AS VARCHAR), 'N/A') AS badge FROM reviews"""),
)
def rating_badge(spark, sf_dir):
    badge = R.rating_badge(F.nullif("rating", F.lit(0)))
    return arrivals(spark, sf_dir).select("review_id", "crawled_at", badge.alias("badge"))


@query("proba_to_json", on_pred("SELECT review_id, pred_proba_vec FROM pred"))
def proba_to_json(spark, sf_dir):
    scored = score_rules(filter_content(raw(spark, sf_dir)))
    return scored.select("review_id", R.proba_json(F.col("proba")).alias("pred_proba_vec"))


@query("filter_model", on_split("SELECT review_id, model, pred_label FROM split WHERE model = 'phobert'"))
def filter_model(spark, sf_dir):
    return where_eq(split_predictions(spark, sf_dir), "model", "phobert").select("review_id", "model", "pred_label")


@query("filter_platform", on_reviews("SELECT review_id, crawled_at FROM reviews WHERE platform = 'tiki'"))
def filter_platform(spark, sf_dir):
    return where_eq(arrivals(spark, sf_dir), "platform", "tiki").select("review_id", "crawled_at")


@query("product_exact", on_reviews("SELECT review_id, crawled_at, rating FROM reviews WHERE product_id = '7'"))
def product_exact(spark, sf_dir):
    return by_product(arrivals(spark, sf_dir), product_id="7").select("review_id", "crawled_at", "rating")


def _searched(spark, sf_dir, text):
    return search_products(arrivals(spark, sf_dir), text).select("review_id", "crawled_at", "product_name")


@query(
    "product_search",
    on_reviews("""
SELECT review_id, crawled_at, product_name FROM reviews
WHERE product_id = 'edition no 1' OR (regexp_matches(product_name, '(?i)EDITION NO 1')
  AND (SELECT count(*) FROM reviews WHERE product_id = 'EDITION NO 1') = 0)"""),
)
def product_search(spark, sf_dir):
    return _searched(spark, sf_dir, "EDITION NO 1")


@query(
    "product_search_exact",
    on_reviews("SELECT review_id, crawled_at, product_name FROM reviews WHERE product_id = '12'"),
)
def product_search_exact(spark, sf_dir):
    return _searched(spark, sf_dir, "12")


@query(
    "recent_activity",
    on_reviews("SELECT review_id, crawled_at FROM reviews WHERE crawled_at >= 1762500600 - 300"),
)
def recent_activity(spark, sf_dir):
    return recent(arrivals(spark, sf_dir), CRAWL_AS_OF).select("review_id", "crawled_at")


@query(
    "clean_tokens",
    r"""
SELECT doc_id, CAST(len(t) AS INT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'),
  lambda w: w NOT IN ('', 'the', 'and', 'of', 'de', 'la', 'der', 'que')) AS t FROM documents) x""",
)
def clean_tokens(spark, sf_dir):
    words = R.tokens(F.col("text"), STOPWORDS)
    return table(spark, sf_dir, "documents").withColumn("t", words).select(
        "doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5")
    )
