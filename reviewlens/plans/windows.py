"""Pages, logs, caps per group, first and last per key, samples, batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.operators import paging as P
from reviewlens.operators.keyed import cap_per_group, first_by, last_by
from reviewlens.operators.views import latest_predictions, latest_reviews
from reviewlens.plans.catalog import query
from reviewlens.plans.data import arrivals, predictions, raw, table
from reviewlens.plans.ingest import arrival_predictions
from reviewlens.plans.oracle import LABEL, on_last, on_pred, on_raw, on_reviews


def _newest():
    return [F.desc("crawled_at"), F.asc("review_id")]


def _latest():
    return [F.desc("ts"), F.asc("review_id"), F.asc("model")]


PAGED = "(SELECT count(*) FROM {t}) AS total_rows, CAST(greatest(1, ceil((SELECT count(*) FROM {t}) / {n}.0)) AS BIGINT) AS total_pages"


@query(
    "page_reviews",
    on_reviews(f"""
SELECT review_id, crawled_at, rating, {PAGED.format(t="reviews", n=20)} FROM reviews
ORDER BY crawled_at DESC, review_id LIMIT 20 OFFSET 40"""),
)
def page_reviews(spark, sf_dir):
    rows = P.page(arrivals(spark, sf_dir), 3, 20, _newest(), ["crawled_at", "review_id"])
    return rows.select("review_id", "crawled_at", "rating", "total_rows", "total_pages")


@query(
    "page_reviews_deep",
    on_reviews(f"""
SELECT review_id, crawled_at, rating, {PAGED.format(t="reviews", n=20)} FROM reviews
ORDER BY crawled_at DESC, review_id LIMIT 20 OFFSET 160"""),
)
def page_reviews_deep(spark, sf_dir):
    rows = P.page(arrivals(spark, sf_dir), 9, 20, _newest(), ["crawled_at", "review_id"], deep=True)
    return rows.select("review_id", "crawled_at", "rating", "total_rows", "total_pages")


@query(
    "page_after_key",
    on_reviews("""
SELECT review_id, crawled_at FROM reviews
WHERE crawled_at < 1762500150 OR (crawled_at = 1762500150 AND review_id > '150')
ORDER BY crawled_at DESC, review_id LIMIT 20"""),
)
def page_after_key(spark, sf_dir):
    last = F.lit(1_762_500_150.0)
    after = (F.col("crawled_at") < last) | ((F.col("crawled_at") == last) & (F.col("review_id") > "150"))
    return P.page_after(arrivals(spark, sf_dir), after, 20, _newest()).select("review_id", "crawled_at")


@query(
    "page_predictions",
    on_pred(f"""
SELECT review_id, model, ts, pred_label_vn, {PAGED.format(t="pred", n=10)} FROM pred
ORDER BY ts DESC, review_id, model LIMIT 10 OFFSET 10"""),
)
def page_predictions(spark, sf_dir):
    rows = P.page(predictions(spark, sf_dir), 2, 10, _latest(), ["ts", "review_id", "model"])
    return rows.select("review_id", "model", "ts", "pred_label_vn", "total_rows", "total_pages")


@query(
    "recent_reviews_log",
    on_reviews("""
SELECT crawled_at AS timestamp, platform, coalesce(category_name, 'N/A') AS category,
  CASE WHEN length(product_name) > 50 THEN substring(product_name, 1, 50) || '...' ELSE product_name END AS product,
  coalesce(reviewer_name, 'Anonymous') AS reviewer, '⭐ ' || CAST(rating AS VARCHAR) AS rating
FROM reviews ORDER BY crawled_at DESC, review_id LIMIT 10"""),
)
def recent_reviews_log(spark, sf_dir):
    return latest_reviews(arrivals(spark, sf_dir))


@query(
    "recent_predictions_log",
    on_pred("""
SELECT strftime(to_timestamp(p.ts) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS timestamp,
  substring(p.review_id, 1, 12) || '...' AS review, coalesce(r.category_name, p.category_name, 'N/A') AS category,
  CASE WHEN r.review_id IS NULL THEN 'Product ' || p.product_id
    WHEN length(r.product_name) > 40 THEN substring(r.product_name, 1, 40) || '...' ELSE r.product_name END AS product,
  p.pred_label_vn AS prediction, p.model
FROM (SELECT * FROM pred ORDER BY ts DESC, review_id, model LIMIT 10) p
LEFT JOIN raw r ON r.review_id = p.review_id AND r.rating > 2"""),
)
def recent_predictions_log(spark, sf_dir):
    return latest_predictions(predictions(spark, sf_dir), raw(spark, sf_dir).filter("rating > 2"))


@query(
    "cap_reviews_per_product",
    on_raw("""
SELECT review_id, product_id, crawled_at FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY crawled_at DESC, review_id) AS rank FROM raw) t
WHERE rank <= 5"""),
)
def cap_reviews_per_product(spark, sf_dir):
    rows = raw(spark, sf_dir).select("review_id", "product_id", "crawled_at")
    return cap_per_group(rows, "product_id", _newest(), 5, spread=["review_id"])


@query(
    "cap_products_per_source",
    """
SELECT p_partkey, p_brand FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part) t
WHERE rank <= 4""",
)
def cap_products_per_source(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    order = [F.desc("p_retailprice"), F.asc("p_partkey")]
    return cap_per_group(part, "p_brand", order, 4, spread=["p_partkey"]).select("p_partkey", "p_brand")


@query("first_by_key", on_raw("SELECT review_id, rating, crawled_at, md5(content) AS content_md5 FROM raw"))
def first_by_key(spark, sf_dir):
    rows = arrivals(spark, sf_dir).withColumn("content_md5", F.md5("content"))
    return first_by(rows.select("review_id", "rating", "crawled_at", "content_md5"), ["review_id"], ["crawled_at"])


@query(
    "last_by_key",
    on_last(f"""
SELECT review_id, 'baseline' AS model, CAST(pred_label AS INT) AS pred_label, {LABEL} AS pred_label_vn,
  CAST(crawled_at AS BIGINT) AS ts
FROM scored"""),
)
def last_by_key(spark, sf_dir):
    latest = last_by(arrival_predictions(spark, sf_dir), ["review_id", "model"], ["ts"])
    return latest.select("review_id", "model", "pred_label", "pred_label_vn", "ts")


@query(
    "sample_reviews",
    on_raw("SELECT review_id, rating FROM raw ORDER BY md5(review_id || '42'), review_id LIMIT 100"),
)
def sample_reviews(spark, sf_dir):
    return P.sample_k(raw(spark, sf_dir).select("review_id", "rating"), 100, 42)


PLACED = """
placed AS (
  SELECT review_id, CAST(('0x' || substring(md5(review_id), 1, 8))::BIGINT % 8 AS BIGINT) AS bucket FROM raw
)"""
BATCHED = """
batched AS (
  SELECT review_id, bucket,
    CAST(floor((row_number() OVER (PARTITION BY bucket ORDER BY review_id) - 1) / 100) AS BIGINT) AS batch_no
  FROM placed
)"""


@query("assign_batches", on_raw("SELECT review_id, bucket, batch_no FROM batched", PLACED, BATCHED))
def assign_batches(spark, sf_dir):
    return P.assign_batches(raw(spark, sf_dir).select("review_id"), buckets=8)


@query(
    "batch_count",
    on_raw(
        """
SELECT count(*) AS total_batches, CAST(sum(n) AS BIGINT) AS total_rows
FROM (SELECT bucket, batch_no, count(*) AS n FROM batched GROUP BY bucket, batch_no) t""",
        PLACED, BATCHED,
    ),
)
def batch_count(spark, sf_dir):
    return P.batch_count(P.assign_batches(raw(spark, sf_dir).select("review_id"), buckets=8))


@query(
    "assign_batches_in_order",
    on_raw("""
SELECT review_id, CAST(floor((row_number() OVER (ORDER BY review_id) - 1) / 100) AS BIGINT) AS batch_no,
  CAST(ceil((SELECT count(*) FROM raw) / 100.0) AS BIGINT) AS total_batches
FROM raw"""),
)
def assign_batches_in_order(spark, sf_dir):
    batched = P.assign_batches(raw(spark, sf_dir).select("review_id"))
    total = P.batch_count(batched).select("total_batches").scalar()
    return batched.select("review_id", "batch_no", total.alias("total_batches"))
