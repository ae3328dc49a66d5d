"""Lookups between predictions, reviews and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.functions import proba_json
from reviewlens.operators import analytics as A
from reviewlens.operators.models import attach_by_key, score_with
from reviewlens.operators.views import orphans, pred_with_raw, review_details, semi_top, with_category
from reviewlens.plans.catalog import query
from reviewlens.plans.data import predictions, raw, scored_reviews, table
from reviewlens.plans.oracle import LABEL, PROBA, on_eval, on_pred, on_raw, text_rules
from reviewlens.plans.scorer import lexicon_scorer

SHORT = "CASE WHEN length(product_name) > 40 THEN substring(product_name, 1, 40) || '...' ELSE product_name END"


def half_stored(spark, sf_dir):
    """Reviews of which the badly rated ones are missing, so that some predictions have none."""
    return raw(spark, sf_dir).filter("rating > 2")


@query(
    "pred_raw_join",
    on_pred(f"""
SELECT p.review_id, p.model, p.pred_label_vn,
  CASE WHEN r.review_id IS NULL THEN 'Product ' || p.product_id ELSE
    CASE WHEN length(r.product_name) > 40 THEN substring(r.product_name, 1, 40) || '...' ELSE r.product_name END
  END AS product,
  coalesce(r.category_name, p.category_name, 'N/A') AS category
FROM pred p LEFT JOIN raw r ON r.review_id = p.review_id AND r.rating > 2"""),
)
def pred_raw_join(spark, sf_dir):
    joined = pred_with_raw(predictions(spark, sf_dir), half_stored(spark, sf_dir))
    return joined.select("review_id", "model", "pred_label_vn", "product", "category")


@query(
    "review_details",
    on_pred("""
SELECT p.review_id, p.product_id, p.category_name, p.model, '⭐ ' || CAST(r.rating AS VARCHAR) AS badge,
  coalesce(r.reviewer_name, 'Anonymous') AS reviewer, r.title AS review_title, md5(r.content) AS content_md5,
  r.create_time AS created
FROM pred p JOIN raw r ON r.review_id = p.review_id WHERE p.pred_label = 0"""),
)
def review_details_query(spark, sf_dir):
    found = review_details(predictions(spark, sf_dir), raw(spark, sf_dir), "Không tốt")
    return found.withColumn("review_content", F.md5("review_content")).withColumnRenamed(
        "review_content", "content_md5"
    )


@query(
    "review_details_of_product",
    on_pred("""
SELECT p.review_id, p.product_id, '⭐ ' || CAST(r.rating AS VARCHAR) AS badge
FROM pred p JOIN raw r ON r.review_id = p.review_id WHERE p.pred_label = 1 AND p.product_id = '7'"""),
)
def review_details_of_product(spark, sf_dir):
    found = review_details(predictions(spark, sf_dir), raw(spark, sf_dir), "Tốt", "7")
    return found.select("review_id", "product_id", "badge")


@query(
    "orphan_predictions",
    on_pred("""
SELECT review_id, model, product_id FROM pred p
WHERE NOT EXISTS (SELECT 1 FROM raw r WHERE r.review_id = p.review_id AND r.rating > 2)"""),
)
def orphan_predictions(spark, sf_dir):
    lost = orphans(predictions(spark, sf_dir), half_stored(spark, sf_dir))
    return lost.select("review_id", "model", "product_id")


@query(
    "semi_top_products",
    on_eval(
        """
SELECT review_id, product_id, product_name AS display_name, pred_label_vn FROM eval
WHERE product_id IN (SELECT product_id FROM top)""",
        "\ntop AS (SELECT product_id, product_name FROM eval GROUP BY ALL ORDER BY count(*) DESC, product_name, product_id LIMIT 10)",
    ),
)
def semi_top_products(spark, sf_dir):
    scored = scored_reviews(spark, sf_dir)
    found = semi_top(A.with_display_name(scored), A.top_keys(scored))
    return found.select("review_id", "product_id", "display_name", "pred_label_vn")


@query(
    "category_lookup",
    on_raw("""
SELECT review_id, category_id, coalesce(c.name, 'Unknown') AS category_name
FROM raw LEFT JOIN (SELECT p_type AS id, 'Category ' || max(p_type) AS name FROM part
  GROUP BY p_type HAVING min(p_partkey) >= 10) c ON c.id = raw.category_id"""),
)
def category_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("id"))
    first = part.agg(F.min("p_partkey").alias("first"))
    categories = first.filter("first >= 10").select("id", F.concat(F.lit("Category "), "id").alias("name"))
    reviews = raw(spark, sf_dir).select("review_id", "category_id")
    return with_category(reviews, categories).select("review_id", "category_id", "category_name")


@query(
    "attach_predictions",
    on_raw(
        f"SELECT review_id, product_name, {LABEL} AS pred_label_vn, {PROBA} AS pred_proba_vec FROM scored",
        "\ntexts AS (SELECT review_id, product_name, title || ' ' || content AS content FROM raw)",
        text_rules("texts"),
    ),
)
def attach_predictions(spark, sf_dir):
    rows = raw(spark, sf_dir)
    scored = score_with(rows, lexicon_scorer()).select(
        "review_id", "pred_label_vn", proba_json(F.col("proba")).alias("pred_proba_vec")
    )
    return attach_by_key(rows.select("review_id", "product_name"), scored)
