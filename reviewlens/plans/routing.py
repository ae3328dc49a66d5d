"""Routing of reviews to models."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens.operators.routing import apply_rules, for_model, publish_new_only, route, upsert_rules
from reviewlens.plans.catalog import query
from reviewlens.plans.data import arrivals, raw, table
from reviewlens.plans.oracle import ODD, RAW, REVIEWS, on_raw, sql
from reviewlens.schema import CONTROL_RULE

TOPIC = f"CASE WHEN {ODD} THEN 'reviews' ELSE 'reviews_raw' END"


@query("hash_split", on_raw(f"SELECT review_id, {TOPIC} AS topic FROM raw"))
def hash_split(spark, sf_dir):
    return route(raw(spark, sf_dir)).select("review_id", "topic")


@query(
    "weighted_split",
    on_raw("""
SELECT review_id, CASE WHEN CAST(('0x' || md5(review_id))::UHUGEINT % 10 AS INT) < 7 THEN 'reviews_raw'
  ELSE 'reviews' END AS topic
FROM raw"""),
)
def weighted_split(spark, sf_dir):
    return route(raw(spark, sf_dir), n=10, cut=7).select("review_id", "topic")


@query(
    "publish_new_only",
    on_raw(f"SELECT review_id, crawled_at, {TOPIC} AS topic FROM raw WHERE rating > 2"),
)
def publish_new_only_query(spark, sf_dir):
    stored = raw(spark, sf_dir).filter("rating <= 2")
    published = publish_new_only(arrivals(spark, sf_dir), stored, ["crawled_at"])
    return published.select("review_id", "crawled_at", "topic")


COMMANDS = """
commands AS (
  SELECT p_partkey AS seq, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS STRING) WHEN p_partkey % 3 = 1 THEN '' END AS product_id,
    CASE WHEN p_partkey % 3 = 1 OR p_partkey % 2 = 0 THEN p_type WHEN p_partkey % 3 = 0 THEN '' END AS category_id,
    CASE p_size % 3 WHEN 0 THEN 'spark-baseline' WHEN 1 THEN 'phobert' ELSE 'both' END AS active_model
  FROM part
)"""
RULES = COMMANDS + """, rules AS (
  SELECT product_id, category_id, scope, active_model FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id, category_id, scope ORDER BY seq DESC) AS rn
    FROM (SELECT seq, active_model, nullif(product_id, '') AS product_id, nullif(category_id, '') AS category_id,
      CASE WHEN nullif(product_id, '') IS NULL AND nullif(category_id, '') IS NULL THEN 'global' END AS scope
      FROM commands) c) r
  WHERE rn = 1
)"""


def rules(spark, sf_dir):
    """The rules after a history of commands, one per part: for products (also in a category), categories or all."""
    part = table(spark, sf_dir, "part")
    slot, key = F.col("p_partkey") % 3, F.col("p_partkey")
    model = F.when(F.col("p_size") % 3 == 0, "spark-baseline").when(F.col("p_size") % 3 == 1, "phobert")
    commands = part.select(
        key.alias("seq"),
        F.when(slot == 0, key.cast("string")).when(slot == 1, "").alias("product_id"),
        F.when((slot == 1) | (key % 2 == 0), F.col("p_type")).when(slot == 0, "").alias("category_id"),
        model.otherwise("both").alias("active_model"),
    )
    return upsert_rules(spark.createDataFrame([], CONTROL_RULE), commands)


@query("set_rule", sql("SELECT * FROM rules", RULES))
def set_rule(spark, sf_dir):
    return rules(spark, sf_dir)


@query(
    "apply_rules",
    sql(
        """
SELECT review_id, active_model, active_model IN ('spark-baseline', 'both') AS by_baseline,
  active_model IN ('phobert', 'both') AS by_phobert
FROM (
  SELECT r.review_id, coalesce(b.active_model, p.active_model, c.active_model, g.active_model, 'both') AS active_model
  FROM raw r LEFT JOIN rules b ON b.product_id = r.product_id AND b.category_id = r.category_id
  LEFT JOIN rules p ON p.product_id = r.product_id AND p.category_id IS NULL
  LEFT JOIN rules c ON c.category_id = r.category_id AND c.product_id IS NULL
  LEFT JOIN rules g ON g.scope = 'global') t""",
        REVIEWS, RAW, RULES,
    ),
)
def apply_rules_query(spark, sf_dir):
    ruled = apply_rules(raw(spark, sf_dir), rules(spark, sf_dir))
    return ruled.select(
        "review_id", "active_model",
        F.col("active_model").isin("spark-baseline", "both").alias("by_baseline"),
        F.col("active_model").isin("phobert", "both").alias("by_phobert"),
    )


@query(
    "rules_for_model",
    sql(
        """
SELECT r.review_id FROM raw r LEFT JOIN rules b ON b.product_id = r.product_id AND b.category_id = r.category_id
  LEFT JOIN rules p ON p.product_id = r.product_id AND p.category_id IS NULL
LEFT JOIN rules c ON c.category_id = r.category_id AND c.product_id IS NULL
LEFT JOIN rules g ON g.scope = 'global'
WHERE coalesce(b.active_model, p.active_model, c.active_model, g.active_model, 'both') IN ('phobert', 'both')""",
        REVIEWS, RAW, RULES,
    ),
)
def rules_for_model(spark, sf_dir):
    return for_model(apply_rules(raw(spark, sf_dir), rules(spark, sf_dir)), "phobert").select("review_id")
