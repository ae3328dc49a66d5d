"""Which model scores a review: hash split and control rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions import md5_mod
from reviewlens.operators.keyed import insert_new, last_by
from reviewlens.schema import RULE_NAMES, TOPIC_BASELINE, TOPIC_TRANSFORMER

RULE_KEY = ("product_id", "category_id", "scope")


def topic_for(review_id: Column, n: int = 2, cut: int = 1) -> Column:
    """Topic by md5 of the id modulo ``n``: below ``cut`` the baseline's, else the transformer's."""
    return F.when(md5_mod(review_id, n) < cut, TOPIC_BASELINE).otherwise(TOPIC_TRANSFORMER)


def route(reviews: DataFrame, n: int = 2, cut: int = 1) -> DataFrame:
    """Add ``topic``. A computed column: no shuffle, and the same id always goes the same way."""
    return reviews.withColumn("topic", topic_for(F.col("review_id"), n, cut))


def publish_new_only(new: DataFrame, stored: DataFrame, order: Sequence) -> DataFrame:
    """Routed rows of the reviews not stored yet; repeated reviews are not published."""
    return route(insert_new(new, stored, ["review_id"], order))


def rule_key(commands: DataFrame) -> DataFrame:
    """Key columns of rule commands: empty ids count as absent, and no id at all means global."""
    product = F.nullif(F.col("product_id"), F.lit(""))
    category = F.nullif(F.col("category_id"), F.lit(""))
    scope = F.when(product.isNull() & category.isNull(), "global")
    return commands.withColumns({"product_id": product, "category_id": category, "scope": scope})


def upsert_rules(rules: DataFrame, commands: DataFrame, seq: str = "seq") -> DataFrame:
    """Rules after applying commands in ``seq`` order; a rule already stored is older than any command.

    Grouping treats NULL key parts as equal, which is the null-safe key match needed here.
    """
    stored = rules.select(*RULE_KEY, "active_model", F.lit(None).cast("bigint").alias("_seq"))
    fresh = rule_key(commands).select(*RULE_KEY, "active_model", F.col(seq).cast("bigint").alias("_seq"))
    return last_by(stored.unionByName(fresh), RULE_KEY, ["_seq"]).drop("_seq")


def apply_rules(reviews: DataFrame, rules: DataFrame, default: str = "both") -> DataFrame:
    """Add ``active_model``: the rule of the product in its category, else of the product, else of the
    category, else the global one.

    Rules are unique per key, so the joins keep one row per review. Rules of a product and of a
    product in a category are one frame, one row per product, so the reviews meet them in one join.
    The rule frames carry no broadcast hint: Spark broadcasts them below its size threshold, and
    AQE splits the partition of a hot product or category otherwise.
    """
    of_product = (
        rules.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.max(F.when(F.col("category_id").isNull(), F.col("active_model"))).alias("_p"),
            F.map_from_entries(
                F.collect_list(F.when(F.col("category_id").isNotNull(), F.struct("category_id", "active_model")))
            ).alias("_in"),
        )
    )
    category_only = rules.filter(F.col("product_id").isNull() & F.col("category_id").isNotNull())
    overall = rules.filter("scope = 'global'").agg(F.max("active_model")).scalar()
    both = F.try_element_at("_in", F.col("category_id"))
    return (
        reviews.join(of_product, "product_id", "left")
        .join(category_only.select("category_id", F.col("active_model").alias("_c")), "category_id", "left")
        .withColumn("active_model", F.coalesce(both, "_p", "_c", overall, F.lit(default)))
        .drop("_in", "_p", "_c")
    )


def for_model(ruled: DataFrame, model: str) -> DataFrame:
    """The reviews that ``model`` may score, from the output of ``apply_rules``."""
    return ruled.filter(F.col("active_model").isin(RULE_NAMES.get(model, model), "both"))
