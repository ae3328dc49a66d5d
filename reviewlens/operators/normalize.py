"""Nested shop records to flat reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions import product_url
from reviewlens.schema import REVIEW


def _text(c: Column, default: str = "") -> Column:
    """String form with NULL and empty replaced by ``default``."""
    return F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit(default))


def _id_text(c: Column) -> Column:
    """String form of an id; missing and 0 become empty."""
    return F.when(c != 0, c.cast("string")).otherwise("")


def resolve_category(
    categories: str, source_type: Column, source_id: Column, supplied_name: Column | None = None
) -> Column:
    """``struct<category_id, category_name>`` for a variant column holding an object, a list or nothing.

    A name supplied for a category source wins; then an object's own id and name; then the first
    object of a list; then the source id of a category source; then ``unknown``.
    """
    supplied_name = F.lit(None).cast("string") if supplied_name is None else supplied_name

    def get(path: str) -> Column:
        return F.try_variant_get(F.col(categories), path, "string")

    def pair(ident: Column, name: Column) -> Column:
        return F.struct(ident.alias("category_id"), name.alias("category_name"))

    shape = F.schema_of_variant(F.col(categories))
    first_shape = F.schema_of_variant(F.try_variant_get(F.col(categories), "$[0]", "variant"))
    unknown_id, unknown_name = F.lit("unknown"), F.lit("Unknown")
    from_category = source_type == "category"
    is_object = shape.startswith("OBJECT<") & (shape != "OBJECT<>")
    return (
        F.when(from_category & (supplied_name != ""), pair(source_id, supplied_name))
        .when(is_object & get("$.id").isNotNull(), pair(get("$.id"), F.coalesce(get("$.name"), unknown_name)))
        .when(is_object, pair(unknown_id, unknown_name))
        .when(
            first_shape.startswith("OBJECT<"),
            pair(F.coalesce(get("$[0].id"), unknown_id), F.coalesce(get("$[0].name"), unknown_name)),
        )
        .when(first_shape.isNotNull(), pair(unknown_id, unknown_name))
        .otherwise(pair(F.when(from_category, source_id).otherwise(unknown_id), unknown_name))
    )


def normalize(
    reviews: DataFrame,
    products: DataFrame,
    source_type: Column,
    source_id: Column,
    crawled_at: Column,
    category_name: Column | None = None,
) -> DataFrame:
    """Flat 15-column reviews from API reviews (with ``product_id``) and API products.

    One equi-join on the product id. Products are unique per id; Spark broadcasts them when they
    are small, and otherwise AQE splits the partitions of products with very many reviews.
    """
    joined = reviews.join(products.withColumnRenamed("id", "_pid"), F.col("product_id") == F.col("_pid"))
    pid = _id_text(F.col("product_id"))
    flat = joined.withColumn("_source_type", source_type).withColumn("_source_id", source_id.cast("string"))
    category = resolve_category("categories", F.col("_source_type"), F.col("_source_id"), category_name)
    values = {
        "platform": F.lit("tiki"),
        "review_id": _id_text(F.col("id")),
        "product_id": pid,
        "product_name": _text(F.col("name")),
        "product_url": product_url(pid),
        "category_id": F.col("_category.category_id"),
        "category_name": F.col("_category.category_name"),
        "rating": F.coalesce(F.col("rating").cast("int"), F.lit(0)),
        "title": _text(F.col("title")),
        "content": _text(F.col("content")),
        "reviewer_name": _text(F.col("created_by.name"), "Anonymous"),
        "create_time": _text(F.col("created_at")),
        "crawled_at": crawled_at.cast("double"),
        "source_type": F.col("_source_type"),
        "source_id": F.col("_source_id"),
    }
    return flat.withColumn("_category", category).select(*[values[name].alias(name) for name in REVIEW.names])
