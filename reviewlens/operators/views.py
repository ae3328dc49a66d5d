"""What the dashboard shows: display columns, logs and lookups between reviews and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions import abbrev_id, ellipsize, format_ts, rating_badge
from reviewlens.operators.paging import newest
from reviewlens.schema import PREDICTION_DISPLAY, REVIEW_DISPLAY
from reviewlens.session import ensure_checkpoint_dir


def _or(name: str, default: str) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def fill_reviewer(df: DataFrame) -> DataFrame:
    """Missing reviewers become ``Anonymous``, other missing texts empty."""
    if "reviewer_name" not in df.columns:
        df = df.withColumn("reviewer_name", F.lit("Anonymous"))
    return df.na.fill("Anonymous", subset=["reviewer_name"]).na.fill("")


def content_display(df: DataFrame, n: int = 100) -> DataFrame:
    """Add ``content_display``: the first of text, content and product name that the row has."""
    present = [name for name in ("text", "content", "product_name") if name in df.columns]
    chosen = F.coalesce(*[F.col(name) for name in present], F.lit("N/A"))
    return df.withColumn("content_display", ellipsize(chosen, n))


def display(df: DataFrame, columns: Sequence[str] = REVIEW_DISPLAY, widths: dict[str, int] | None = None) -> DataFrame:
    """The columns of ``columns`` that ``df`` has, in that order, blanks for NULL, long texts cut."""
    shown = df.select([name for name in columns if name in df.columns]).na.fill("")
    cut = {name: ellipsize(F.col(name), n) for name, n in (widths or {}).items() if name in shown.columns}
    return shown.withColumns(cut) if cut else shown


def display_reviews(reviews: DataFrame) -> DataFrame:
    return display(reviews, REVIEW_DISPLAY, {"product_name": 40, "content": 80})


def display_predictions(predictions: DataFrame) -> DataFrame:
    """Canonical predictions under their display names."""
    shown = display(fill_reviewer(content_display(predictions)), PREDICTION_DISPLAY)
    return shown.withColumnsRenamed({"content_display": "content", "ts": "timestamp"})


def latest_reviews(reviews: DataFrame, n: int = 10) -> DataFrame:
    """Log of the newest reviews."""
    rows = newest(reviews, n, [F.desc("crawled_at"), F.asc("review_id")])
    name = F.coalesce(F.nullif(F.col("product_name"), F.lit("")), F.lit("N/A"))
    return rows.select(
        F.col("crawled_at").alias("timestamp"),
        _or("platform", "N/A").alias("platform"),
        _or("category_name", "N/A").alias("category"),
        ellipsize(name, 50).alias("product"),
        _or("reviewer_name", "Anonymous").alias("reviewer"),
        rating_badge(F.col("rating")).alias("rating"),
    )


def pred_with_raw(predictions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Predictions with product and category taken from their review.

    ``reviews`` holds each ``review_id`` once, as the insert-once table does. A prediction without
    a review shows ``Product <id>`` and its own category.
    """
    raw = reviews.select(
        "review_id",
        F.lit(True).alias("_found"),
        F.col("product_name").alias("_name"),
        F.col("category_name").alias("_category"),
    )
    name = F.coalesce(F.nullif(F.col("_name"), F.lit("")), F.lit("N/A"))
    missing = F.concat(F.lit("Product "), _or("product_id", "N/A"))
    return (
        predictions.join(raw, "review_id", "left")
        .withColumn("product", F.when(F.col("_found"), ellipsize(name, 40)).otherwise(missing))
        .withColumn("category", F.coalesce(F.nullif(F.col("_category"), F.lit("")), _or("category_name", "N/A")))
        .drop("_found", "_name", "_category")
    )


def _log_columns(predictions: DataFrame) -> DataFrame:
    return predictions.select("review_id", "product_id", "category_name", "pred_label_vn", "model", "ts")


def latest_predictions(predictions: DataFrame, reviews: DataFrame, n: int = 10) -> DataFrame:
    """Log of the newest predictions, enriched from raw.

    Only ``n`` rows reach the join, so they are the broadcast side and raw is scanned, not shuffled.
    They are needed twice, hence checkpointed: the predictions are read once.
    """
    ensure_checkpoint_dir(predictions.sparkSession)
    rows = newest(_log_columns(predictions), n, [F.desc("ts"), F.asc("review_id"), F.asc("model")]).checkpoint()
    wanted = F.broadcast(rows.select("review_id").distinct())
    raw = reviews.join(wanted, "review_id", "left_semi")
    return pred_with_raw(rows, raw).select(
        format_ts(F.col("ts"), missing="N/A").alias("timestamp"),
        abbrev_id(F.col("review_id")).alias("review"),
        "category",
        "product",
        F.coalesce(F.col("pred_label_vn"), F.lit("N/A")).alias("prediction"),
        _or("model", "N/A").alias("model"),
    )


def review_details(
    predictions: DataFrame, reviews: DataFrame, label: str, product_id: str | None = None
) -> DataFrame:
    """The stored review of every prediction with ``label``, of one product if given.

    The filters run before the join.
    """
    chosen = predictions.filter(F.col("pred_label_vn") == label)
    if product_id is not None:
        chosen = chosen.filter(F.col("product_id") == product_id)
    raw = reviews.select(
        "review_id",
        rating_badge(F.col("rating")).alias("badge"),
        _or("reviewer_name", "Anonymous").alias("reviewer"),
        _or("title", "N/A").alias("review_title"),
        _or("content", "N/A").alias("review_content"),
        _or("create_time", "N/A").alias("created"),
    )
    return chosen.select("review_id", "product_id", "category_name", "model").join(raw, "review_id")


def orphans(predictions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Predictions whose review is not stored."""
    return predictions.join(reviews.select("review_id"), "review_id", "left_anti")


def semi_top(df: DataFrame, top: DataFrame, keys: Sequence[str] = ("product_id", "display_name")) -> DataFrame:
    """Rows whose ``keys`` are in ``top``; a small frame is broadcast by its size, not by a hint."""
    return df.join(top.select(*keys), list(keys), "left_semi")


def with_category(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Add ``category_name`` by ``category_id``; ``Unknown`` when the id has none."""
    names = categories.select(F.col("id").alias("category_id"), F.col("name").alias("_name"))
    return (
        df.join(names, "category_id", "left")
        .withColumn("category_name", F.coalesce("_name", F.lit("Unknown")))
        .drop("_name")
    )
