"""Prediction records: building both versions and reading them as one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions import compose_text, proba_json, translate
from reviewlens.functions.labels import literal_map
from reviewlens.schema import LABEL_TRANSLATIONS, PREDICTION, PREDICTION_V1, V1_TO_CANONICAL


def _or(name: str, default) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def to_prediction(scored: DataFrame, model: str, ts: Column) -> DataFrame:
    """The 15-column record; ``ts`` is epoch seconds and a parameter so that runs can be repeated."""
    built = {
        "platform": _or("platform", "tiki"),
        "reviewer_name": _or("reviewer_name", "Anonymous"),
        "title": _or("title", ""),
        "content": _or("content", ""),
        "text": compose_text(F.col("title"), F.col("content")),
        "pred_proba_vec": proba_json(F.col("proba")),
        "model": F.lit(model),
        "ts": ts.cast("bigint"),
    }
    return scored.select(*[built.get(name, F.col(name)).alias(name) for name in PREDICTION.names])


def to_prediction_v1(scored: DataFrame, model: str, ts: Column) -> DataFrame:
    """The older 19-column record; ``ts`` is its ISO timestamp text."""
    built = {
        "predicted_sentiment": F.col("pred_label"),
        "sentiment_label": F.col("pred_label_vn"),
        "pred_proba_negative": F.element_at("proba", 1),
        "pred_proba_neutral": F.element_at("proba", 2),
        "pred_proba_positive": F.element_at("proba", 3),
        "model": F.lit(model),
        "timestamp": ts,
        "platform": _or("platform", "unknown"),
        "category_name": _or("category_name", "Unknown"),
        "product_name": _or("product_name", ""),
        "product_id": _or("product_id", ""),
        "reviewer_name": _or("reviewer_name", "Anonymous"),
        "content": _or("content", ""),
        "title": _or("title", ""),
        "rating": _or("rating", 0),
        "content_length": F.length(_or("content", "")),
        "flink_processed": F.lit(True),
    }
    return scored.select(*[built.get(name, F.col(name)).alias(name) for name in PREDICTION_V1.names])


def canonicalize(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Both record versions in one schema with one class encoding (0 negative, 1 positive, 2 neutral).

    A v1 label is translated; rows that have none keep their own label. The older timestamp text is
    read as UTC.
    """
    seconds = F.unix_timestamp(F.try_to_timestamp(F.concat("timestamp", F.lit("Z"))))
    upgraded = v1.select(
        "review_id", "platform", "product_id", "product_name", "category_name", "rating", "reviewer_name",
        "title", "content",
        compose_text(F.col("title"), F.col("content")).alias("text"),
        F.element_at(literal_map(V1_TO_CANONICAL), F.col("predicted_sentiment")).alias("pred_label"),
        "sentiment_label",
        proba_json(F.array("pred_proba_negative", "pred_proba_positive", "pred_proba_neutral")).alias(
            "pred_proba_vec"
        ),
        "model",
        seconds.alias("ts"),
    )
    both = upgraded.unionByName(v2, allowMissingColumns=True)
    label = F.coalesce(translate(F.col("sentiment_label"), LABEL_TRANSLATIONS), F.col("pred_label_vn"))
    return both.withColumn("pred_label_vn", label).drop("sentiment_label")
