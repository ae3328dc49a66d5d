"""Scoring: rules, fallbacks, Python models, MLlib."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlens import functions as R
from reviewlens.operators import ml
from reviewlens.operators.filters import filter_content
from reviewlens.operators.models import resolve_failures, score_with
from reviewlens.operators.scoring import lexicon_counts, score_neutral, score_rating, score_rules
from reviewlens.plans.catalog import query
from reviewlens.plans.data import arrivals, cue, cued, predictions, raw, split_predictions, table
from reviewlens.plans.oracle import (
    LABEL, NEG_V2, POS_V2, PROBA, REVIEWS, on_raw, on_reviews, on_scored, on_split, on_v1, ratings, rules,
    sql, text_rules,
)
from reviewlens.plans.scorer import lexicon_scorer
from reviewlens.schema import V1_RULES

VERDICT = ("review_id", "crawled_at", "pred_label", "pred_label_vn", "pred_proba_vec", "confidence")


def _verdicts(scored):
    return scored.withColumn("pred_proba_vec", R.proba_json(F.col("proba"))).select(*VERDICT)


def _verdict_sql(*ctes: str) -> str:
    return sql(
        f"""
SELECT review_id, crawled_at, CAST(pred_label AS INT) AS pred_label, {LABEL} AS pred_label_vn,
  {PROBA} AS pred_proba_vec, CAST(CASE WHEN pred_label = 2 THEN 0.6 ELSE 0.8 END AS DOUBLE) AS confidence
FROM scored""",
        REVIEWS,
        *ctes,
    )


@query(
    "lexicon_counts",
    on_reviews(f"SELECT review_id, crawled_at, {POS_V2} AS pos_count, {NEG_V2} AS neg_count FROM reviews"),
)
def lexicon_counts_query(spark, sf_dir):
    counted = lexicon_counts(arrivals(spark, sf_dir))
    return counted.select("review_id", "crawled_at", "pos_count", "neg_count")


@query("rule_score_v2", _verdict_sql(rules("reviews")))
def rule_score_v2(spark, sf_dir):
    return _verdicts(score_rules(arrivals(spark, sf_dir)))


@query(
    "rule_score_v1",
    on_v1("""
SELECT review_id, predicted_sentiment AS pred_label, sentiment_label AS pred_label_vn, confidence,
  CASE sentiment_label WHEN 'positive' THEN '[0.1, 0.3, 0.6]' WHEN 'negative' THEN '[0.6, 0.3, 0.1]'
    ELSE '[0.25, 0.5, 0.25]' END AS pred_proba_vec
FROM v1"""),
)
def rule_score_v1(spark, sf_dir):
    return _verdicts(score_rules(filter_content(raw(spark, sf_dir)), V1_RULES)).drop("crawled_at")


@query("rating_fallback", _verdict_sql(ratings("reviews", "scored")))
def rating_fallback(spark, sf_dir):
    return _verdicts(score_rating(arrivals(spark, sf_dir)))


@query(
    "neutral_fallback",
    on_reviews("""
SELECT review_id, crawled_at, 1 AS pred_label, 'neutral' AS pred_label_vn, '[0.33, 0.34, 0.33]' AS pred_proba_vec,
  CAST(0.33 AS DOUBLE) AS confidence
FROM reviews"""),
)
def neutral_fallback(spark, sf_dir):
    return _verdicts(score_neutral(arrivals(spark, sf_dir)))


# The stand-in model reads title and content and knows no rating.
TEXTS = "\ntexts AS (SELECT review_id, crawled_at, title || ' ' || content AS content FROM reviews)"


@query("batch_model_score", _verdict_sql(TEXTS, text_rules("texts")))
def batch_model_score(spark, sf_dir):
    return _verdicts(resolve_failures(score_with(arrivals(spark, sf_dir), lexicon_scorer())))


@query(
    "softmax_argmax",
    """
WITH s AS (SELECT vec_id, embedding, list_max(embedding) AS top FROM embeddings),
p AS (SELECT vec_id, embedding, top, list_transform(embedding, lambda x: exp(CAST(x AS DOUBLE) - CAST(top AS DOUBLE))) AS e FROM s)
SELECT vec_id, CAST(list_position(embedding, top) - 1 AS INT) AS label,
  round(1.0 / list_sum(e), 6) AS top_proba, round(e[1] / list_sum(e), 6) AS first_proba
FROM p""",
)
def softmax_argmax(spark, sf_dir):
    logits = F.col("embedding").cast("array<double>")
    rows = table(spark, sf_dir, "embeddings").withColumn("p", R.softmax(logits))
    return rows.select(
        "vec_id",
        R.argmax(logits).alias("label"),
        F.round(R.confidence(F.col("p")), 6).alias("top_proba"),
        F.round(F.col("p")[0], 6).alias("first_proba"),
    )


@query(
    "confidence",
    on_scored("""
SELECT review_id, CAST(CASE WHEN pred_label = 2 THEN 0.6 ELSE 0.8 END AS DOUBLE) AS confidence FROM scored"""),
)
def confidence(spark, sf_dir):
    scored = score_rules(raw(spark, sf_dir))
    return scored.select("review_id", R.confidence(F.col("proba")).alias("confidence"))


@query(
    "weak_labels",
    on_raw("""
SELECT review_id, rating, CASE WHEN rating <= 2 THEN 0 ELSE 1 END AS label FROM raw WHERE rating IN (1, 2, 4, 5)"""),
)
def weak_labels(spark, sf_dir):
    return ml.weak_label(raw(spark, sf_dir)).select("review_id", "rating", "label")


# What holds for any fit: what was learned from, the model's size, and that it beats guessing.
@query(
    "train_tfidf_lr",
    on_raw("""
SELECT CAST(5000 AS INT) AS features, CAST(2 AS INT) AS classes, count(*) AS labelled,
  count(*) FILTER (WHERE rating >= 4) AS positive, TRUE AS converged_in_time, TRUE AS beats_majority
FROM raw WHERE rating IN (1, 2, 4, 5)"""),
)
def train_tfidf_lr(spark, sf_dir):
    rows = raw(spark, sf_dir)
    fitted = ml.train(rows).stages[-1]
    seen = fitted.summary
    learned = ml.weak_label(rows).agg(F.count("*").alias("labelled"), F.count_if(F.col("label") == 1).alias("positive"))
    majority = F.greatest("positive", F.col("labelled") - F.col("positive")) / F.col("labelled")
    return learned.select(
        F.lit(fitted.numFeatures).cast("int").alias("features"),
        F.lit(fitted.numClasses).cast("int").alias("classes"),
        "labelled",
        "positive",
        F.lit(seen.totalIterations <= 50).alias("converged_in_time"),
        (F.lit(seen.accuracy) >= majority).alias("beats_majority"),
    )


# Every review, by a model of all labelled ones. Where the first words say the rating, a model of those reviews
# predicts the label that follows: this holds for any fit that works.
@query(
    "predict_tfidf_lr",
    on_raw("""
SELECT review_id, CAST(CASE WHEN content LIKE 'Sản phẩm tốt%' THEN 1 WHEN content LIKE 'Chất lượng tệ%' THEN 0 END AS INT) AS pred_label,
  TRUE AS sums_to_one, TRUE AS is_argmax
FROM raw"""),
)
def predict_tfidf_lr(spark, sf_dir):
    rows = raw(spark, sf_dir)
    total = F.aggregate("proba", F.lit(0.0), lambda s, x: s + x)
    most = F.array_position(F.col("proba"), F.array_max("proba")) - 1
    checked = ml.predict(ml.train(rows), rows).select(
        *rows.columns,
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        (F.col("prediction").cast("int") == most).alias("is_argmax"),
    )
    said = F.when(cue().isNotNull(), F.col("prediction").cast("int"))
    return ml.predict(ml.train(cued(rows)), checked).select("review_id", said.alias("pred_label"), "sums_to_one", "is_argmax")


def _labelled(spark, sf_dir):
    return ml.weak_label(raw(spark, sf_dir))


@query(
    "evaluate_accuracy",
    on_split("""
SELECT model, count(*) AS n, avg(CASE WHEN pred_label = (CASE WHEN rating <= 2 THEN 0 ELSE 1 END) THEN 1.0 ELSE 0.0 END) AS accuracy
FROM split WHERE rating IN (1, 2, 4, 5) GROUP BY model"""),
)
def evaluate_accuracy(spark, sf_dir):
    return ml.evaluate(split_predictions(spark, sf_dir), _labelled(spark, sf_dir))


@query(
    "confusion_counts",
    on_split("""
SELECT model, CASE WHEN rating <= 2 THEN 0 ELSE 1 END AS label, CAST(pred_label AS INT) AS pred_label, count(*) AS n
FROM split WHERE rating IN (1, 2, 4, 5) GROUP BY 1, 2, 3"""),
)
def confusion_counts(spark, sf_dir):
    return ml.confusion(split_predictions(spark, sf_dir), _labelled(spark, sf_dir))
