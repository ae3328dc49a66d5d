"""TF-IDF and logistic regression on weak labels, with MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions import compose_text

FEATURES = 5_000


def weak_label_of(rating: Column) -> Column:
    """Training label: 0 for ratings 1-2, 1 for 4-5, else NULL."""
    return F.when(rating.isin(1, 2), 0).when(rating.isin(4, 5), 1)


def weak_label(reviews: DataFrame) -> DataFrame:
    """Add ``label``; reviews that have none are dropped."""
    return reviews.withColumn("label", weak_label_of(F.col("rating"))).filter("label is not null")


def _with_text(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn("text", compose_text(F.col("title"), F.col("content")))


def train(
    reviews: DataFrame, max_iter: int = 50, reg_param: float = 1e-3, stopwords: Sequence[str] | None = None
) -> PipelineModel:
    """Fit on the weakly labelled reviews.

    The term counts are computed once and kept for both fits. Gradients are summed in a tree; the
    driver holds the document frequencies and the coefficients, both of fixed size.
    """
    remover = StopWordsRemover(inputCol="words", outputCol="kept")
    if stopwords is not None:
        remover = remover.setStopWords(list(stopwords))
    to_counts = [
        Tokenizer(inputCol="text", outputCol="words"),
        remover,
        HashingTF(inputCol="kept", outputCol="tf", numFeatures=FEATURES),
    ]
    rows = _with_text(weak_label(reviews)).select("text", F.col("label").cast("double").alias("label"))
    term_counts = PipelineModel(to_counts).transform(rows).select("label", "tf").persist()
    try:
        idf = IDF(inputCol="tf", outputCol="features").fit(term_counts)
        regression = LogisticRegression(maxIter=max_iter, regParam=reg_param).fit(idf.transform(term_counts))
    finally:
        term_counts.unpersist()
    return PipelineModel([*to_counts, idf, regression])


def predict(model: PipelineModel, reviews: DataFrame) -> DataFrame:
    """Add ``prediction`` and ``proba``; for tables and streams alike."""
    scored = model.transform(_with_text(reviews))
    return scored.withColumn("proba", vector_to_array("probability")).drop(
        "words", "kept", "tf", "features", "rawPrediction", "probability"
    )


def evaluate(predictions: DataFrame, labels: DataFrame, key: str = "review_id") -> DataFrame:
    """Per model: rows compared and accuracy of ``pred_label`` against ``label``."""
    joined = predictions.select(key, "model", "pred_label").join(labels.select(key, "label"), key)
    hit = (F.col("pred_label") == F.col("label")).cast("double")
    return joined.groupBy("model").agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))


def confusion(predictions: DataFrame, labels: DataFrame, key: str = "review_id") -> DataFrame:
    joined = predictions.select(key, "model", "pred_label").join(labels.select(key, "label"), key)
    return joined.groupBy("model", "label", "pred_label").agg(F.count("*").alias("n"))
