"""A text classifier that learns batch by batch: mergeable document frequencies, warm-started weights."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewlens.functions import compose_text
from reviewlens.operators import ml
from reviewlens.operators.filters import filter_content
from reviewlens.sources.decode import good
from reviewlens.streaming.jobs import _cached, _decoded, _start, trigger_opts

#: A stored model: one row per feature; the last one is the intercept, whose frequency counts the rows learned from.
MODEL = "cell int, weight double, slope double, df bigint"
#: Passes over the rows at hand, rows of a step, step size; rows of a task, as an average of many tasks
#: that saw few rows each learns little.
PASSES, STEP_ROWS, RATE, TASK_ROWS = 8, 32, 0.5, 2000


@dataclass(frozen=True)
class OnlineModel:
    """Weights, sums of squared gradients (which set the step sizes) and document frequencies."""

    weight: np.ndarray
    slope: np.ndarray
    df: np.ndarray

    @classmethod
    def empty(cls, features: int = ml.FEATURES) -> OnlineModel:
        return cls(np.zeros(features + 1), np.zeros(features + 1), np.zeros(features + 1, np.int64))

    @property
    def features(self) -> int:
        return len(self.weight) - 1

    def idf(self) -> np.ndarray:
        """Inverse document frequency over all rows learned from; 1 for the intercept."""
        weights = np.log((self.df[-1] + 1) / (self.df + 1))
        weights[-1] = 1.0
        return weights


def save(spark: SparkSession, model: OnlineModel, path: str) -> None:
    columns = (c.tolist() for c in (np.arange(model.features + 1), model.weight, model.slope, model.df))
    spark.createDataFrame(list(zip(*columns, strict=True)), MODEL).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> OnlineModel:
    """A stored model: a few thousand rows, whatever it was learned from."""
    rows = sorted(spark.read.schema(MODEL).parquet(path).collect())
    return OnlineModel(*(np.array([r[i] for r in rows], t) for i, t in ((1, float), (2, float), (3, np.int64))))


def term_cells(features: int, stopwords: Sequence[str] | None = None) -> Column:
    """The hashed terms of title and content, repeats included, without stop words."""
    words = F.split(F.lower(compose_text(F.col("title"), F.col("content"))), r"\s+")
    stops = StopWordsRemover.loadDefaultStopWords("english") if stopwords is None else stopwords
    counted = F.filter(words, lambda w: ~w.isin("", *stops))
    return F.transform(counted, lambda w: F.pmod(F.hash(w), F.lit(features)))


def vectors(cells: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of unit length as (start of each row, cell, value): term frequency times ``idf``, then the intercept."""
    last = len(idf) - 1
    sizes = np.diff(cells.offsets.to_numpy())
    flat = cells.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    both, times = np.unique(row * (last + 1) + flat, return_counts=True)
    row, cell = both // (last + 1), both % (last + 1)
    value = times * idf[cell]
    norm = np.sqrt(np.bincount(row, value * value, len(sizes)))
    value = value / np.maximum(norm[row], 1e-12)
    row = np.append(row, np.arange(len(sizes)))
    order = np.argsort(row, kind="stable")
    cell, value = np.append(cell, np.full(len(sizes), last))[order], np.append(value, np.ones(len(sizes)))[order]
    return np.append(0, np.cumsum(np.bincount(row, minlength=len(sizes)))), cell, value


def descend(weight: np.ndarray, slope: np.ndarray, start: np.ndarray, cell: np.ndarray, value: np.ndarray, label: np.ndarray) -> None:
    """Steps of logistic regression over the rows, each cell slowed down by its own past gradients."""
    for _ in range(PASSES):
        for first in range(0, len(label), STEP_ROWS):
            last = min(first + STEP_ROWS, len(label))
            own = slice(start[first], start[last])
            at = np.repeat(np.arange(last - first), np.diff(start[first : last + 1]))
            score = np.bincount(at, weight[cell[own]] * value[own], last - first)
            miss = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - label[first:last]
            gradient = np.bincount(cell[own], miss[at] * value[own], len(weight)) / (last - first)
            slope += gradient * gradient
            weight -= RATE * gradient / np.sqrt(slope + 1e-8)


def learn(model: OnlineModel, rows: DataFrame, stopwords: Sequence[str] | None = None) -> OnlineModel:
    """The model after the weakly labelled ``rows``; the cost is that of these rows alone.

    Document frequencies are added to those known. Each task then descends from the same weights
    over its own rows, block by block, and the tasks' weights are averaged by their rows. The driver
    receives one number per feature. Rows without label are left out; none leave the model as it is.
    """
    labelled = ml.weak_label(rows).select(term_cells(model.features, stopwords).alias("cells"), F.col("label").cast("double").alias("label"))
    with _cached(labelled) as known:
        n = known.count()
        if not n:
            return model
        df = model.df.copy()
        df[-1] += n
        for cell, count in known.select(F.explode(F.array_distinct("cells")).alias("c")).groupBy("c").count().collect():
            df[cell] += count
        before = OnlineModel(model.weight, model.slope, df)
        idf = before.idf()

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weight, slope, seen = before.weight.copy(), before.slope.copy(), 0
            for batch in batches:
                if batch.num_rows:
                    descend(weight, slope, *vectors(batch.column(0), idf), batch.column(1).to_numpy())
                    seen += batch.num_rows
            if seen:
                columns = pa.array(np.arange(len(weight)), pa.int32()), pa.array(weight * seen), pa.array(slope * seen)
                yield pa.RecordBatch.from_arrays(list(columns), names=["cell", "weight", "slope"])

        parts = known.coalesce(-(-n // TASK_ROWS)).mapInArrow(run, "cell int, weight double, slope double")
        weight, slope = np.zeros(len(df)), np.zeros(len(df))
        for cell, w, s in parts.groupBy("cell").agg(F.sum("weight"), F.sum("slope")).collect():
            weight[cell], slope[cell] = w / n, s / n
        return OnlineModel(weight, slope, df)


def predict(model: OnlineModel, rows: DataFrame, stopwords: Sequence[str] | None = None) -> DataFrame:
    """``rows`` with ``probability`` of a positive label and the ``prediction`` 0 or 1."""
    idf, weight = model.idf(), model.weight

    @F.pandas_udf("double")
    def positive(cells: pd.Series) -> pd.Series:
        start, cell, value = vectors(pa.array(cells, pa.list_(pa.int32())), idf)
        at = np.repeat(np.arange(len(cells)), np.diff(start))
        score = np.bincount(at, weight[cell] * value, len(cells))
        return pd.Series(1 / (1 + np.exp(-np.clip(score, -30, 30))))

    scored = rows.withColumn("probability", positive(term_cells(model.features, stopwords)))
    return scored.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


def start_online(
    messages: DataFrame, model_dir: str, checkpoint: str, features: int = ml.FEATURES, trigger: dict | None = None,
    name: str = "online",
) -> StreamingQuery:
    """Learn from each batch of messages, with a model stored per batch under ``model_dir/batch=<n>``.

    A batch starts from the model of the batch before, so one that is repeated leaves the same model.
    Every row is learned from once per arrival: feed it the messages of ``start_ingest``, which
    publishes each review once.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        model = load(spark, f"{model_dir}/batch={batch_id - 1:09d}") if batch_id else OnlineModel.empty(features)
        save(spark, learn(model, filter_content(good(batch))), f"{model_dir}/batch={batch_id:09d}")

    return _start(_decoded(messages), apply, name, checkpoint, trigger or trigger_opts()[1])
