"""Scoring with a Python model, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.functions import compose_text, confidence, label_name
from reviewlens.operators.scoring import score_rating
from reviewlens.schema import LABELS

Scorer = Callable[[list[str]], tuple[list[int], list[list[float]]]]
ScorerFactory = Callable[[], Scorer]

RESULT = "pred int, proba array<double>, status string"


class ScorerUnavailable(Exception):
    """The model cannot be reached: its rows go to the error channel, not to the table."""


def _score_batch(score: Scorer, texts: list[str]) -> list[tuple]:
    """One result per text; the whole batch shares a failure, as one request would."""
    try:
        labels, probas = score(texts)
    except ScorerUnavailable:
        return [(None, None, "unavailable")] * len(texts)
    except Exception:  # the model answered with something unusable
        return [(None, None, "bad_response")] * len(texts)
    if len(labels) != len(texts) or len(probas) != len(texts):
        return [(None, None, "bad_response")] * len(texts)
    return [(int(label), [float(p) for p in proba], "ok") for label, proba in zip(labels, probas)]


def score_column(text: Column, scorer_factory: ScorerFactory, batch: int = 100) -> Column:
    """``struct<pred, proba, status>`` of a text column.

    The model is built once per task, then fed batches of at most ``batch`` texts. Only the text
    leaves the JVM: the other columns of a row wait for its result, so predictions need not be
    matched back by position or by a join. A model sees whole texts; one that has a limit of its own
    applies it in its tokenizer.
    """

    @F.pandas_udf(RESULT)
    def score_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = scorer_factory()
        for series in batches:
            texts = series.fillna("").tolist()
            results = [r for i in range(0, len(texts), batch) for r in _score_batch(score, texts[i : i + batch])]
            yield pd.DataFrame(results, columns=["pred", "proba", "status"]).astype({"pred": "Int32"})

    # Declared non-deterministic so that a filter on the result does not run the model once more.
    return score_texts.asNondeterministic()(text)


def windows_of(text: str, size: int) -> list[str]:
    """The text in runs of ``size`` words; a text without words is one empty window."""
    words = text.split()
    return [" ".join(words[i : i + size]) for i in range(0, max(len(words), 1), size)]


def score_windows(text: Column, scorer_factory: ScorerFactory, size: int = 160, batch: int = 100) -> Column:
    """``struct<pred, proba, status>`` of texts longer than the model takes: all their windows, pooled.

    A text is cut into windows of ``size`` words, all of them scored. Its probabilities are the mean
    over its windows, each weighted by its words; ``pred`` is the label of the most probable class, by the
    order in which the model lists its classes, so the labels must be their positions. Windows of
    all texts at hand share batches, longest first, so that a batch is padded little. A text of which
    any window failed has that window's status and no answer.
    """

    @F.pandas_udf(RESULT)
    def score_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = scorer_factory()
        for series in batches:
            parts = [(i, w) for i, t in enumerate(series.fillna("")) for w in windows_of(t, size)]
            parts.sort(key=lambda p: -len(p[1].split()))
            sums: list[list[float] | None] = [None] * len(series)
            weight, status = [0] * len(series), ["ok"] * len(series)
            for first in range(0, len(parts), batch):
                own = parts[first : first + batch]
                for (i, window), (_, proba, state) in zip(own, _score_batch(score, [w for _, w in own]), strict=True):
                    if state != "ok":
                        status[i] = state
                        continue
                    n = max(len(window.split()), 1)
                    sums[i] = [a + n * p for a, p in zip(sums[i] or [0.0] * len(proba), proba, strict=True)]
                    weight[i] += n
            rows = []
            for total, n, state in zip(sums, weight, status, strict=True):
                pooled = [p / n for p in total] if state == "ok" else None
                rows.append((max(range(len(pooled)), key=pooled.__getitem__) if pooled else None, pooled, state))
            yield pd.DataFrame(rows, columns=["pred", "proba", "status"]).astype({"pred": "Int32"})

    return score_texts.asNondeterministic()(text)


def score_with(
    reviews: DataFrame,
    scorer_factory: ScorerFactory,
    batch: int = 100,
    labels: dict[int, str] = LABELS,
    window: int | None = None,
) -> DataFrame:
    """Add ``pred_label``, ``pred_label_vn``, ``proba``, ``confidence`` and ``status``.

    With ``window``, texts are scored in windows of so many words and pooled (``score_windows``).
    """
    text = compose_text(F.col("title"), F.col("content"))
    scored = score_windows(text, scorer_factory, window, batch) if window else score_column(text, scorer_factory, batch)
    return (
        reviews.withColumn("_r", scored)
        .withColumns(
            {
                "pred_label": F.col("_r.pred"),
                "pred_label_vn": label_name(F.col("_r.pred"), labels),
                "proba": F.col("_r.proba"),
                "confidence": confidence(F.col("_r.proba")),
                "status": F.col("_r.status"),
            }
        )
        .drop("_r")
    )


def resolve_failures(scored: DataFrame) -> DataFrame:
    """Rows to save: model verdicts, and the rating rule's where the model's answer was unusable.

    Rows of an unreachable model are left out; ``failed`` returns them.
    """
    saved = scored.filter("status != 'unavailable'")
    names = ("pred_label", "pred_label_vn", "proba", "confidence")
    kept = saved.withColumnsRenamed({name: f"_m_{name}" for name in names})
    answered = F.col("status") == "ok"
    return (
        score_rating(kept)
        .withColumns({name: F.when(answered, F.col(f"_m_{name}")).otherwise(F.col(name)) for name in names})
        .drop(*[f"_m_{name}" for name in names])
    )


def failed(scored: DataFrame) -> DataFrame:
    return scored.filter("status = 'unavailable'")


def attach_by_key(reviews: DataFrame, scored: DataFrame, key: str = "review_id") -> DataFrame:
    """Externally computed predictions joined to their rows by key, one to one.

    Fails at run time on a review without a prediction, a prediction without a review, and a key
    that either side holds twice. The counts per key use the join's own partitioning.
    """

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.count("*").over(Window.partitionBy(key)))

    both = counted(reviews, "_own").join(counted(scored, "_found"), key, "full_outer")
    once = lambda name: F.coalesce(F.col(name), F.lit(0))
    wrong = (
        F.when(once("_found") == 0, "no prediction for ")
        .when(once("_own") == 0, "no review for ")
        .when((once("_found") > 1) | (once("_own") > 1), "more than one row for ")
    )
    checked = F.assert_true(wrong.isNull(), F.concat(wrong, F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return both.filter(checked.isNull()).drop("_own", "_found")
