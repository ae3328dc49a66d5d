"""Rule scoring with built-in expressions only, so that it stays in whole-stage codegen."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions import confidence
from reviewlens.operators.evaluate import computed_once
from reviewlens.schema import V1_UNSCORED, V1_UNSCORED_CONFIDENCE, V2_RULES, RuleSpec, Verdict

SCORE_COLUMNS = ("pred_label", "pred_label_vn", "proba", "confidence")


def _hits(lowered: Column, words: tuple[str, ...]) -> Column:
    """How many of ``words`` occur as substrings; a repeated word counts once."""
    return reduce(add, [lowered.contains(word).cast("int") for word in words])


def lexicon_counts(reviews: DataFrame, spec: RuleSpec = V2_RULES) -> DataFrame:
    """Add ``pos_count`` and ``neg_count`` over the lower-cased content (title not included)."""
    return (
        reviews.withColumn("_lowered", F.lower(F.coalesce("content", F.lit(""))))
        .withColumn("pos_count", _hits(F.col("_lowered"), spec.positive_words))
        .withColumn("neg_count", _hits(F.col("_lowered"), spec.negative_words))
        .drop("_lowered")
    )


def _verdict(v: Verdict) -> Column:
    return F.struct(
        F.lit(v.label_id).alias("pred_label"),
        F.lit(v.label).alias("pred_label_vn"),
        F.array(*[F.lit(p) for p in v.proba]).alias("proba"),
    )


def _with_score(df: DataFrame, verdict: Column) -> DataFrame:
    """Unpack a verdict struct into the score columns."""
    return (
        df.withColumn("_v", verdict)
        .withColumns(
            {
                "pred_label": F.col("_v.pred_label"),
                "pred_label_vn": F.col("_v.pred_label_vn"),
                "proba": F.col("_v.proba"),
                "confidence": confidence(F.col("_v.proba")),
            }
        )
        .drop("_v")
    )


def score_rules(reviews: DataFrame, spec: RuleSpec = V2_RULES) -> DataFrame:
    """Class, label, probabilities and confidence by rating and lexicon.

    A good rating or more positive than negative words is positive; otherwise a bad rating or more
    negative than positive words is negative; the rest is neutral. A missing rating counts as the
    default. A good rating settles the verdict alone, so the content of such rows is neither
    lower-cased nor searched: most reviews carry four or five stars. The lower-cased text has its
    own projection because Catalyst keeps a value that several expressions use in the lower one.
    """
    rating = F.coalesce("rating", F.lit(spec.default_rating))
    undecided = rating < spec.good_rating
    lowered = reviews.withColumn("_lowered", F.when(undecided, F.lower(F.coalesce("content", F.lit("")))))
    balance = _hits(F.col("_lowered"), spec.positive_words) - _hits(F.col("_lowered"), spec.negative_words)
    weighed = computed_once(lowered, "_lean", F.when(undecided, balance).otherwise(1)).drop("_lowered")
    lean = F.col("_lean")
    verdict = (
        F.when(lean > 0, _verdict(spec.positive))
        .when((rating <= spec.bad_rating) | (lean < 0), _verdict(spec.negative))
        .otherwise(_verdict(spec.neutral))
    )
    return _with_score(weighed, verdict).drop("_lean")


def score_rating(reviews: DataFrame, spec: RuleSpec = V2_RULES) -> DataFrame:
    """The rating-only rule that replaces a model when its answer is unusable."""
    rating = F.coalesce("rating", F.lit(spec.default_rating))
    verdict = (
        F.when(rating >= spec.good_rating, _verdict(spec.positive))
        .when(rating <= spec.bad_rating, _verdict(spec.negative))
        .otherwise(_verdict(spec.neutral))
    )
    return _with_score(reviews, verdict)


def score_neutral(reviews: DataFrame) -> DataFrame:
    """The constant verdict of the older record version when its scorer gives no answer."""
    return _with_score(reviews, _verdict(V1_UNSCORED)).withColumn("confidence", F.lit(V1_UNSCORED_CONFIDENCE))
