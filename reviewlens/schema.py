"""Record schemas and the fixed values the scoring and display rules depend on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _schema(columns: str) -> T.StructType:
    """A flat schema from ``name type, ...``; unlike a DDL parse it needs no session, so Python
    workers can import this module."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


REVIEW = _schema(
    "platform string, review_id string, product_id string, product_name string, product_url string, "
    "category_id string, category_name string, rating int, title string, content string, "
    "reviewer_name string, create_time string, crawled_at double, source_type string, source_id string"
)

PREDICTION = _schema(
    "review_id string, platform string, product_id string, category_id string, category_name string, "
    "rating int, reviewer_name string, title string, content string, text string, pred_label int, "
    "pred_label_vn string, pred_proba_vec string, model string, ts bigint"
)

PREDICTION_V1 = _schema(
    "review_id string, predicted_sentiment int, sentiment_label string, confidence double, "
    "pred_proba_negative double, pred_proba_neutral double, pred_proba_positive double, model string, "
    "timestamp string, platform string, category_name string, product_name string, product_id string, "
    "reviewer_name string, content string, title string, rating int, content_length int, "
    "flink_processed boolean"
)

CONTROL_RULE = _schema("product_id string, category_id string, scope string, active_model string")

# Types of one element of the shop's response pages.
API_REVIEW = (
    "struct<id: bigint, rating: int, title: string, content: string, created_at: string, "
    "created_by: struct<name: string>>"
)
API_PRODUCT = (
    "struct<id: bigint, name: string, brand_name: string, brand: struct<slug: string>, categories: variant>"
)


@dataclass(frozen=True)
class Verdict:
    """What a rule says about one review: class id, label, probability per class id."""

    label_id: int
    label: str
    proba: tuple[float, ...]


@dataclass(frozen=True)
class RuleSpec:
    """A lexicon-and-rating rule. The rating bounds are shared by all versions."""

    positive_words: tuple[str, ...]
    negative_words: tuple[str, ...]
    positive: Verdict
    negative: Verdict
    neutral: Verdict
    good_rating: int = 4
    bad_rating: int = 2
    default_rating: int = 3


# Lexicons, labels and probabilities of the two rule versions.
V2_RULES = RuleSpec(
    positive_words=("tốt", "hay", "đẹp", "ok", "ổn", "good", "nice", "great", "excellent", "tuyệt"),
    negative_words=("tệ", "kém", "dở", "bad", "poor", "terrible", "awful", "worst", "không tốt"),
    positive=Verdict(1, "Tốt", (0.1, 0.8, 0.1)),
    negative=Verdict(0, "Không tốt", (0.8, 0.1, 0.1)),
    neutral=Verdict(2, "Trung bình", (0.2, 0.2, 0.6)),
)

V1_RULES = RuleSpec(
    positive_words=("tốt", "hay", "đẹp", "ok", "ổn", "good", "nice", "great", "excellent"),
    negative_words=("tệ", "kém", "dở", "bad", "poor", "terrible", "awful", "worst"),
    positive=Verdict(2, "positive", (0.1, 0.3, 0.6)),
    negative=Verdict(0, "negative", (0.6, 0.3, 0.1)),
    neutral=Verdict(1, "neutral", (0.25, 0.5, 0.25)),
)

# Fixed value: the verdict when a v1 scorer is unreachable, and its confidence.
V1_UNSCORED = Verdict(1, "neutral", (0.33, 0.34, 0.33))
V1_UNSCORED_CONFIDENCE = 0.33

# Class id -> label. The first is canonical; the second is the order in which a
# three-class transformer head reports neutral before positive.
LABELS = {0: "Không tốt", 1: "Tốt", 2: "Trung bình"}
LABELS_NEUTRAL_MIDDLE = {0: "Không tốt", 1: "Trung bình", 2: "Tốt"}

# v1 label text -> display text, and v1 class id -> canonical class id.
LABEL_TRANSLATIONS = {"positive": "Tích cực", "negative": "Tiêu cực", "neutral": "Trung tính"}
V1_TO_CANONICAL = {0: 0, 1: 2, 2: 1}

# Topics the two scorers listen on, and the model names they write.
TOPIC_BASELINE = "reviews_raw"
TOPIC_TRANSFORMER = "reviews"
MODEL_BASELINE = "baseline"
MODEL_TRANSFORMER = "phobert"
# Fixed value: what routing rules call the baseline model.
RULE_NAMES = {MODEL_BASELINE: "spark-baseline", MODEL_TRANSFORMER: "phobert"}

# Display columns, in order.
REVIEW_DISPLAY = ("platform", "category_name", "reviewer_name", "product_name", "content", "create_time")
PREDICTION_DISPLAY = (
    "platform", "category_name", "reviewer_name", "product_id", "review_id",
    "pred_label_vn", "content_display", "model", "ts",
)
