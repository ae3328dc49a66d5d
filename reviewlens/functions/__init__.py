"""Column functions: no joins, no shuffles, all JVM-side."""

from reviewlens.functions.labels import (
    argmax, confidence, label_name, proba_json, softmax, translate,
)
from reviewlens.functions.text import (
    abbrev_id, compose_text, ellipsize, rating_badge, strip, tokens,
)
from reviewlens.functions.times import format_ts, format_ts_text, naive_iso_time, review_instant
from reviewlens.functions.urls import classify_url, md5_mod, product_url

__all__ = [
    "abbrev_id", "argmax", "classify_url", "compose_text", "confidence", "ellipsize", "format_ts",
    "label_name", "md5_mod", "naive_iso_time", "proba_json", "product_url", "rating_badge",
    "review_instant", "softmax", "strip", "tokens", "translate",
]
