"""JSON messages to typed reviews, with the reason for every rejected one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.operators.evaluate import computed_once
from reviewlens.schema import REVIEW

NUMBER = "^(BIGINT|INT|DECIMAL|DOUBLE|FLOAT)"


def _get(path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col("_json"), f"$[0].{path}", kind)


def _type_of(path: str) -> Column:
    """Type name of a field, ``VOID`` for an explicit null, NULL when the field is missing."""
    return F.schema_of_variant(_get(path, "variant"))


def _parse(messages: DataFrame, value_col: str) -> DataFrame:
    # Parsed inside a list, because a lone value would be accepted with any text following it.
    wrapped = F.concat(F.lit("["), F.col(value_col), F.lit("]"))
    return computed_once(messages, "_json", F.try_parse_json(wrapped))


def decode_reviews(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """The review columns and ``reject_reason``, NULL for a good record.

    A record must be one JSON object whose content is a text. A missing rating stays NULL, and the
    scorers count it as their default; an explicit null or a rating that is no number is an error.
    A rating between whole numbers is stored as the whole number on which every scoring rule says
    the same: 4.5 as 4, 1.5 as 2, anything between 2 and 4 as 3. A missing content is an empty
    text, which the length filter drops.
    """
    parsed = _parse(messages, value_col)
    only = F.try_variant_get("_json", "$[0]", "variant")
    second = F.try_variant_get("_json", "$[1]", "variant")
    content_type, rating_type = _type_of("content"), _type_of("rating")
    number = _get("rating", "double")
    rating = F.when(number >= 4, F.floor(number)).when(number <= 2, F.ceil(number)).when(number.isNotNull(), 3)
    reason = (
        F.when(only.isNull() | second.isNotNull(), "malformed")
        .when(~F.schema_of_variant(only).startswith("OBJECT<"), "not_object")
        .when(content_type != "STRING", "bad_content")
        .when(rating_type == "VOID", "null_rating")
        .when(~rating_type.rlike(NUMBER), "bad_rating")
    )
    special = {
        "content": F.coalesce(_get("content"), F.lit("")),
        "rating": F.when(rating_type.rlike(NUMBER), rating).cast("int"),
    }
    fields = [
        special.get(f.name, _get(f.name, f.dataType.simpleString())).alias(f.name) for f in REVIEW.fields
    ]
    kept = [name for name in messages.columns if name != value_col]
    return parsed.withColumn("reject_reason", F.coalesce(reason, F.lit(""))).select(
        *kept, *fields, F.nullif(F.col("reject_reason"), F.lit("")).alias("reject_reason")
    )


def good(decoded: DataFrame) -> DataFrame:
    return decoded.filter("reject_reason is null").drop("reject_reason")


def bad(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """The rejected messages as they came, with the reason."""
    raw = messages.withColumn("raw_value", F.col(value_col))
    return decode_reviews(raw, value_col).filter("reject_reason is not null").select("raw_value", "reject_reason")


def encode(df: DataFrame) -> Column:
    """A row as one JSON object; NULL fields are written, so that they do not turn into missing ones."""
    return F.to_json(F.struct(*[F.col(name) for name in df.columns]), {"ignoreNullFields": "false"})
