"""Class ids, label texts and probability vectors."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, functions as F


def literal_map(values: Mapping) -> Column:
    return F.create_map(*[F.lit(item) for item in chain.from_iterable(values.items())])


def translate(label: Column, translations: Mapping[str, str]) -> Column:
    """Case-insensitive lookup; a label without a translation is kept as it is."""
    return F.coalesce(F.element_at(literal_map(translations), F.lower(label)), label)


def label_name(label_id: Column, names: Mapping[int, str]) -> Column:
    """Class id to name, ``Unknown(id)`` when the map has none."""
    unknown = F.concat(F.lit("Unknown("), label_id.cast("string"), F.lit(")"))
    return F.coalesce(F.element_at(literal_map(names), label_id), unknown)


def proba_json(proba: Column) -> Column:
    """A probability array as JSON text with a space after each comma."""
    inner = F.array_join(F.transform(proba, lambda p: p.cast("string")), ", ")
    return F.concat(F.lit("["), inner, F.lit("]"))


def confidence(proba: Column) -> Column:
    return F.array_max(proba)


def argmax(scores: Column) -> Column:
    """Position of the first maximum, from 0."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row instead of once per array element."""
    return F.transform(F.array(value), body)[0]


def softmax(logits: Column) -> Column:
    """Probabilities of a logit array; shifted by the maximum so that ``exp`` cannot overflow."""
    powers = _bind(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp(x - top)))

    def normalised(ps: Column) -> Column:
        total = F.aggregate(ps, F.lit(0.0), lambda acc, p: acc + p)
        return _bind(total, lambda t: F.transform(ps, lambda p: p / t))

    return _bind(powers, normalised)
