"""Keeping Catalyst from evaluating a costly expression again in every filter above it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that later filters read instead of recomputing.

    A filter on an ordinary computed column is pushed below it with the expression substituted, and
    filters share no subexpressions: a parse or a text search would run once per mention. A filter
    on the output of a generator stays above it. The generator yields one row per row, stays inside
    whole-stage codegen, and lets filters on other columns and column pruning through.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
