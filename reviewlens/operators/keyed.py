"""Keeping one row per key, and checking that it is so."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

Order = Sequence[Column | str]


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    # Catalyst turns row_number() = 1 into a group limit before the shuffle as well, so a task
    # sends at most one row per key and a hot key costs one row per map task.
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def first_by(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """First arrival per key; ``order`` ascending must be total for a repeatable result."""
    return _one_per_key(df, keys, order)


def last_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last write per key, by the columns ``order`` descending; NULL counts as oldest."""
    return _one_per_key(df, keys, [F.col(name).desc_nulls_last() for name in order])


def upsert_latest(table: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``table`` with ``changes`` applied, last write wins; applying them again changes nothing."""
    return last_by(table.unionByName(changes), keys, order)


def already_stored(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of ``new`` that ``stored`` holds.

    ``stored`` is the probe side of the semi join, so when the batch is small Spark broadcasts the
    batch's keys and scans the table's key column without shuffling the table.
    """
    return stored.select(*keys).join(new.select(*keys).distinct(), list(keys), "left_semi").distinct()


def new_only(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key ``stored`` does not hold."""
    return new.join(already_stored(new, stored, keys), list(keys), "left_anti")


def insert_new(new: DataFrame, stored: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """The rows an insert-if-absent would add: the first of each key not stored yet.

    A missing key value is the empty one, so all such rows share one key.
    """
    filled = new.na.fill("", subset=list(keys))
    seen = already_stored(filled, stored.na.fill("", subset=list(keys)), keys)
    return first_by(filled, keys, order).join(seen, list(keys), "left_anti")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. Rows that lack every key column are exempt."""
    present = F.coalesce(*[F.col(name).cast("string") for name in keys]).isNotNull()
    return df.filter(present).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def cap_per_group(
    df: DataFrame, group: str, order: Order, n: int, spread: Sequence[str] = (), salts: int = 64
) -> DataFrame:
    """At most the ``n`` first rows of each group by ``order``.

    The group limit before the shuffle leaves ``n`` rows per group and map task. With ``spread``
    columns, the limit is first taken inside ``salts`` sub-groups, so that a group that fills a
    large part of the table is cut down by many tasks before one task ranks what is left. A row
    among the first ``n`` of its group is among the first ``n`` of its sub-group: the result is
    the same.
    """

    def cut(frame: DataFrame, *by) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return frame.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")

    if spread:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
        df = cut(salted, group, "_salt").drop("_salt")
    return cut(df, group)
