"""Pages, newest rows, samples and scoring batches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from reviewlens.session import ensure_checkpoint_dir

# Rows a single task may be asked to keep in order to skip them. Beyond, keys are numbered first; the
# rows of a page are the same either way.
MAX_TOP_ROWS = 100_000


def newest(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows: each task keeps its own top ``n``, one task merges them."""
    return df.orderBy(*order).limit(n)


def number_rows(df: DataFrame, order: Sequence[Column], position: str = "position") -> DataFrame:
    """Every row with its position in the global order, from 0, with no task holding all rows.

    The rows are range-partitioned and sorted, and the sorted partitions are checkpointed so that
    partition ids stay the same for both uses: counting rows per partition, and ranking inside a
    partition. The counts are one row per partition, hence small enough to broadcast and to sum up
    in one window. Pass only the columns needed: they are all written to the checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*order).withColumn("_pid", F.spark_partition_id()).checkpoint()
    counts = ordered.groupBy("_pid").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_pid").orderBy(*order)
    return (
        ordered.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(starts), "_pid")
        .withColumn(position, F.col("_start") + F.col("_rank") - 1)
        .drop("_pid", "_rank", "_start")
    )


def page(
    df: DataFrame, number: int, per_page: int, order: Sequence[Column], key: Sequence[str], deep: bool | None = None
) -> DataFrame:
    """Page ``number`` (from 1) with ``total_rows`` and ``total_pages`` on each row.

    ``order`` uses only ``key`` columns; rows of equal keys, NULL ones too, follow each other by a
    hash of all their columns, so that pages never overlap. A shallow page is a top-n. A deep one
    would make every task keep all skipped rows: its keys are found by position over the key columns
    alone, the rows that have them are taken from the table, and those of the first key that belong
    to pages before are skipped.
    """
    skip = (number - 1) * per_page
    total_order = [*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    if deep is None:
        deep = skip + per_page > MAX_TOP_ROWS
    if deep:
        numbered = number_rows(df.select(*key), order)
        spot = numbered.filter((F.col("position") >= skip) & (F.col("position") < skip + per_page))
        spot = spot.select(*[F.col(c).alias(f"_{c}") for c in key]).distinct()
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
        first = numbered.join(spot, same, "left_semi").agg(F.min("position")).first()[0]
        rows = df.join(spot, same, "left_semi")
        rows = rows.orderBy(*total_order).offset(skip - (first or 0) if first is not None else 0).limit(per_page)
    else:
        rows = df.orderBy(*total_order).offset(skip).limit(per_page)
    total = df.agg(F.count("*")).scalar()
    pages = F.greatest(F.lit(1), F.ceil(total / per_page)).cast("bigint")
    return rows.withColumns({"total_rows": total, "total_pages": pages})


#: Rows between two borders of a page index.
STRIDE = 10_000
_TIE = "_tie"


def _directed(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(name).asc_nulls_last() if up else F.col(name).desc_nulls_last() for name, up in order]


def _tie_break(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def write_page_index(df: DataFrame, path: str, order: Sequence[tuple[str, bool]], stride: int = STRIDE) -> None:
    """Store the keys of every ``stride``-th row in the order of ``(column, ascending)``, nulls last.

    One range-partitioned pass over the key columns, made once for a table that pages are read from;
    rows of equal keys are ordered by a hash of all columns. The index has one row per ``stride`` rows.
    """
    names = [name for name, _ in order]
    keys = df.select(*names, _tie_break(df).alias(_TIE))
    numbered = number_rows(keys, [*_directed(order), F.asc(_TIE)])
    numbered.filter(F.col("position") % stride == 0).coalesce(1).write.mode("overwrite").parquet(f"{path}/borders")
    df.agg(F.count("*").alias("n"), F.lit(stride).alias("stride")).write.mode("overwrite").parquet(f"{path}/size")


def _before(order: Sequence[tuple[str, bool]], border: Row) -> Column:
    """Whether a row comes before the border in the order."""
    result = F.col(_TIE) < border[_TIE]
    for name, up in reversed(order):
        column, value = F.col(name), border[name]
        if value is None:  # nulls come last: whatever has a value is before
            result = column.isNotNull() | (column.isNull() & result)
        else:
            ahead = (column < value) if up else (column > value)
            result = F.coalesce(ahead | ((column == value) & result), F.lit(False))
    return result


def _reaches(order: Sequence[tuple[str, bool]], border: Row | None, first: bool) -> Column:
    """A bound on the leading column that the scan can use to leave out row groups."""
    (name, up) = order[0]
    if border is None or border[name] is None:
        return F.lit(True)
    column, value = F.col(name), border[name]
    if first:
        return ((column >= value) if up else (column <= value)) | column.isNull()
    return (column <= value) if up else (column >= value)


def page_by_index(df: DataFrame, path: str, number: int, per_page: int, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """Page ``number`` (from 1) of ``df`` with ``total_rows`` and ``total_pages``, by a stored index of its keys.

    The rows between the borders around the page, a stride or two, are filtered out of the scan and
    sorted; nothing else is, however deep the page. The index must be of the same rows and order.
    """
    spark = df.sparkSession
    total, stride = spark.read.parquet(f"{path}/size").first()
    skip = (number - 1) * per_page
    low, high = skip - skip % stride, -(-(skip + per_page) // stride) * stride
    borders = spark.read.parquet(f"{path}/borders").filter(F.col("position").isin(low, high)).collect()
    at = {r["position"]: r for r in borders}  # two rows at most
    rows = df.withColumn(_TIE, _tie_break(df)).filter(_reaches(order, at.get(low), True))
    if low in at:
        rows = rows.filter(~_before(order, at[low]))
    else:
        rows = rows.limit(0)
    if high in at:
        rows = rows.filter(_reaches(order, at[high], False)).filter(_before(order, at[high]))
    chosen = rows.orderBy(*_directed(order), F.asc(_TIE)).offset(skip - low).limit(per_page).drop(_TIE)
    pages = max(1, -(-total // per_page))
    return chosen.withColumns({"total_rows": F.lit(total).cast("bigint"), "total_pages": F.lit(pages).cast("bigint")})


def page_after(df: DataFrame, after: Column | None, per_page: int, order: Sequence[Column]) -> DataFrame:
    """The next page by key: rows that satisfy ``after``, i.e. follow the last row shown.

    Costs the same at any depth, and a comparison on the leading column reaches the scan.
    """
    return newest(df if after is None else df.filter(after), per_page, order)


def sample_k(df: DataFrame, k: int, seed: int | str, key: str = "review_id", repeatable: bool = True) -> DataFrame:
    """``k`` random rows; the same ones for the same seed if ``repeatable``."""
    if not repeatable:
        return df.orderBy(F.rand()).limit(k)
    return df.orderBy(F.md5(F.concat(F.col(key), F.lit(str(seed)))), F.col(key)).limit(k)


def assign_batches(df: DataFrame, key: str = "review_id", size: int = 100, buckets: int | None = None) -> DataFrame:
    """Number rows, in the order of their unique key, into scoring batches of ``size``.

    By default ``batch_no`` counts through the whole frame and only the last batch is short; pass
    just the columns needed, since the numbering writes them to the checkpoint. With ``buckets``,
    rows are spread by a hash of the key and numbered inside their ``bucket`` without any global
    order; choose the number so that one bucket fits a task.
    """
    if buckets is None:
        numbered = number_rows(df, [F.asc(key)])
        batch_no = F.floor(F.col("position") / size).cast("bigint")
        return numbered.withColumn("bucket", F.lit(0).cast("bigint")).withColumn("batch_no", batch_no).drop("position")
    bucket = F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("long") % buckets
    window = Window.partitionBy("bucket").orderBy(key)
    batch_no = F.floor((F.row_number().over(window) - 1) / size).cast("bigint")
    return df.withColumn("bucket", bucket).withColumn("batch_no", batch_no)


def batch_count(batched: DataFrame) -> DataFrame:
    """How many batches ``assign_batches`` made, and over how many rows."""
    per_batch = batched.groupBy("bucket", "batch_no").agg(F.count("*").alias("n"))
    return per_batch.agg(F.count("*").alias("total_batches"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"))
