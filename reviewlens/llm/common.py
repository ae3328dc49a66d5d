"""Tables, shared-folder tables and Arrow helpers that the operators have in common."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from reviewlens.session import scratch_path

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting for removing a query's shuffle files once the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, clean: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here, and every reader sees the same rows.

    With ``clean``, the shuffle files of the write are removed at its end and not with the garbage of
    the driver; for frames that are written and not used again.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP)
    if clean:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch. Texts are large rows: at Spark's default a batch of them takes up to
#: hundreds of MB outside the heap, in the JVM and again in the worker.
BATCH_ROWS = 2000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def map_batches(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` in a session whose Arrow batches have ``BATCH_ROWS`` rows at most."""
    size = int(df.sparkSession.conf.get(BATCH_SETTING))
    if not 0 < size <= BATCH_ROWS:
        df.sparkSession.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def add_columns(
    df: DataFrame,
    text: str,
    fields: list[StructField],
    make: Callable[[list[bytes | None]], list[pa.Array]],
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with columns that ``make`` derives from the UTF-8 bytes of ``text``, batch by batch.

    ``keep`` names the columns that stay (all by default). A column of ``df`` that has the name of
    a new one is replaced.
    """
    new = [f.name for f in fields]
    stay = [c for c in (df.columns if keep is None else keep) if c not in new]
    source = df.select(*[F.col(f"`{c}`") for c in stay], F.col(f"`{text}`").cast("binary").alias("_text_bytes"))
    schema = StructType([f for c in stay for f in df.schema.fields if f.name == c] + fields)
    names = stay + new

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make(batch.column(len(stay)).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(stay))] + made, names=names)

    return map_batches(source, run, schema)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Positions at which a new group begins, for rows sorted by the integer columns ``keys``."""
    n = table.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def whole_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 1 << 16
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``keys`` as tables of whole groups, each with the groups' starts and its end.

    A table has ``rows`` rows, or one group if that is larger; callers bound their groups.
    """
    held: list[pa.RecordBatch] = []
    n = 0

    def cut(t: pa.Table) -> tuple[pa.Table, np.ndarray]:
        return t, np.append(group_starts(t, keys), t.num_rows)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            t = pa.Table.from_batches(held).combine_chunks()
            last = int(group_starts(t, keys)[-1])
            held, n = t.slice(last).to_batches(), t.num_rows - last
            if last:
                yield cut(t.slice(0, last))
    if held:
        yield cut(pa.Table.from_batches(held).combine_chunks())


def cells(rows: DataFrame, key: list[str], item: str, cap: int, count: str) -> DataFrame:
    """Rows dealt to cells ``(key, lo, hi)`` so that any two rows of a key meet in one cell.

    ``count`` holds the rows of the key. A key of up to ``cap`` rows is one cell. A larger one is
    split by a hash of ``item`` into parts of about ``cap`` rows, and each pair of parts is a cell:
    no task holds more than two parts, and no pair of rows is materialised. ``side`` is true for
    the rows of the first part of a cell.
    """
    parts = F.greatest(F.ceil(F.col(count) / F.lit(cap)).cast("int"), F.lit(1))
    split = rows.withColumn("_parts", parts).withColumn("_part", F.pmod(F.xxhash64(item), "_parts").cast("int"))
    dealt = split.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return dealt.select(
        *rows.columns,
        F.least("_part", "_other").alias("lo"),
        F.greatest("_part", "_other").alias("hi"),
        (F.col("_part") <= F.col("_other")).alias("side"),
    )


def repeated(rows: DataFrame, key: list[str], count: str) -> DataFrame:
    """The rows whose key occurs more than once, with the number of rows of the key."""
    sizes = rows.groupBy(*key).agg(F.count("*").alias(count)).filter(F.col(count) > 1)
    return rows.join(sizes, key)


def sorted_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt by ``keys`` and sorted by them, ready for ``whole_groups``."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: a lambda recomputes an expression at each mention."""
    return F.element_at(F.transform(F.array(value), use), 1)


#: Items combined in one step of a running sum or maximum.
STEP = 256


def running(items: Column, combine: Callable[[Column, Column], Column] = lambda a, x: a + x, zero: int = 0) -> Column:
    """What ``combine`` makes of all earlier items (by default their sum), for each item of an array of ints.

    It runs inside blocks and over the blocks, so that no long array is copied once per item.
    """
    return let(items, lambda known: _running(known, combine, zero))


def _running(items: Column, combine: Callable[[Column, Column], Column], zero: int) -> Column:
    def along(values: Column, first: Column) -> Column:
        begin = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda a, x: F.struct(combine(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
        return F.aggregate(values, begin, step)["out"]

    blocks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / STEP).cast("int"))
    part = lambda b: F.slice(items, b * STEP + 1, STEP)
    totals = F.transform(blocks, lambda b: F.aggregate(part(b), F.lit(zero), combine))
    return F.flatten(F.zip_with(blocks, along(totals, F.lit(zero)), lambda b, first: along(part(b), first)))
