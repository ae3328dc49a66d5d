"""Stored tables: plain parquet, keyed parquet tables, and ``MERGE INTO`` for catalogs that offer it.

A keyed table is one parquet folder partitioned by stream and batch. A write adds its own rows and
touches no others; a batch that is repeated replaces its own partition, by Spark's dynamic partition
overwrite. Which row of a key counts is decided when the table is read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from reviewlens.operators.keyed import insert_new, last_by, new_only

#: The partition columns, and the time of the write in microseconds.
STREAM, BATCH, WRITTEN = "stream_id", "batch_id", "written_at"
Batch = tuple[str, int]
#: A write of many batches of one stream: each row names the number of its own.
Batches = tuple[str, Column]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merge_into(spark: SparkSession, target: str, changes: DataFrame, keys: Sequence[str], order: str) -> None:
    """Upsert into a catalog table that supports ``MERGE INTO``; ``changes`` has one row per key."""
    changes.createOrReplaceTempView("_changes")
    match = " AND ".join(f"t.`{k}` <=> c.`{k}`" for k in keys)
    spark.sql(
        f"MERGE INTO {target} t USING _changes c ON {match} "
        f"WHEN MATCHED AND c.`{order}` >= t.`{order}` THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


class KeyedTable:
    """A parquet table written in batches.

    With ``order``, a reader sees one row per key: the last by those columns, then by the time of
    the write. Without, it sees all rows: written once per key by ``insert``, or as they are by
    ``append``. A batch is (stream name, batch id); a write without one is a batch of its own.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str] | None = ("ts",)
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order = list(keys), None if order is None else list(order)
        self.stored = StructType(
            [*schema.fields, StructField(WRITTEN, LongType()), StructField(STREAM, StringType()), StructField(BATCH, LongType())]
        )
        self._write(spark.createDataFrame([], self.stored), "ignore", "static")

    def _write(self, rows: DataFrame, mode: str, overwrite: str) -> None:
        writer = rows.write.mode(mode).option("partitionOverwriteMode", overwrite)
        writer.partitionBy(STREAM, BATCH).parquet(self.path)

    # reading

    def batches(self) -> DataFrame:
        """Every row of every write, with the columns ``stream_id, batch_id, written_at``."""
        return self.spark.read.schema(self.stored).parquet(self.path)

    def read(self) -> DataFrame:
        rows = self.batches()
        if self.order is not None:
            rows = last_by(rows, self.keys, [*self.order, WRITTEN])
        return rows.select(*self.schema.names)

    def others(self, batch: Batch) -> DataFrame:
        """The rows of all batches but this one and, of its stream, later ones."""
        stream, number = self._named(batch)
        return self.batches().filter((F.col(STREAM) != stream) | (F.col(BATCH) < number)).select(*self.schema.names)

    def of(self, batch: Batch) -> DataFrame:
        """The rows that one batch brought."""
        stream, number = self._named(batch)
        return self.batches().filter((F.col(STREAM) == stream) & (F.col(BATCH) == number)).select(*self.schema.names)

    # writing

    @staticmethod
    def _named(batch: Batch | Batches | None) -> Batch | Batches:
        if batch is None:
            return uuid.uuid4().hex, 0
        return hashlib.md5(batch[0].encode()).hexdigest(), batch[1]

    def _store(self, rows: DataFrame, batch: Batch | Batches | None) -> None:
        """Write ``rows`` as a batch. One that leaves no rows leaves what an earlier attempt wrote, so
        a batch must be made from the same input each time, as Spark's checkpoints see to."""
        stream, number = self._named(batch)
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        stamp = F.unix_micros(F.current_timestamp()).alias(WRITTEN)
        number = number if isinstance(number, Column) else F.lit(number)
        named = rows.select(*columns, stamp, F.lit(stream).alias(STREAM), number.cast("bigint").alias(BATCH))
        self._write(named, "overwrite", "dynamic")

    def upsert(self, changes: DataFrame, batch: Batch | None = None) -> None:
        """Write ``changes``, last write wins; repeated, a batch replaces what it wrote before.

        A column ``seq`` of ``changes`` decides between changes of equal order; without it, either of
        two such changes of one batch may win.
        """
        if self.order is None:
            raise ValueError("this table has no order of writes")
        if "seq" in changes.columns:
            changes = last_by(changes, self.keys, [*self.order, "seq"])
        self._store(changes, batch)

    def insert(self, new: DataFrame, order: Sequence[Column | str], batch: Batch | None = None) -> DataFrame:
        """Add the first row of each key that no other batch holds; returns the rows added.

        Only the key columns of the table are read. Repeated, a batch adds the same rows again, in
        place of those it added before; a frame that still reads those must be made anew. One process
        at a time may insert.
        """
        batch = batch or (uuid.uuid4().hex, 0)
        self._store(insert_new(new, self.others(batch).select(*self.keys), self.keys, order), batch)
        return self.of(batch)

    def new_keys(self, changes: DataFrame, batch: Batch) -> DataFrame:
        """The keys of ``changes`` that no other batch holds, each once."""
        return new_only(changes.select(*self.keys).distinct(), self.others(batch).select(*self.keys), self.keys)

    def append(self, rows: DataFrame, batch: Batch | Batches | None = None) -> None:
        """Add rows as they are, whatever their keys; as one batch, or each to the batch a column names."""
        self._store(rows, batch)

    def rewritten(self, path: str) -> KeyedTable:
        """A new table at ``path`` with what a reader sees now, in one batch: to be run now and then
        on a table of many small batches, whose readers and writers then move to the new path."""
        target = KeyedTable(self.spark, path, self.schema, self.keys, self.order)
        target._store(self.read(), ("rewritten", 0))
        return target

    def clear(self) -> int:
        """Empty the table and delete its files; returns how many rows it had."""
        removed = self.read().count()
        self._write(self.spark.createDataFrame([], self.stored), "overwrite", "static")
        return removed


def clear_all(*tables: KeyedTable) -> list[int]:
    """Clear several tables, such as reviews and predictions; returns the rows each had."""
    return [table.clear() for table in tables]
