"""The first rows of each key over a whole stream, kept in state across batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from reviewlens.operators.keyed import last_by
from reviewlens.sources.tables import KeyedTable
from reviewlens.streaming.jobs import trigger_opts

#: Spark keeps state of this kind in RocksDB: on local disk, with its changes in the checkpoint folder.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_SETTING = "spark.sql.streaming.stateStore.providerClass"
KEPT = "kept"
CHANGES = StructType().add("key", "string").add("rank_key", "double").add("row_id", "string").add(KEPT, "boolean")


class BestRows(StatefulProcessor):
    """Keeps the ``n`` best rows of a key as list state and reports every change to them.

    Rows are ``(rank key, row id, ...)``: a smaller rank key is better, equal ones go by id. A row id
    that is held already is ignored, so a message read twice changes nothing. ``removals`` also
    reports rows that a better one pushed out, as ``kept = false``.
    """

    def __init__(self, schema: StructType, n: int, ttl_ms: int | None, removals: bool):
        self.schema, self.n, self.ttl_ms, self.removals = schema, n, ttl_ms, removals
        self.names = schema.names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getListState("best", self.schema, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.best.get()]
        best = list(held)
        for frame in rows:  # lists, as most keys have a few rows
            seen = {r[1] for r in best}
            new = {}
            for r in sorted(zip(*(frame[name].tolist() for name in self.names), strict=True)):
                if r[1] not in seen:
                    new.setdefault(r[1], r)
            best = sorted([*best, *new.values()])[: self.n]
        if best == held:
            return
        self.best.put(best)
        added = [(*r, True) for r in best if r not in held]
        gone = [(*r, False) for r in held if r not in best] if self.removals else []
        yield pd.DataFrame([(key[0], *r) for r in [*gone, *added]], columns=["key", *self.names, KEPT])

    def close(self) -> None:
        pass


def best_of_frames(frames: Iterable[pd.DataFrame], n: int) -> Iterator[pd.DataFrame]:
    """Of each frame the rows that can be among the ``n`` best of their key, besides ``n`` ids that are held already."""
    for frame in frames:
        ordered = frame.sort_values(["rank_key", "row_id"]).drop_duplicates(["key", "row_id"])
        yield ordered.groupby("key", sort=False).head(2 * n)


def cap_stream(
    rows: DataFrame, key: str, rank: Column, row_id: str, n: int, ttl_ms: int | None = None, salts: int = 1
) -> DataFrame:
    """``key, rank_key, row_id, kept`` for every change to the ``n`` rows of each key with the smallest ``rank``.

    The final rows, those whose last report is ``kept``, are those of ``cap_per_group`` over all that
    arrived, in whatever order. ``rank`` is a bigint or double; equal ranks go by ``row_id`` (a
    string). State is ``n`` rows a key; with ``ttl_ms`` a key that nothing changed for so long is
    forgotten, and starts anew.

    Tasks first cut each Arrow batch of their rows to the best of each key, so that one key may be a large
    part of the stream. If ``n`` is no small number beside such a batch, ``salts`` puts a cap by key and
    a hash of the id in between, at the cost of state for each key and hash. A row without key or id is left
    out. Call ``use_state_store`` first.
    """
    value = rank.cast("double").alias("rank_key")
    given = rows.select(F.col(key).cast("string").alias("key"), value, F.col(row_id).cast("string").alias("row_id")).dropna()
    state = StructType([f for f in CHANGES.fields if f.name in ("rank_key", "row_id")])

    def capped(df: DataFrame, by: list[str], removals: bool) -> DataFrame:
        processor = BestRows(state, n, ttl_ms, removals)
        return df.groupBy(*by).transformWithStateInPandas(processor, CHANGES, outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")

    cut = given.mapInPandas(lambda frames: best_of_frames(frames, n), given.schema)
    if salts > 1:
        cut = capped(cut.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(salts))), ["key", "salt"], False)
    return capped(cut, ["key"], True)


def use_state_store(spark: SparkSession) -> None:
    """Let the streams of this session that start from now on keep their state in RocksDB."""
    spark.conf.set(PROVIDER_SETTING, STATE_STORE)




def start_caps(changes: DataFrame, table: KeyedTable, checkpoint: str, trigger: dict | None = None, name: str = "caps") -> StreamingQuery:
    """Write the changes of ``cap_stream`` to an append-only table, one partition per batch."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, (checkpoint, batch_id))

    stream = changes.writeStream.queryName(name).option("checkpointLocation", checkpoint).outputMode("append")
    return stream.trigger(**(trigger or trigger_opts()[1])).foreachBatch(apply).start()


def capped_rows(table: KeyedTable, order: Sequence[str] = ("batch_id",)) -> DataFrame:
    """``key, rank_key, row_id``: what the caps hold now. A row enters once and leaves at most once."""
    latest = last_by(table.batches(), ["key", "row_id"], [*order, "written_at"])
    return latest.filter(KEPT).select("key", "rank_key", "row_id")
