"""The streaming jobs: ingest, two scorers, trend, bursts; starting, supervising, measuring them.

A job's progress lives in its checkpoint folder. Restarted with the same folder it resumes; with a
fresh one it replays from the start, which keyed tables make harmless. A batch repeated after a crash
replaces what it had written.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from reviewlens.operators import analytics, ml
from reviewlens.operators.documents import to_prediction
from reviewlens.operators.filters import filter_content
from reviewlens.operators.keyed import last_by
from reviewlens.operators.models import ScorerFactory, failed, resolve_failures, score_with
from reviewlens.operators.scoring import score_rules
from reviewlens.schema import LABELS, MODEL_BASELINE, MODEL_TRANSFORMER, REVIEW, V2_RULES, RuleSpec
from reviewlens.sources.decode import decode_reviews, encode, good
from reviewlens.sources.tables import KeyedTable
from reviewlens.sources.topics import write_routed

OUTCOMES = "outcomes"


def trigger_opts(
    fmt: str = "kafka", max_records: int = 128, max_ms: int = 1500, available_now: bool = False, max_files: int = 1
) -> tuple[dict, dict]:
    """Source options and trigger for small batches: at most ``max_records`` every ``max_ms``.

    The ``text`` format is limited by files, not by records; ``landed`` takes the same folders by records.
    """
    limits = {"kafka": {"maxOffsetsPerTrigger": max_records}, "landed": {"maxRecordsPerTrigger": max_records}}
    source = limits.get(fmt, {"maxFilesPerTrigger": max_files})
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{max_ms} milliseconds"}
    return source, trigger


@contextmanager
def _cached(df: DataFrame) -> Iterator[DataFrame]:
    """Compute a micro-batch once. Its true size is known from then on, so Spark broadcasts its
    keys to a big table only if they are small."""
    df.persist()
    df.count()
    try:
        yield df
    finally:
        df.unpersist()


def _start(df: DataFrame, apply: Callable[[DataFrame, int], None], name: str, checkpoint: str, trigger: dict):
    return (
        df.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(apply)
        .start()
    )


def _write_errors(rows: DataFrame, path: str, batch_id: int) -> None:
    """``review_id, reject_reason, raw_value`` of one batch's rejected messages, as they came or, for
    reviews that were not scored, as they can be sent again; a repeated batch replaces its own folder."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id:09d}")


def _decoded(messages: DataFrame) -> DataFrame:
    """Decoded messages; a rejected one keeps its text in ``raw_value``."""
    decoded = decode_reviews(messages.withColumn("raw_value", F.col("value")))
    kept = F.when(F.col("reject_reason").isNotNull(), F.col("raw_value"))
    return decoded.withColumn("raw_value", kept).observe(OUTCOMES, *analytics.outcome_metrics())


def _rejected(batch: DataFrame) -> DataFrame:
    return batch.filter("reject_reason is not null").select("review_id", "reject_reason", "raw_value")


def _last_arrivals(scored: DataFrame, stamp: Column) -> DataFrame:
    """The last version of each review in a batch: by prediction time, then by arrival."""
    numbered, order = in_order(scored.withColumn("_stamp", stamp.cast("bigint")))
    return last_by(numbered, ["review_id"], ["_stamp", *order])


def in_order(batch: DataFrame) -> tuple[DataFrame, list[str]]:
    """A batch and the columns that order it by arrival: a task reads a file's lines one after the other.

    Within a topic partition the offset decides. Producers may set a record's time, so across
    partitions a record counts as no earlier than any record before it in its own partition.
    """
    numbered = batch.withColumn("_line", F.monotonically_increasing_id())
    if "seq" not in batch.columns:
        return numbered, ["_line"]
    if "pos" in batch.schema["seq"].dataType.names:
        # One task reads a partition's part of a batch anyway.
        before = Window.partitionBy("seq.part").orderBy("seq.pos").rowsBetween(Window.unboundedPreceding, 0)
        place = F.struct(F.max("seq.at").over(before).alias("at"), "seq.part", "seq.pos")
        numbered = numbered.withColumn("_place", place).withColumn("seq", F.col("_place")).drop("_place")
    return numbered, ["seq", "_line"]


TOTALS = StructType().add("kind", "string").add("name", "string").add("n", "long")


def totals_table(spark: SparkSession, path: str) -> KeyedTable:
    """What each batch added to the totals: a few rows a batch, replaced if the batch is repeated."""
    return KeyedTable(spark, path, TOTALS, ["kind", "name"], order=None)


def running_totals(totals: KeyedTable, as_of: datetime) -> DataFrame:
    """As ``analytics.snapshot`` of both tables, from the batches' counts: neither table is read."""
    summed = totals.read().groupBy("kind", "name").agg(F.sum("n").alias("n"))
    return analytics.stamped(summed.filter("n > 0"), as_of)


def save_predictions(table: KeyedTable, rows: DataFrame, batch: tuple[str, int], totals: KeyedTable | None) -> None:
    """Upsert a batch, and count the keys that no other batch holds, for which only the table's key columns are read."""
    if totals is not None:
        totals.append(analytics.tally(table.new_keys(rows, batch), "model", "pred"), batch)
    table.upsert(rows, batch)


def start_baseline(
    messages: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    spec: RuleSpec = V2_RULES,
    ts: Column | None = None,
    trigger: dict | None = None,
    errors: str | None = None,
    name: str = MODEL_BASELINE,
    totals: KeyedTable | None = None,
) -> StreamingQuery:
    """Decode, drop short reviews, score by rules, upsert predictions.

    ``ts`` is the prediction time in epoch seconds, by default that of the batch; of versions with
    the same time the one that arrived last is kept. Rejected messages go to ``errors``, by default
    a folder beside the checkpoint; counts of new reviews to ``totals``.
    """
    rejects = errors or f"{checkpoint}.rejected"

    def apply(batch: DataFrame, batch_id: int) -> None:
        stamp = ts if ts is not None else F.unix_timestamp()
        with _cached(batch) as rows:
            scored = _last_arrivals(score_rules(filter_content(good(rows)), spec), stamp)
            save_predictions(table, to_prediction(scored, MODEL_BASELINE, F.col("_stamp")), (checkpoint, batch_id), totals)
            _write_errors(_rejected(rows), rejects, batch_id)

    return _start(_decoded(messages), apply, name, checkpoint, trigger or trigger_opts()[1])


def start_model(
    messages: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    scorer_factory: ScorerFactory,
    ts: Column | None = None,
    trigger: dict | None = None,
    errors: str | None = None,
    labels: dict[int, str] = LABELS,
    batch_size: int = 128,
    name: str = MODEL_TRANSFORMER,
    totals: KeyedTable | None = None,
) -> StreamingQuery:
    """As ``start_baseline`` with a Python model.

    An unusable answer is replaced by the rating rule. While the model is unreachable, its reviews
    go to ``errors``, as messages that can be sent again, and are not saved.
    """
    rejects = errors or f"{checkpoint}.rejected"

    def apply(batch: DataFrame, batch_id: int) -> None:
        stamp = ts if ts is not None else F.unix_timestamp()
        decoded = filter_content(good(batch))
        with _cached(score_with(decoded, scorer_factory, batch_size, labels)) as scored:
            saved = _last_arrivals(resolve_failures(scored), stamp)
            save_predictions(table, to_prediction(saved, MODEL_TRANSFORMER, F.col("_stamp")), (checkpoint, batch_id), totals)
            lost = failed(scored)
            unsaved = lost.select(
                "review_id", F.lit("unavailable").alias("reject_reason"),
                encode(lost.select(*REVIEW.names)).alias("raw_value"),
            )
            _write_errors(unsaved.unionByName(_rejected(batch)), rejects, batch_id)

    return _start(_decoded(messages), apply, name, checkpoint, trigger or trigger_opts()[1])


def start_ingest(
    messages: DataFrame, table: KeyedTable, out: str, checkpoint: str, trigger: dict | None = None,
    name: str = "ingest", fmt: str = "text", errors: str | None = None, totals: KeyedTable | None = None, **options,
) -> StreamingQuery:
    """Store each review once and publish the new ones.

    They go to files of ``fmt`` under ``out/batch=<n>/topic=<t>``, or with ``kafka`` to their topics
    (``options`` as for ``write_routed``). The table decides what is new, so a repeat that arrives
    much later is still recognised. Rejected messages go to ``errors``, by default a folder beside
    the checkpoint; counts of new reviews to ``totals``.
    """
    rejects = errors or f"{checkpoint}.rejected"

    def apply(batch: DataFrame, batch_id: int) -> None:
        with _cached(batch) as rows:
            numbered, arrived = in_order(good(rows).drop("raw_value"))
            added = table.insert(numbered, ["crawled_at", *arrived], (checkpoint, batch_id))
            write_routed(added, fmt, f"{out}/batch={batch_id:09d}", mode="overwrite", **options)
            if totals is not None:
                totals.append(analytics.tally(added, "platform", "raw"), (checkpoint, batch_id))
            _write_errors(_rejected(rows), rejects, batch_id)

    return _start(_decoded(messages), apply, name, checkpoint, trigger or trigger_opts()[1])


def dedup_stream(df: DataFrame, key: str, delay: str, event_time: str = "event_time") -> DataFrame:
    """Drop repeats of ``key`` that arrive within ``delay``: a cheap filter ahead of ``start_ingest``.

    Rows later than the watermark are lost, so use it only where ``delay`` covers the disorder.
    """
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def scored_stream(messages: DataFrame, spec: RuleSpec = V2_RULES) -> DataFrame:
    """Rule predictions of a message stream, with ``ts`` the crawl time."""
    scored = score_rules(filter_content(good(decode_reviews(messages))), spec)
    return to_prediction(scored, MODEL_BASELINE, F.col("crawled_at"))


def start_trend(
    predictions: DataFrame, path: str, checkpoint: str, window: str = "5 minutes", delay: str = "10 minutes",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Label counts per window, written once the watermark has passed the window's end."""
    return (
        analytics.sentiment_trend(predictions, window, delay)
        .writeStream.queryName("trend")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or trigger_opts()[1]))
        .outputMode("append")
        .format("parquet")
        .start(path)
    )


TREND = StructType().add("window_start", "long").add("window_end", "long").add("pred_label_vn", "string")
TREND = TREND.add("n", "long").add("late", "long").add("newest", "long")


def trend_table(spark: SparkSession, path: str) -> KeyedTable:
    """What each batch added to the windows; ``newest`` is the batch's last event."""
    return KeyedTable(spark, path, TREND, ["window_start", "pred_label_vn"], order=None)


def start_live_trend(
    predictions: DataFrame, table: KeyedTable, checkpoint: str, window_seconds: int = 300, delay_seconds: int = 600,
    trigger: dict | None = None, name: str = "live-trend",
) -> StreamingQuery:
    """Label counts per window while it is open: every batch adds its own counts to ``table``.

    A row whose window had ended ``delay_seconds`` before the last event of the batches before is
    ``late``: it counts, and is counted apart. A windowed aggregation of Spark would drop it without a trace,
    and would keep the open windows in its state; here there is none but the table.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        here = (checkpoint, batch_id)
        seen = table.others(here).agg(F.max("newest")).first()[0]  # one number
        start = F.floor(F.col("ts") / window_seconds) * window_seconds
        closed = F.lit(False) if seen is None else F.col("window_end") <= seen - delay_seconds
        timed = batch.select(start.alias("window_start"), (start + window_seconds).alias("window_end"), "pred_label_vn", "ts")
        counted = timed.groupBy("window_start", "window_end", "pred_label_vn").agg(
            F.count("*").alias("n"), F.count_if(closed).alias("late"), F.max("ts").alias("newest")
        )
        table.append(counted, here)

    return _start(predictions, apply, name, checkpoint, trigger or trigger_opts()[1])


def live_trend(table: KeyedTable) -> DataFrame:
    """``window_start, window_end, pred_label_vn, n, late`` of all windows begun so far."""
    groups = table.read().groupBy("window_start", "window_end", "pred_label_vn")
    return groups.agg(F.sum("n").alias("n"), F.sum("late").alias("late"))


BURST = "product_id string, review_id string, ts bigint, burst_start bigint"
BURST_STATE = "past array<bigint>, times array<bigint>, ids array<string>, owns array<bigint>"


def burst_stream(
    predictions: DataFrame, n: int = 3, within_seconds: int = 600, delay: str = "10 minutes",
    label: str = V2_RULES.negative.label,
) -> DataFrame:
    """The streaming form of ``negative_burst``, per product.

    As there, a negative goes to its own time slice of ``within_seconds`` and to the next, so that a
    group is one product in two slices, however much of the stream that product makes up. Rows wait
    in the group's state until the watermark has passed them, when none can come before them any
    more, and are then taken in time order; besides them the state is the last ``n - 1`` times. Rows
    behind the watermark are dropped.
    """

    if n < 2:
        raise ValueError("a burst has at least two reviews")

    def detect(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        time_slice, watermark = int(key[1]), state.getCurrentWatermarkMs()
        past, times, ids, owns = (list(x) for x in state.get) if state.exists else ([], [], [], [])
        if not state.hasTimedOut:
            for rows in frames:
                times += rows["ts"].tolist()
                ids += rows["review_id"].tolist()
                owns += rows["own"].tolist()
        order = sorted(range(len(times)), key=lambda i: (times[i], ids[i]))
        found = []
        while order and times[order[0]] * 1000 < watermark:
            i = order.pop(0)
            if len(past) == n - 1 and owns[i] == time_slice and times[i] - past[0] < within_seconds:
                found.append((key[0], ids[i], times[i], past[0]))
            past = [*past, times[i]][-(n - 1) :]
        if order or watermark < (time_slice + 1) * within_seconds * 1000:
            state.update((past, *([x[i] for i in order] for x in (times, ids, owns))))
            due = times[order[0]] * 1000 if order else (time_slice + 1) * within_seconds * 1000
            state.setTimeoutTimestamp(max(due, watermark + 1))
        elif state.exists:
            state.remove()
        if found:
            yield pd.DataFrame(found, columns=["product_id", "review_id", "ts", "burst_start"])

    negatives = (
        predictions.withColumn("event_time", F.timestamp_seconds("ts"))
        .withWatermark("event_time", delay)
        # Any review moves the time on, not negatives alone: the condition, always true, keeps the
        # optimizer from filtering below the watermark.
        .filter(F.when(F.rand() + 1 > 0, F.col("pred_label_vn") == label))
        .select("product_id", "review_id", "ts", "event_time")
        .withColumn("own", F.floor(F.col("ts") / within_seconds))
        .withColumn("slice", F.explode(F.array(F.col("own"), F.col("own") + 1)))
    )
    return negatives.groupBy("product_id", "slice").applyInPandasWithState(
        detect, BURST, BURST_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def start_bursts(
    predictions: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    return (
        burst_stream(predictions, **options)
        .writeStream.queryName("bursts")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or trigger_opts()[1]))
        .outputMode("append")
        .format("parquet")
        .start(path)
    )


def start_refit(
    messages: DataFrame, labelled: KeyedTable, model_dir: str, checkpoint: str, every: int = 100,
    trigger: dict | None = None, **fit_options,
) -> StreamingQuery:
    """Keep the weakly labelled reviews and refit the model on all of them every ``every`` batches.

    Logistic regression has no partial fit, so choose ``every`` by how often a new model is wanted.
    Each model is saved under its batch id; none is fitted until both classes have been seen.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        with _cached(ml.weak_label(filter_content(good(batch))).drop("label")) as rows:
            labelled.insert(rows, ["crawled_at"], (checkpoint, batch_id))
        if (batch_id + 1) % every:
            return
        seen = labelled.read()
        if ml.weak_label(seen).select("label").distinct().count() == 2:
            model = ml.train(seen, **fit_options)
            model.write().overwrite().save(f"{model_dir}/batch={batch_id:09d}")

    return _start(_decoded(messages), apply, "refit", checkpoint, trigger or trigger_opts()[1])


def run_all(
    starters: dict[str, Callable[[], StreamingQuery]],
    max_restarts: int = 3,
    poll_seconds: float = 5.0,
    deadline: float | None = None,
    within_seconds: float = 3600.0,
) -> dict[str, int]:
    """Run several jobs and start again those that die; returns the restarts of each.

    A job resumes from its checkpoint. A job that ends by itself (``availableNow``) is finished.
    Raises the job's error once it has died more than ``max_restarts`` times in ``within_seconds``;
    the others are stopped.
    """
    restarts = dict.fromkeys(starters, 0)
    died: dict[str, list[float]] = {name: [] for name in starters}
    running = {name: start() for name, start in starters.items()}
    end = None if deadline is None else time.monotonic() + deadline
    try:
        while running and (end is None or time.monotonic() < end):
            for name, query in list(running.items()):
                if query.isActive:
                    continue
                error = query.exception()
                if error is None:
                    del running[name]
                    continue
                now = time.monotonic()
                died[name] = [*(t for t in died[name] if t > now - within_seconds), now]
                if len(died[name]) > max_restarts:
                    raise error
                restarts[name] += 1
                running[name] = starters[name]()
            time.sleep(poll_seconds if running else 0)
    finally:
        for query in running.values():
            query.stop()
    return restarts


PROGRESS = (
    "run_id string, name string, batch_id bigint, timestamp string, input_rows bigint, rows_per_second double, "
    "duration_ms bigint, processed bigint, skipped bigint, errors bigint"
)


def _progress_row(p) -> tuple:
    seen = (p.observedMetrics or {}).get(OUTCOMES)
    outcomes = tuple(seen.asDict().get(c) for c in ("processed", "skipped", "errors")) if seen else (None,) * 3
    duration = (p.durationMs or {}).get("triggerExecution")
    rate = float(p.processedRowsPerSecond)
    return (str(p.runId), p.name, p.batchId, p.timestamp, p.numInputRows, rate, duration, *outcomes)


def state_seen(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row ``keys, batches``: the keyed rows in the state of a stream that is not running, and the
    input batches it has committed, read from its checkpoint by Spark's state source."""
    keys = spark.read.format("statestore").load(checkpoint).agg(F.count("*")).scalar()
    commits = spark.read.text(f"{checkpoint}/offsets").select(F.input_file_name().alias("file"), "value")
    # An offsets file is a version, the watermark, and the place in the source; a batch without new input repeats the place.
    places = commits.filter(F.col("value").startswith("{\"logOffset\"")).select("value").distinct().agg(F.count("*")).scalar()
    return spark.range(1).select(keys.alias("keys"), places.alias("batches"))


def progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The recent batches of a query (Spark keeps at most 100), with the record counters."""
    return spark.createDataFrame([_progress_row(p) for p in query.recentProgress], PROGRESS)


def record_progress(spark: SparkSession, batches: DataFrame, path: str) -> None:
    """Write batches to a metrics table; one recorded before is replaced, not added again."""
    batches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch_id").parquet(
        path
    )


def count_predictions(totals: KeyedTable) -> Callable[[], DataFrame]:
    """Counts per model, as a recorder's periodic summary; the predictions themselves are not read."""
    counted = lambda: totals.read().filter("kind = 'pred_model'")
    return lambda: counted().groupBy(F.col("name").alias("model")).agg(F.sum("n").alias("n"))


class ProgressRecorder(StreamingQueryListener):
    """Records every batch of every query of the session, and a summary, each ``every`` seconds.

    Add it with ``spark.streams.addListener``; ``close`` writes what is left. Batches are kept by run
    and batch, so however often one is reported it counts once. ``summary`` (such as
    ``count_predictions``) is written to ``path``'s neighbour ``<path>.summary`` with the time.
    """

    def __init__(
        self, spark: SparkSession, path: str, every: float = 30.0, summary: Callable[[], DataFrame] | None = None
    ):
        self.spark, self.path, self.every, self.summary = spark, path, every, summary
        self.held: dict[tuple[str, int], tuple] = {}
        self.written = time.monotonic()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.close()

    def onQueryProgress(self, event) -> None:
        row = _progress_row(event.progress)
        self.held[row[0], row[2]] = row
        if time.monotonic() - self.written >= self.every:
            self.close()

    def close(self) -> None:
        self.written, rows = time.monotonic(), [*self.held.values()]
        self.held = {}
        if rows:
            record_progress(self.spark, self.spark.createDataFrame(rows, PROGRESS), self.path)
            if self.summary is not None:
                stamped = self.summary().withColumn("at", F.current_timestamp())
                stamped.write.mode("append").parquet(f"{self.path}.summary")
