"""Streams equal their batch form, also after restarts, replays and failures."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from reviewlens.operators import analytics as A
from reviewlens.operators.documents import to_prediction
from reviewlens.operators.filters import filter_content
from reviewlens.operators.models import ScorerUnavailable, attach_by_key, resolve_failures, score_with
from reviewlens.plans.scorer import lexicon_scorer
from reviewlens.operators.scoring import score_rules
from reviewlens.schema import LABELS_NEUTRAL_MIDDLE, PREDICTION, REVIEW
from reviewlens.sources.decode import decode_reviews, good
from reviewlens.sources.tables import KeyedTable
from reviewlens.sources.topics import read_review_stream
from reviewlens.streaming import jobs as J

ONCE = {"availableNow": True}


def crawled():
    return F.col("crawled_at")


def message(i, **changed):
    record = {
        "review_id": str(i), "product_id": str(i % 3), "platform": "tiki", "rating": 3, "title": "t",
        "content": ["hàng tốt lắm", "rất tệ", "bình thường"][i % 3], "crawled_at": 1000.0 + i, **changed,
    }
    return json.dumps({k: v for k, v in record.items() if v != "missing"}, ensure_ascii=False)


FILES = [
    [message(i) for i in range(6)],
    [message(6, rating="missing"), message(7, rating=None), "not json", '{"content": 5}', message(8, content="ok")],
    [message(i, rating=5, crawled_at=2000.0 + i) for i in range(3)] + [message(9)],
]


def land(folder, files=FILES):
    folder.mkdir(parents=True, exist_ok=True)
    for n, lines in enumerate(files):
        path = folder / f"part-{n}.txt"
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        os.utime(path, (1_700_000_000 + n * 10,) * 2)
    return str(folder)


def predictions_table(spark, tmp_path, name="pred", **options):
    return KeyedTable(spark, str(tmp_path / name), PREDICTION, ["review_id", "model"], **options)


def run_baseline(spark, src, table, checkpoint, **options):
    stream = read_review_stream(spark, "text", src, maxFilesPerTrigger=1)
    query = J.start_baseline(stream, table, checkpoint, ts=crawled(), trigger=ONCE, **options)
    query.awaitTermination()
    return query


def batch_form(spark, src):
    scored = score_rules(filter_content(good(decode_reviews(spark.read.text(src)))))
    stamped = to_prediction(scored, "baseline", crawled())
    return stamped.groupBy("review_id").agg(F.max_by("pred_label", "ts"), F.max("ts"))


def state(table):
    return rows(table.read().select("review_id", "pred_label", "ts"))


def test_baseline_equals_batch_after_restart_and_replay(spark, tmp_path):
    src, table = land(tmp_path / "src", FILES[:2]), predictions_table(spark, tmp_path)
    errors, first = str(tmp_path / "errors"), str(tmp_path / "c1")
    run_baseline(spark, src, table, first, errors=errors)
    assert state(table) == rows(batch_form(spark, src))
    land(tmp_path / "src")
    query = run_baseline(spark, src, table, first, errors=errors)
    expected = rows(batch_form(spark, src))
    assert state(table) == expected and query.recentProgress[0].numInputRows == len(FILES[2])
    run_baseline(spark, src, table, str(tmp_path / "c2"))
    assert state(table) == expected
    assert rows(spark.read.parquet(errors).groupBy("reject_reason").count()) == [
        ("bad_content", 1), ("malformed", 1), ("null_rating", 1)]
    seen = J.progress(spark, query).agg(F.sum("processed"), F.sum("skipped"), F.sum("errors")).first()
    assert tuple(seen) == (4, 0, 0)
    raw = {r.reject_reason: r.raw_value for r in spark.read.parquet(errors).collect()}
    assert raw["malformed"] == "not json" and raw["bad_content"] == '{"content": 5}'


def test_last_arrival_wins_in_one_batch(spark, tmp_path):
    for name, ratings in (("up", (1, 5)), ("down", (5, 1))):
        src = land(tmp_path / name, [[message(1, rating=r, content="xxxx") for r in ratings]])
        table = predictions_table(spark, tmp_path, f"t-{name}")
        J.start_baseline(read_review_stream(spark, "text", src), table, str(tmp_path / f"c-{name}"), trigger=ONCE).awaitTermination()
        assert table.read().first().rating == ratings[-1]


def test_recorder_counts_each_batch_once(spark, tmp_path):
    table, path = predictions_table(spark, tmp_path), str(tmp_path / "metrics")
    totals = J.totals_table(spark, str(tmp_path / "totals"))
    recorder = J.ProgressRecorder(spark, path, every=0.0, summary=J.count_predictions(totals))
    spark.streams.addListener(recorder)
    try:
        query = run_baseline(spark, land(tmp_path / "src"), table, str(tmp_path / "c"), totals=totals)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
        for _ in range(2):
            J.record_progress(spark, J.progress(spark, query), path)
    finally:
        spark.streams.removeListener(recorder)
    assert spark.read.parquet(path).agg(F.sum("input_rows")).first()[0] == sum(map(len, FILES))
    assert spark.read.parquet(f"{path}.summary").filter("n > 0").count() > 0


def test_repeated_batch_is_applied_once(spark, tmp_path):
    table = predictions_table(spark, tmp_path)
    df = to_prediction(score_rules(good(decode_reviews(spark.createDataFrame([(m,) for m in FILES[0]], "value string")))), "m", crawled())
    table.upsert(df, ("s", 0))
    table.upsert(df, ("s", 0))
    assert table.batches().count() == 6
    table.upsert(df, ("s", 1))
    assert table.batches().count() == 12 and table.read().count() == 6
    assert table.new_keys(df, ("s", 0)).count() == 6 and table.new_keys(df, ("s", 1)).count() == 0


def test_model_failures(spark, tmp_path):
    def flaky():
        inner = lexicon_scorer()()

        def score(texts):
            if any("5" in t for t in texts):
                raise ScorerUnavailable("down")
            if any("4" in t for t in texts):
                return [1], []
            return inner(texts)

        return score

    lines = [message(i, title=str(i), rating=1, content="hàng tốt lắm") for i in range(6)]
    src, table, errors = land(tmp_path / "src", [lines]), predictions_table(spark, tmp_path), str(tmp_path / "e")
    stream = read_review_stream(spark, "text", src)
    J.start_model(
        stream, table, str(tmp_path / "c"), flaky, ts=crawled(), trigger=ONCE, errors=errors, batch_size=1
    ).awaitTermination()
    saved = {r.review_id: r.pred_label for r in table.read().collect()}
    assert saved == {"0": 1, "1": 1, "2": 1, "3": 1, "4": 0}  # 4: rating rule; 5: not saved
    assert [tuple(r) for r in spark.read.parquet(errors).select("review_id", "reject_reason").collect()] == [("5", "unavailable")]


def test_model_sees_whole_texts(spark):
    long_text = "x " * 500 + "tốt"
    df = spark.createDataFrame([("a", "", long_text, 3)], "review_id string, title string, content string, rating int")
    whole = score_with(df, lexicon_scorer()).first()
    assert whole.pred_label == 1
    assert score_with(df, lexicon_scorer(), labels=LABELS_NEUTRAL_MIDDLE).first().pred_label_vn == "Trung bình"
    scored = score_with(df, lexicon_scorer())
    assert set(resolve_failures(scored).columns) == set(scored.columns)


def test_attach_fails_on_a_missing_prediction(spark):
    df = spark.createDataFrame([("a",), ("b",)], "review_id string")
    scored = spark.createDataFrame([("a", 1), ("b", 2)], "review_id string, pred_label int")
    assert rows(attach_by_key(df, scored)) == [("a", 1), ("b", 2)]
    with pytest.raises(Exception, match="no prediction for b"):
        attach_by_key(df, scored.filter("review_id = 'a'")).collect()
    with pytest.raises(Exception, match="no review for b"):
        attach_by_key(df.filter("review_id = 'a'"), scored).collect()
    with pytest.raises(Exception, match="more than one row for"):
        attach_by_key(df, scored.union(scored)).collect()


def test_ingest_publishes_each_review_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "raw"), REVIEW, ["review_id"], order=None)
    src, out = land(tmp_path / "src"), str(tmp_path / "out")
    for checkpoint in ("c1", "c1", "c2"):
        stream = read_review_stream(spark, "text", src, maxFilesPerTrigger=1)
        J.start_ingest(stream, table, f"{out}-{checkpoint}", str(tmp_path / checkpoint), trigger=ONCE).awaitTermination()
    stored = table.read()
    assert sorted(int(r.review_id) for r in stored.collect()) == [0, 1, 2, 3, 4, 5, 6, 8, 9]
    assert stored.filter("review_id = '0'").first().rating == 3
    published = decode_reviews(spark.read.text(f"{out}-c1"))
    # Review 6 lacks a rating, which is stored as NULL and published as null.
    assert sorted(int(r.review_id) for r in published.collect()) == [0, 1, 2, 3, 4, 5, 6, 8, 9]
    batch = spark.createDataFrame([("n", 1.0)], "review_id string, crawled_at double")
    full = stored.limit(0).unionByName(batch, allowMissingColumns=True)
    added = rows(table.insert(full, ["crawled_at"], ("s", 0)))
    again = rows(table.insert(full, ["crawled_at"], ("s", 0)))  # replaces the files of the first attempt
    assert added == again and len(added) == 1


def test_table_append_clear_and_conflict(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), REVIEW, ["review_id"], order=None)
    assert table.read().count() == 0 and table.clear() == 0
    df = table.read().limit(0).unionByName(spark.range(5).select(F.col("id").cast("string").alias("review_id")), allowMissingColumns=True)
    table.append(df)
    table.append(df)
    assert table.read().count() == 10
    with pytest.raises(ValueError):
        table.upsert(df)
    assert table.clear() == 10 and table.read().count() == 0
    assert [f for f in (tmp_path / "t").rglob("*.parquet")] == []
    table.append(df)
    assert table.read().count() == 5


def test_many_small_writes_keep_the_last_one(spark, tmp_path):
    table = predictions_table(spark, tmp_path)
    empty = table.read().limit(0)
    for n in range(7):
        change = spark.range(3).select(
            F.col("id").cast("string").alias("review_id"), F.lit("m").alias("model"),
            F.lit(n).alias("pred_label"), F.lit(1 if n % 2 else 2).cast("bigint").alias("ts"),
        )
        table.upsert(empty.unionByName(change, allowMissingColumns=True))
    # ts decides first, then the later write: batches 0, 2, 4, 6 have ts 2.
    assert state(table) == [("0", 6, 2), ("1", 6, 2), ("2", 6, 2)]
    one = table.rewritten(str(tmp_path / "one"))
    assert state(one) == state(table) and one.batches().count() == 3


def test_a_write_writes_its_own_rows_alone(spark, tmp_path):
    table = predictions_table(spark, tmp_path)
    empty, names = table.read().limit(0), [F.lit("m").alias("model"), F.lit(1).cast("bigint").alias("ts")]
    rows_of = lambda first, n: spark.range(first, first + n).select(F.col("id").cast("string").alias("review_id"), *names)
    table.upsert(empty.unionByName(rows_of(0, 20_000), allowMissingColumns=True), ("a", 0))
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "pred").rglob("*.parquet")}
    table.upsert(empty.unionByName(rows_of(19_990, 128), allowMissingColumns=True), ("a", 1))
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "pred").rglob("*.parquet")}
    assert {f: after[f] for f in files} == files
    new = [str(f) for f in after if f not in files]
    assert spark.read.parquet(*new).count() == 128 and table.read().count() == 20_118


def test_run_all_restarts_a_job_that_dies(spark, tmp_path):
    src, table = land(tmp_path / "src"), predictions_table(spark, tmp_path)
    starts = []

    def dies_once():
        starts.append(1)
        broken = F.raise_error(F.lit("crash")) if len(starts) == 1 else crawled()
        return J.start_baseline(
            read_review_stream(spark, "text", src), table, str(tmp_path / "c"), ts=broken, trigger=ONCE)

    assert J.run_all({"job": dies_once}, poll_seconds=0.1) == {"job": 1}
    assert state(table) == rows(batch_form(spark, src))

    def always_dies():
        return J.start_baseline(
            read_review_stream(spark, "text", src), table, str(tmp_path / "c3"), ts=F.raise_error(F.lit("x")), trigger=ONCE)

    with pytest.raises(Exception):
        J.run_all({"job": always_dies}, max_restarts=1, poll_seconds=0.1)


def test_trigger_options():
    assert J.trigger_opts() == ({"maxOffsetsPerTrigger": 128}, {"processingTime": "1500 milliseconds"})
    assert J.trigger_opts("text", available_now=True) == ({"maxFilesPerTrigger": 1}, {"availableNow": True})


def events(spark, tmp_path):
    """Negatives of one busy and one quiet product, in time order over several files."""
    times = [0, 100, 650, 699, 1250, 1299, 1300, 4000, 4599, 4600, 9000, 9001, 9002]
    lines = [message(i, product_id="a", content="rất tệ", crawled_at=float(t)) for i, t in enumerate(times)]
    lines += [message(100 + i, product_id="b", content="rất tệ", crawled_at=float(i * 700)) for i in range(13)]
    lines.sort(key=lambda m: json.loads(m)["crawled_at"])
    return land(tmp_path / "src", [lines[i : i + 5] for i in range(0, len(lines), 5)])


def test_burst_stream_equals_batch_whatever_the_order_within_the_delay(spark, tmp_path):
    import random

    src = events(spark, tmp_path)
    lines = [x for f in sorted(os.listdir(src)) for x in open(os.path.join(src, f), encoding="utf-8").read().split("\n") if x]
    mixed = random.Random(4)
    lines.append(message(900, content="hàng tốt", crawled_at=20_000.0))  # lets the watermark pass the rest
    lines.sort(key=lambda m: json.loads(m)["crawled_at"] + mixed.uniform(0, 500))
    src = land(tmp_path / "mixed", [lines[i : i + 5] for i in range(0, len(lines), 5)])
    batch = rows(A.negative_burst(J.scored_stream(spark.read.text(src))))
    assert [r[2:] for r in batch] == [(9002, 9000), (699, 100), (1300, 1250)]
    out = str(tmp_path / "out")
    stream = J.scored_stream(read_review_stream(spark, "text", src, maxFilesPerTrigger=1))
    J.start_bursts(stream, out, str(tmp_path / "c"), trigger=ONCE).awaitTermination()
    assert rows(spark.read.parquet(out)) == batch


def test_trend_stream_equals_batch_up_to_the_watermark(spark, tmp_path):
    src = events(spark, tmp_path)
    last = 9002
    batch = A.sentiment_trend(J.scored_stream(spark.read.text(src))).filter(F.col("window_end") <= last - 600)
    out = str(tmp_path / "out")
    stream = J.scored_stream(read_review_stream(spark, "text", src, maxFilesPerTrigger=1))
    J.start_trend(stream, out, str(tmp_path / "c"), trigger=ONCE).awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(batch) != []


def test_stream_dedup_drops_repeats_within_the_delay(spark, tmp_path):
    lines = [message(1, crawled_at=100.0), message(1, crawled_at=110.0), message(2, crawled_at=120.0)]
    src, out = land(tmp_path / "src", [lines]), str(tmp_path / "out")
    decoded = good(decode_reviews(read_review_stream(spark, "text", src)))
    timed = decoded.withColumn("event_time", F.timestamp_seconds("crawled_at"))
    J.dedup_stream(timed, "review_id", "10 minutes").select("review_id").writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start(out).awaitTermination()
    assert rows(spark.read.parquet(out)) == [("1",), ("2",)]


def test_refit_saves_a_model_per_batch(spark, tmp_path):
    from pyspark.ml import PipelineModel

    lines = [message(i, rating=5 if i % 2 else 1, content="tốt lắm" if i % 2 else "rất tệ") for i in range(12)]
    src = land(tmp_path / "src", [[message(50, rating=3)], lines[:6], lines[6:]])
    table = KeyedTable(spark, str(tmp_path / "t"), REVIEW, ["review_id"], order=None)
    stream = read_review_stream(spark, "text", src, maxFilesPerTrigger=1)
    J.start_refit(stream, table, str(tmp_path / "m"), str(tmp_path / "c"), every=1, trigger=ONCE, max_iter=5).awaitTermination()
    assert sorted(os.listdir(tmp_path / "m")) == ["batch=000000001", "batch=000000002"]
    model = PipelineModel.load(str(tmp_path / "m" / "batch=000000002"))
    from reviewlens.operators import ml

    scored = ml.predict(model, table.read())
    assert scored.filter((F.col("prediction") == 1) == (F.col("rating") == 5)).count() == 12
