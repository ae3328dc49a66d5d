"""State over batches, stored indexes and batch-wise learning against brute force."""

import json
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from reviewlens.operators import paging as P, search
from reviewlens.operators.models import ScorerUnavailable, score_with, windows_of
from reviewlens.plans.scorer import lexicon_scorer
from reviewlens.schema import REVIEW
from reviewlens.sources import landed
from reviewlens.sources.tables import KeyedTable
from reviewlens.sources.topics import broker_messages, read_review_stream
from reviewlens.streaming import caps, jobs as J, online
from test_streaming import land, message, predictions_table

ONCE = {"availableNow": True}


# caps


def test_caps_over_batches_equal_one_sort(spark, tmp_path):
    caps.use_state_store(spark)
    rnd = random.Random(2)
    given_ = [(("hot" if rnd.random() < 0.6 else f"p{rnd.randrange(4)}"), float(rnd.randrange(40)), f"r{i:04d}") for i in range(400)]
    given_ += [given_[3], ("p0", None, "none"), (None, 1.0, "nokey")]  # a repeat, and rows that cannot be ranked
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(5):
        lines = [json.dumps({"key": k, "at": a, "id": i}) for k, a, i in given_[n::5]]
        (folder / f"{n}.json").write_text("\n".join(lines) + "\n")
    expected = sorted(
        (k, a, i) for key in {g[0] for g in given_ if g[0]}
        for k, a, i in sorted({g for g in given_ if g[0] == key and g[1] is not None}, key=lambda g: (g[1], g[2]))[:3]
    )
    table = KeyedTable(spark, str(tmp_path / "t"), caps.CHANGES, ["key", "row_id"], order=None)
    for _ in range(2):  # the second run resumes and finds nothing new
        stream = spark.readStream.schema("key string, at double, id string").option("maxFilesPerTrigger", 1).json(str(folder))
        changes = caps.cap_stream(stream, "key", F.col("at"), "id", 3, salts=2)
        run = caps.start_caps(changes, table, str(tmp_path / "c"), ONCE)
        run.awaitTermination()
    assert sorted(map(tuple, caps.capped_rows(table).collect())) == expected
    assert table.batches().filter("NOT kept").count() > 0
    assert table.batches().select("batch_id").distinct().count() >= 2


# search


NAMES = ["Điện thoại Nokia 3310", "straße STRAẞE", "İstanbul ılık", "ΟΔΟΣ οδος ς", "Kelvin K", "ſuper ſet", "ab", "", "abcabcabd", "x.y(z)[w]", "ﬁne ﬂow"]


@pytest.fixture(scope="module")
def name_index(spark, tmp_path_factory):
    rnd = random.Random(7)
    names = [*NAMES, *("".join(rnd.choice("abcd é.") for _ in range(rnd.randint(1, 14))) for _ in range(150)), None]
    products = spark.createDataFrame([(f"id{i}", n) for i, n in enumerate(names)], "product_id string, product_name string")
    path = str(tmp_path_factory.mktemp("names"))
    search.write_name_index(products, path)
    search.with_bucket(products).write.partitionBy("bucket").parquet(f"{path}/products")
    return path, spark.read.parquet(f"{path}/products").persist()


@pytest.mark.parametrize("pattern", [
    "abc", "ABC", "a+bcd?", "(ab|ba)c", "ab{2}c?", "strasse", "straße", "STRASSE", "istanbul", "ILIK", "οδοσ", "ΟΔΟΣ", "kelvin",
    "super", r"x\.y\(z", "zzz", "ab", "", "id3", "nokia|straße", "(?:abc)+d", "[ab]cd.", "a.c", "fine", "^abc", "d é", r"\bnokia\s+33",
    "(a|b|c|d)(a|b|c|d)(a|b|c|d)(a|b)", "đIỆN",
])
def test_indexed_search_equals_a_scan(spark, name_index, pattern):
    path, products = name_index
    found = rows(search.search_with_index(products, path, pattern).select("product_id"))
    exact = products.filter(F.col("product_id") == pattern)
    wanted = exact if exact.count() else products.filter(F.coalesce(F.col("product_name").rlike("(?iu)" + pattern), F.lit(False)))
    assert found == rows(wanted.select("product_id"))


def test_a_search_reads_the_candidates_alone(spark, name_index):
    path, products = name_index
    assert rows(search.candidate_products(spark, path, "nokia")) == [("id0",)]
    assert search.candidate_products(spark, path, "nokia zzz").count() == 0
    assert search.candidate_products(spark, path, "ab|nokia") is None
    plan = search.candidate_products(spark, path, "nokia")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(", "") and "PushedFilters: [In(gram" in plan


REGEX = st.recursive(
    st.text("abcé ", min_size=1, max_size=5) | st.sampled_from([".", "[ab]", r"\d", r"\w", "$", "^"]),
    lambda inner: st.one_of(
        st.tuples(inner, inner).map("".join),
        inner.map(lambda x: f"(?:{x})*"), inner.map(lambda x: f"({x})+"), inner.map(lambda x: f"(?:{x})?"),
        st.tuples(inner, inner).map(lambda t: f"({t[0]}|{t[1]})"), inner.map(lambda x: f"(?:{x}){{2,3}}"),
    ),
    max_leaves=6,
)


@settings(max_examples=400, deadline=None)
@given(REGEX, st.text("abcé 1", max_size=16))
def test_a_match_holds_the_needed_trigrams(pattern, name):
    try:
        matches = re.search(pattern, name, re.I)
    except re.error:
        return
    sets = search.needed_trigrams(pattern)
    if matches and sets:
        text = search.folded(name)
        assert any(all(g in text for g in s) for s in sets)


def test_other_dialects_are_not_taken_for_literals():
    for pattern in (r"\Qa.c\Eabc", "(?x)a b c", "[[a]xyz]", r"\p{L}abc", "(?=abc)", "abc)", r"\h+abc", "(?i)abc"):
        assert search.needed_trigrams(pattern) == []
    assert search.needed_trigrams("abcd") == [frozenset({"abc", "bcd"})]
    assert search.needed_trigrams("x(abc|bcd)y*") == [frozenset({"abc"}), frozenset({"bcd"})]


# totals, trend, order


def test_totals_equal_the_tables_after_repeats_and_a_replay(spark, tmp_path):
    src, totals = land(tmp_path / "src"), J.totals_table(spark, str(tmp_path / "totals"))
    table = predictions_table(spark, tmp_path)
    raw = KeyedTable(spark, str(tmp_path / "raw"), REVIEW, ["review_id"], order=None)
    for n in range(2):
        stream = read_review_stream(spark, "text", src, maxFilesPerTrigger=1)
        J.start_ingest(stream, raw, str(tmp_path / f"out{n}"), str(tmp_path / f"i{n}"), trigger=ONCE, totals=totals).awaitTermination()
        stream = read_review_stream(spark, "text", src, maxFilesPerTrigger=1)
        J.start_baseline(stream, table, str(tmp_path / f"b{n}"), ts=F.col("crawled_at"), trigger=ONCE, totals=totals).awaitTermination()
    kept = table.others((str(tmp_path / "b1"), 0))  # a batch that is repeated counts once
    J.save_predictions(table, kept, (str(tmp_path / "b1"), 5), totals)
    J.save_predictions(table, kept, (str(tmp_path / "b1"), 5), totals)
    from datetime import datetime

    from reviewlens.operators import analytics as A

    at = datetime(2025, 1, 1)
    assert rows(J.running_totals(totals, at)) == rows(A.snapshot(raw.read(), table.read(), at)) != []
    assert rows(J.count_predictions(totals)()) == rows(table.read().groupBy("model").count())


def test_live_trend_counts_all_and_marks_the_late(spark, tmp_path):
    times = [[0, 10, 299], [2000, 2050], [5, 1900], [5000]]
    src = land(tmp_path / "src", [[message(10 * n + i, content="rất tệ", crawled_at=float(t)) for i, t in enumerate(f)] for n, f in enumerate(times)])
    table = J.trend_table(spark, str(tmp_path / "trend"))
    stream = J.scored_stream(read_review_stream(spark, "text", src, maxFilesPerTrigger=1))
    J.start_live_trend(stream, table, str(tmp_path / "c"), trigger=ONCE).awaitTermination()
    found = {r.window_start: (r.n, r.late) for r in J.live_trend(table).collect()}
    assert found == {0: (4, 1), 1800: (3, 0), 4800: (1, 0)}


def test_offsets_decide_within_a_partition(spark):
    records = spark.createDataFrame(
        [(b"old", 500, 0, 7), (b"new", 100, 0, 8), (b"elsewhere", 450, 1, 3)], "value binary, timestamp int, partition int, offset bigint"
    )
    batch = broker_messages(records.withColumn("timestamp", F.timestamp_seconds("timestamp")))
    numbered, order = J.in_order(batch)
    assert [r.value for r in numbered.orderBy(*order).collect()] == ["elsewhere", "old", "new"]
    scored = batch.withColumn("review_id", F.lit("a"))
    assert J._last_arrivals(scored, F.lit(1)).first().value == "new"


# landed files


def test_landed_files_in_batches_of_records(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "part=1").mkdir(parents=True)
    texts = {"a.txt": [f"é{i} 🙂" for i in range(300)], "b.txt": [], "part=1/c.txt": ["x", "", "y" * 200_000, "z"], "_hidden": ["no"]}
    for name, lines in texts.items():
        end = "" if name == "part=1/c.txt" else "\n"
        (folder / name).write_text("\n".join(lines) + (end if lines else ""), encoding="utf-8")
    batches, seen = [], []

    def apply(batch, batch_id):
        got = batch.select("value", "seq.file", "seq.line").collect()
        batches.append(len(got))
        seen.extend(sorted(got, key=lambda r: (r.file, r.line)))

    def run(options=None):
        source, _ = J.trigger_opts("landed", max_records=64)
        stream = read_review_stream(spark, "landed", str(folder), **source, **(options or {}))
        query = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(apply).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    run()
    assert [b for b in batches if b] == [64, 64, 64, 64, 48]
    expected = [(v, n, i) for n in ("a.txt", "part=1/c.txt") for i, v in enumerate(texts[n])]
    assert [tuple(r) for r in seen] == expected
    (folder / "part=1" / "d.txt").write_text("later\n" * 70)
    run()  # goes on where it stopped
    assert [b for b in batches if b][5:] == [64, 6] and len(seen) == 374


def test_line_ends_are_found_across_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(landed, "CHUNK", 7)
    text = "ab\n\ncdefghijklmnop\nq\n\n\nrs"
    (tmp_path / "f").write_text(text)
    reader = landed.LandedReader({"path": str(tmp_path), "maxrecordspertrigger": "2"})
    for at in [0, *(i + 1 for i, c in enumerate(text) if c == "\n")]:
        for limit in range(1, 9):
            lines = text[at:].split("\n")
            whole = "\n".join(lines[:limit]) + ("\n" if limit < len(lines) else "")
            n = min(limit, len(lines) if lines[-1] else len(lines) - 1)
            assert reader._line_ends("f", at, limit) == (at + len(whole), n), (at, limit)


# pages


def test_pages_by_index_equal_one_sort(spark, tmp_path):
    rnd = random.Random(3)
    given_ = [(rnd.choice([None, 1.0, 2.0, 3.0, float(rnd.randrange(50))]), rnd.choice([None, "a", "b", f"n{rnd.randrange(40)}"]), i // 3) for i in range(330)]
    df = spark.createDataFrame(given_, "at double, name string, other int").repartition(7).persist()
    for order in ([("at", False), ("name", True)], [("name", True)], [("at", True), ("name", False)]):
        path = str(tmp_path / f"index-{len(order)}-{order[0][1]}-{order[0][0]}")
        P.write_page_index(df, path, order, stride=25)
        sort = [F.col(n).asc_nulls_last() if up else F.col(n).desc_nulls_last() for n, up in order]
        whole = [tuple(r) for r in df.orderBy(*sort, F.xxhash64(*df.columns)).collect()]
        for number, size in ((1, 20), (2, 25), (7, 20), (17, 20), (4, 90), (33, 10), (34, 10)):
            page = P.page_by_index(df, path, number, size, order).collect()
            key = lambda r: tuple(r[:3])
            assert [key(r) for r in page] == whole[(number - 1) * size : number * size]
            assert all((r.total_rows, r.total_pages) == (330, -(-330 // size)) for r in page)
    empty = df.filter("false")
    P.write_page_index(empty, str(tmp_path / "none"), [("at", True)])
    assert P.page_by_index(empty, str(tmp_path / "none"), 1, 10, [("at", True)]).count() == 0


# windows of texts


def test_pooled_windows_equal_brute_force(spark):
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["tốt", "tệ", "x", "y"]) for _ in range(rnd.choice([0, 1, 159, 160, 161, 1000]))) for _ in range(60)] + [None, " \n "]
    df = spark.createDataFrame([(str(i), "", t, 3) for i, t in enumerate(texts)], "review_id string, title string, content string, rating int")
    found = {r.review_id: r for r in score_with(df, lexicon_scorer(), batch=7, window=160).collect()}
    score = lexicon_scorer()()
    for i, text in enumerate(texts):
        parts = windows_of(text or "", 160)
        n = [max(len(p.split()), 1) for p in parts]
        pooled = np.average(np.array(score(parts)[1]), axis=0, weights=n)
        assert np.allclose(found[str(i)].proba, pooled) and found[str(i)].pred_label == pooled.argmax()
    assert "".join(windows_of("a b c d e", 2)) == "a bc de"


def test_a_failed_window_fails_its_text(spark):
    def factory():
        def score(texts):
            if any("down" in t for t in texts):
                raise ScorerUnavailable("down")
            return [0] * len(texts), [[0.6, 0.2, 0.2]] * len(texts)

        return score

    df = spark.createDataFrame([("a", "", "x " * 20 + "down", 3), ("b", "", "fine", 3)], "review_id string, title string, content string, rating int")
    out = {r.review_id: (r.status, r.pred_label) for r in score_with(df, factory, batch=1, window=5).collect()}
    assert out == {"a": ("unavailable", None), "b": ("ok", 0)}


# learning


def reviews(rnd, n):
    good_, bad = "great lovely fine".split(), "awful broken late".split()
    filler = [f"w{i}" for i in range(300)]
    for i in range(n):
        cue = good_ if i % 2 else bad
        yield (f"{rnd.random()}", "", " ".join(rnd.choices(filler, k=30) + rnd.choices(cue, k=3)), 5 if i % 2 else 1, float(i))


def test_online_learning_merges_frequencies_and_learns(spark):
    rnd = random.Random(6)
    schema = "review_id string, title string, content string, rating int, crawled_at double"
    data = list(reviews(rnd, 1000))
    model = online.OnlineModel.empty(512)
    for first in range(0, 800, 160):
        model = online.learn(model, spark.createDataFrame(data[first : first + 160], schema))
    cells = spark.createDataFrame(data[:800], schema).select(F.explode(F.array_distinct(online.term_cells(512))).alias("c")).groupBy("c").count()
    assert {r.c: r["count"] for r in cells.collect()} == {i: n for i, n in enumerate(model.df[:-1].tolist()) if n}
    assert model.df[-1] == 800
    out = online.predict(model, spark.createDataFrame(data[800:], schema)).collect()
    assert np.mean([r.prediction == (r.rating > 3) for r in out]) > 0.97
    assert all((r.probability > 0.5) == bool(r.prediction) for r in out)
    same = online.learn(model, spark.createDataFrame([("1", "", "x", 3, 0.0), ("2", "", "y", None, 0.0)], schema))
    assert same is model  # no label, nothing to learn
    assert online.predict(model, spark.createDataFrame([("1", "", "", 3, 0.0), ("2", None, None, 3, 0.0)], schema)).count() == 2


def test_a_step_follows_the_gradient():
    rng = np.random.default_rng(1)
    cells = pa.array([[0, 1, 1], [2], []], pa.list_(pa.int32()))
    start, cell, value = online.vectors(cells, np.array([1.0, 2.0, 3.0, 1.0]))
    assert start.tolist() == [0, 3, 5, 6] and cell.tolist() == [0, 1, 3, 2, 3, 3]
    assert np.allclose(value, [1 / 17**0.5, 4 / 17**0.5, 1, 1, 1, 1])
    weight, slope = rng.normal(size=4) * 0.1, np.zeros(4)
    before = weight.copy()
    online.descend(weight, slope, start, cell, value, np.array([1.0, 0.0, 1.0]))
    loss = lambda w: sum(np.log1p(np.exp(-s * w[cell[a:b]] @ value[a:b])) for s, a, b in zip((1, -1, 1), start[:-1], start[1:], strict=True))
    assert loss(weight) < loss(before) and (slope > 0).sum() == 4


def test_a_repeated_batch_leaves_the_same_model(spark, tmp_path):
    rnd = random.Random(8)
    lines = [message(i, content=c, rating=r) for i, (_, _, c, r, _) in enumerate(reviews(rnd, 60))]
    src = land(tmp_path / "src", [lines[:20], lines[20:40], lines[40:]])
    for name in ("a", "b"):
        stream = read_review_stream(spark, "text", src, maxFilesPerTrigger=1)
        online.start_online(stream, str(tmp_path / name), str(tmp_path / f"c{name}"), features=128, trigger=ONCE).awaitTermination()
    a, b = (online.load(spark, str(tmp_path / n / "batch=000000002")) for n in "ab")
    assert a.df[-1] == 60 and np.array_equal(a.df, b.df) and np.allclose(a.weight, b.weight)
    alone = online.load(spark, str(tmp_path / "a" / "batch=000000000"))
    assert alone.df[-1] == 20


# many parts and many batches at once


def test_landed_triggers_of_many_batches_keep_them_apart(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("".join(f"a{i}\n" for i in range(37)))
    (folder / "b.txt").write_text("".join(f"b{i}\n" for i in range(28)))
    table = KeyedTable(spark, str(tmp_path / "t"), REVIEW, ["review_id"], order=None)
    triggers = []

    def apply(batch, batch_id):
        triggers.append(batch_id)
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in REVIEW.fields if f.name != "review_id"]
        table.append(batch.select(F.col("value").alias("review_id"), "seq", *empty), ("c", F.col("seq.batch")))

    def run():
        stream = read_review_stream(spark, "landed", str(folder), maxRecordsPerTrigger=10, batchesPerTrigger=3, partitions=2)
        query = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(apply).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    def stored():
        found = {}
        for name, n in table.batches().select("review_id", "batch_id").collect():
            found.setdefault(n, set()).add(name)
        return found

    run()
    names = [f"a{i}" for i in range(37)] + [f"b{i}" for i in range(28)]
    expected = {n: set(names[10 * n : 10 * n + 10]) for n in range(7)}
    assert stored() == expected and len(set(triggers)) <= 4
    (folder / "c.txt").write_text("".join(f"c{i}\n" for i in range(12)))
    run()  # goes on with a new batch
    assert stored() == expected | {7: {f"c{i}" for i in range(10)}, 8: {"c10", "c11"}}


def test_parts_land_in_equally_many_files(spark, tmp_path, monkeypatch):
    from reviewlens.plans import ingest

    monkeypatch.setattr(ingest, "FILE_ROWS", 100)
    rows = spark.range(3000).select(F.col("id").cast("string").alias("review_id"), "id")
    part = F.when(F.col("id") < 2600, F.lit(0)).otherwise(F.lit(1))
    landing = ingest.write_message_files(rows, str(tmp_path / "staged"), part)
    assert 1 < landing.files <= 6  # the small part of 400 rows still has 64 or more for each file
    for n, size in ((1, 400), (0, 2600)):
        ingest.land_part(spark, landing, n, str(tmp_path / "in"))
    names = list((tmp_path / "in").glob("*/*.txt"))
    assert len(names) == 2 * landing.files
    batches = []
    stream = read_review_stream(spark, "text", str(tmp_path / "in"), **landing.limit())
    run = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    run.foreachBatch(lambda batch, _: batches.append(batch.count())).start().awaitTermination()
    assert batches == [400, 2600]


def test_caps_keep_one_state_row_list_per_key(spark, tmp_path):
    caps.use_state_store(spark)
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(3):
        rows = [{"key": f"k{i % 2}", "at": float((i * 7919) % 1000), "id": f"r{i:04d}"} for i in range(n, 900, 3)]
        (folder / f"{n}.json").write_text("\n".join(json.dumps(r) for r in rows * 2) + "\n")
    stream = spark.readStream.schema("key string, at double, id string").option("maxFilesPerTrigger", 1).json(str(folder))
    table = KeyedTable(spark, str(tmp_path / "t"), caps.CHANGES, ["key", "row_id"], order=None)
    run = caps.start_caps(caps.cap_stream(stream, "key", F.col("at"), "id", 5), table, str(tmp_path / "c"), ONCE)
    run.awaitTermination()
    every = [(f"k{i % 2}", float((i * 7919) % 1000), f"r{i:04d}") for i in range(900)]
    expected = sorted(r for k in ("k0", "k1") for r in sorted((r for r in every if r[0] == k), key=lambda r: r[1:])[:5])
    assert sorted(map(tuple, caps.capped_rows(table).collect())) == expected
    operators = run.recentProgress[-1].stateOperators
    assert len(operators) == 1 and operators[0].numRowsTotal <= 2 * 5 * 2  # no state per key and salt


def test_scorers_take_published_files_in_a_bounded_number_of_batches(spark, tmp_path):
    from reviewlens.plans.live import _files_at_once

    for n, files in ((0, 24), (1, 9)):
        spark.range(files).select(F.col("id").cast("string"), F.lit("reviews").alias("topic")).repartition(
            files, "id"
        ).write.partitionBy("topic").text(str(tmp_path / f"batch={n:09d}"))
    files = len(list(tmp_path.glob("*/topic=reviews/*.txt")))
    assert _files_at_once(spark, str(tmp_path), "reviews") == max(2, -(-files // 4)) > 2
    assert _files_at_once(spark, str(tmp_path), "other") == 2


def test_cued_reviews_are_those_of_the_stored_ones(spark, sf_dir):
    from reviewlens.plans.data import cued, cued_reviews, raw

    got = sorted(map(repr, cued_reviews(spark, sf_dir).collect()))
    assert got == sorted(map(repr, cued(raw(spark, sf_dir)).collect())) and got
