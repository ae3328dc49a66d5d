"""Hot keys, deep pages and plan shapes."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from reviewlens.operators import analytics as A, paging as P
from reviewlens.operators.filters import recent, search_products
from reviewlens.operators.keyed import cap_per_group, first_by
from reviewlens.operators.models import resolve_failures, score_with
from reviewlens.plans.scorer import lexicon_scorer
from reviewlens.operators.scoring import score_rules
from reviewlens.plans.catalog import all_queries
from reviewlens.plans.data import arrivals
from reviewlens.session import scratch_path, shared_dir
from reviewlens.sources.decode import decode_reviews, encode, good


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_bursts_equal_brute_force_with_a_hot_product(spark):
    rnd = random.Random(7)
    data = [("hot" if rnd.random() < 0.5 else f"p{rnd.randrange(5)}", str(i), rnd.randrange(20_000), "Không tốt") for i in range(1500)]
    df = spark.createDataFrame(data, "product_id string, review_id string, ts bigint, pred_label_vn string")
    for n, within in ((3, 600), (2, 30), (5, 600)):
        expected = []
        for product in {d[0] for d in data}:
            times = sorted((d[2], d[1]) for d in data if d[0] == product)
            expected += [(product, r, t, times[i - n + 1][0]) for i, (t, r) in enumerate(times) if i >= n - 1 and t - times[i - n + 1][0] < within]
        assert rows(A.negative_burst(df, n=n, within_seconds=within)) == sorted(expected, key=repr)


def test_salted_cap_equals_plain_cap(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("g"))
    order = [F.desc("id")]
    assert rows(cap_per_group(df, "g", order, 7, spread=["id"])) == rows(cap_per_group(df, "g", order, 7))


def test_group_limit_runs_before_the_shuffle(spark, sf_dir):
    text = plan(first_by(arrivals(spark, sf_dir), ["review_id"], ["crawled_at"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_pages_concatenate_to_the_sorted_whole(spark):
    df = spark.range(95).select((F.col("id") % 9).cast("double").alias("crawled_at"), F.col("id").cast("string").alias("review_id"))
    order, key = [F.desc("crawled_at"), F.asc("review_id")], ["crawled_at", "review_id"]
    whole = [r.review_id for r in df.orderBy(*order).collect()]
    for deep in (False, True):
        pages = [P.page(df, n, 10, order, key, deep=deep).orderBy(*order).collect() for n in range(1, 12)]
        assert [r.review_id for p in pages for r in p] == whole
        assert {(r.total_rows, r.total_pages) for p in pages for r in p} == {(95, 10)}
    ties = spark.createDataFrame([(1.0, "x", 1), (1.0, "x", 2), (0.5, "y", 3), (None, "n", 4)], "crawled_at double, review_id string, v int")
    order = [F.desc("crawled_at"), F.asc("review_id")]
    for size in (1, 2, 3):
        both = [[P.page(ties, n, size, order, key, deep=deep).collect() for n in range(1, 6)] for deep in (False, True)]
        assert both[0] == both[1] and sorted(r.v for p in both[1] for r in p) == [1, 2, 3, 4]
    empty = P.number_rows(df.filter("false"), order)
    assert empty.count() == 0


def test_batches_cover_all_rows_within_size(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("review_id"))
    batched = P.assign_batches(df, size=30, buckets=4)
    sizes = [r["count"] for r in batched.groupBy("bucket", "batch_no").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 30
    ordered = P.assign_batches(df, size=30)
    sizes = [r["count"] for r in ordered.groupBy("batch_no").count().orderBy("batch_no").collect()]
    assert sizes == [30] * 33 + [10]
    assert tuple(P.batch_count(ordered).first()) == (34, 1000)
    assert rows(P.sample_k(df, 10, 1)) == rows(P.sample_k(df.repartition(7), 10, 1))
    assert P.sample_k(df, 10, 1, repeatable=False).count() == 10


def test_simple_filters_reach_the_scan(spark, tmp_path, sf_dir):
    path = str(tmp_path / "r")
    arrivals(spark, sf_dir).write.parquet(path)
    stored = spark.read.parquet(path)
    assert "GreaterThanOrEqual(crawled_at" in plan(recent(stored, datetime(2025, 11, 7)).select("review_id"))
    found = plan(search_products(stored, "7").select("review_id"))
    assert "EqualTo(product_id,7)" in found and "CartesianProduct" not in found and "NestedLoop" not in found


def test_costly_steps_run_once_below_filters(spark, sf_dir):
    df = arrivals(spark, sf_dir)
    scored = plan(score_rules(df).filter("pred_label = 0").select("review_id"))
    assert scored.count("lower(") == 1
    messages = df.select(encode(df).alias("value"))
    assert plan(good(decode_reviews(messages)).filter("rating > 2").select("review_id")).count("parseJson") == 1
    model = plan(resolve_failures(score_with(df, lexicon_scorer())).filter("pred_label = 0"))
    assert model.count("ArrowEvalPython") == 1


def test_label_queries_shuffle_no_text(spark, sf_dir):
    text = plan(all_queries()["worst_products"](spark, sf_dir))
    window = text[: text.index("Project [review_id")]
    assert "content#" not in window


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(named + "/reviewlens/x-")

    class Context:
        master, applicationId = "local[2]", "app"

    class Unset:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})
        sparkContext = Context

    assert shared_dir(Unset) == shared_dir(Unset)
    Context.master = "spark://host"
    with pytest.raises(RuntimeError):
        shared_dir(Unset)


def test_no_query_plans_a_cross_join(spark, sf_dir):
    for name in ("table_counts", "status_snapshot", "apply_rules", "page_reviews", "matched_products", "product_search"):
        text = plan(all_queries()[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_model_predicts_every_stored_review(spark, sf_dir):
    from reviewlens.plans.data import raw

    got = all_queries()["predict_tfidf_lr"](spark, sf_dir)
    assert got.count() == raw(spark, sf_dir).count()
    assert got.filter("NOT sums_to_one OR NOT is_argmax OR pred_label NOT IN (0, 1)").count() == 0
