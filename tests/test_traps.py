"""The behaviours that are easy to get wrong, on literal rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from reviewlens import functions as R
from reviewlens.operators import analytics as A
from reviewlens.operators.documents import canonicalize, to_prediction, to_prediction_v1
from reviewlens.operators.filters import brand_match, filter_content, filter_recent, filter_text, recent, search_products
from reviewlens.operators.keyed import insert_new, key_violations, upsert_latest
from reviewlens.operators.normalize import resolve_category
from reviewlens.operators.routing import apply_rules, route, upsert_rules
from reviewlens.operators.scoring import lexicon_counts, score_neutral, score_rating, score_rules
from reviewlens.operators.views import latest_predictions
from reviewlens.schema import CONTROL_RULE, LABEL_TRANSLATIONS, LABELS, PREDICTION, REVIEW, V1_RULES
from reviewlens.sources.decode import bad, decode_reviews, encode, good
from reviewlens.sources.pages import product_links


def reviews(spark, *records):
    names = REVIEW.names
    full = [tuple({"review_id": str(i), **r}.get(n) for n in names) for i, r in enumerate(records)]
    return spark.createDataFrame(full, REVIEW)


def labels(df):
    return [r.pred_label for r in df.orderBy("review_id").collect()]


def test_lexicon_counts_substrings_once_in_lower_case(spark):
    df = reviews(spark, {"content": "notebook OK ok good"}, {"content": "KHÔNG TỐT"}, {"content": None, "title": "good"})
    got = lexicon_counts(df).orderBy("review_id").select("pos_count", "neg_count").collect()
    assert [tuple(r) for r in got] == [(2, 0), (1, 1), (0, 0)]


def test_negated_word_is_a_tie_in_v2_and_positive_in_v1(spark):
    df = reviews(spark, {"content": "không tốt", "rating": 3})
    assert labels(score_rules(df)) == [2]
    assert labels(score_rules(df, V1_RULES)) == [2]  # 2 is positive in v1
    assert score_rules(df, V1_RULES).first().pred_label_vn == "positive"


def test_rule_order(spark):
    df = reviews(
        spark,
        {"content": "good", "rating": 1}, {"content": "bad", "rating": 5}, {"content": "bad", "rating": 3},
        {"content": "plain", "rating": 2}, {"content": "plain", "rating": 3}, {"content": "plain", "rating": None},
    )
    assert labels(score_rules(df)) == [1, 1, 0, 0, 2, 2]
    assert labels(score_rating(df)) == [0, 1, 2, 0, 2, 2]
    first = score_rules(df).orderBy("review_id").first()
    assert (first.pred_label_vn, list(first.proba), first.confidence) == ("Tốt", [0.1, 0.8, 0.1], 0.8)
    neutral = score_neutral(df).first()
    assert (neutral.pred_label, list(neutral.proba), neutral.confidence) == (1, [0.33, 0.34, 0.33], 0.33)


MESSAGES = [
    ("not json", "malformed"), ("[1,2]", "not_object"), ("{}", None), ('{"content":null}', "bad_content"),
    ('{"content":12345}', "bad_content"), ('{"content":["a"]}', "bad_content"),
    ('{"content":"abcd","rating":null}', "null_rating"), ('{"content":"abcd","rating":"5"}', "bad_rating"),
    ('{"content":"abcd","rating":4.5}', None), ('{"content":"abcd"}', None),
    ('{"content":"abcd"} trailing', "malformed"), ('{"content":"a"},{"content":"b"}', "malformed"), ("null", "not_object"),
    ("", "malformed"), ('{"content":"a"} {"content":"b"}', "malformed"),
]


def test_decode_tells_missing_from_null_and_wrong_type(spark):
    df = spark.createDataFrame([(m,) for m, _ in MESSAGES], "value string")
    decoded = decode_reviews(df.withColumn("m", F.col("value")))
    got = {r.m: r.reject_reason for r in decoded.collect()}
    for message, reason in MESSAGES:
        assert got[message] == reason, message
    kept = good(decoded).select("content", "rating")
    assert rows(kept) == [("", None), ("abcd", 4), ("abcd", None)]
    assert bad(df).count() == len(MESSAGES) - 3
    assert filter_content(kept).count() == 2
    counted = A.outcome_counts(decoded).first()
    assert (counted.processed, counted.skipped, counted.errors) == (2, 1, len(MESSAGES) - 3)


def test_encode_keeps_nulls_and_text(spark):
    df = reviews(spark, {"content": "Sản phẩm\n\"tốt\"", "rating": None})
    value = df.select(encode(df).alias("value"))
    assert '"rating":null' in value.first().value and "Sản" in value.first().value
    assert decode_reviews(value).first().reject_reason == "null_rating"


def test_length_filters_differ(spark):
    df = reviews(
        spark, {"content": "abc", "title": "t"}, {"content": "abcd", "title": ""}, {"content": None, "title": None},
        {"content": " \n", "title": "\t ab"}, {"content": "tốt!", "title": None},
    )
    assert [r.review_id for r in filter_content(df).collect()] == ["1", "4"]
    assert [r.review_id for r in filter_text(df).collect()] == ["0", "1", "4"]
    assert df.select(R.compose_text(F.col("title"), F.col("content")).alias("t")).collect()[4].t == " tốt!"


DATES = ["", "1753674740", "2020-01-01T00:00:00Z", "2020-01-01T00:00:00+07:00", "2020-01-01T00:00:00", "2020-01-01",
         "20200101", "2020-01-01 05:06", "2020-13-45", "2025-11-05T07:58:35", "soon"]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh"])
def test_recency_modes(spark, zone):
    df = reviews(spark, *[{"create_time": d} for d in DATES])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        as_of = datetime(2025, 11, 30)
        lenient = {r.create_time for r in filter_recent(df, 365, as_of).collect()}
        strict = {r.create_time for r in filter_recent(df, 30, as_of, "strict").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert set(DATES) - lenient == {"2020-01-01T00:00:00", "2020-01-01", "20200101", "2020-01-01 05:06"}
    assert strict == {"", "2020-13-45", "2025-11-05T07:58:35", "soon"}


def test_recent_activity_compares_epochs(spark):
    df = reviews(spark, {"crawled_at": 1_762_500_299.0}, {"crawled_at": 1_762_500_300.0})
    assert [r.review_id for r in recent(df, datetime(2025, 11, 7, 7, 30)).collect()] == ["1"]


CATEGORIES = [
    ('{"id":7,"name":"A"}', "7", "A"), ('[{"id":8,"name":"B"},{"id":9}]', "8", "B"), ("[]", "unknown", "Unknown"),
    ("{}", "unknown", "Unknown"), ('{"name":"no id"}', "unknown", "Unknown"), ('["x"]', "unknown", "Unknown"),
    ('[{"name":"q"}]', "unknown", "q"), ('{"id":"s"}', "s", "Unknown"), (None, "unknown", "Unknown"),
    ("[null]", "unknown", "Unknown"),
]


def test_category_precedence(spark):
    df = spark.createDataFrame([(c,) for c, _, _ in CATEGORIES], "c string").withColumn("v", F.try_parse_json("c"))
    got = df.select("c", resolve_category("v", F.lit("brand"), F.lit("nan")).alias("r")).collect()
    assert [(r.c, r.r.category_id, r.r.category_name) for r in got] == CATEGORIES
    empty = df.filter("c is null")
    given = empty.select(resolve_category("v", F.lit("category"), F.lit("1815"), F.lit("Cameras")).alias("r")).first().r
    alone = empty.select(resolve_category("v", F.lit("category"), F.lit("1815")).alias("r")).first().r
    assert (given.category_id, given.category_name) == ("1815", "Cameras")
    assert (alone.category_id, alone.category_name) == ("1815", "Unknown")


URLS = {
    "https://tiki.vn/thuong-hieu/nan.html": ("brand", "nan"),
    "https://tiki.vn/cua-hang/mrm-manlywear-official": ("store", "mrm-manlywear-official"),
    "https://tiki.vn/thiet-bi-kts-phu-kien-so/c1815": ("category", "1815"),
    "https://tiki.vn/camera": ("category", None),
    "https://tiki.vn/x": (None, None),
}


def test_source_urls(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string").withColumn("r", R.classify_url(F.col("u")))
    assert {r.u: (r.r.source_type, r.r.source_id) for r in df.collect()} == URLS


def test_brand_match(spark):
    df = spark.createDataFrame([("Nan Pro", "nan-x", "milk"), ("Sony", "SONY", "x"), ("Acme", "a", "Huggies 3")], "b string, s string, n string")

    def hits(brand):
        return [r[0] for r in df.select(brand_match(brand, F.col("b"), F.col("s"), F.col("n"))).collect()]

    assert hits("NAN") == [True, False, False]
    assert hits("sony") == [False, True, False]
    assert hits("huggies") == [False, False, True]


def test_prediction_records(spark):
    df = reviews(spark, {"content": "good", "title": None, "platform": None, "rating": 5})
    v2 = to_prediction(score_rules(df), "baseline", F.lit(7))
    assert v2.schema.names == PREDICTION.names
    row = v2.first()
    assert (row.platform, row.reviewer_name, row.title, row.text, row.pred_proba_vec, row.ts) == (
        "tiki", "Anonymous", "", " good", "[0.1, 0.8, 0.1]", 7)
    v1 = to_prediction_v1(score_rules(df, V1_RULES), "baseline", F.lit("2025-11-07T09:33:20"))
    row = v1.first()
    assert (row.platform, row.category_name, row.content_length, row.pred_proba_positive) == ("unknown", "Unknown", 4, 0.6)
    both = {r.ts: r for r in canonicalize(v1, v2).collect()}
    assert both[7].pred_label_vn == "Tốt" and both[7].pred_label == 1
    old = both[1_762_508_000]
    assert (old.pred_label, old.pred_label_vn, old.pred_proba_vec) == (1, "Tích cực", "[0.1, 0.6, 0.3]")


def test_scalar_functions(spark):
    one = spark.range(1)

    def value(column):
        return one.select(column.alias("x")).first().x

    assert value(R.ellipsize(F.lit("abcdef"), 5)) == "abcde..." and value(R.ellipsize(F.lit("abcde"), 5)) == "abcde"
    assert value(R.abbrev_id(F.lit("7"))) == "7..." and value(R.abbrev_id(F.lit(None).cast("string"))) == "N/A"
    assert value(R.rating_badge(F.lit(5))) == "⭐ 5" and value(R.rating_badge(F.lit(None).cast("int"))) == "⭐ N/A"
    assert value(R.label_name(F.lit(5), LABELS)) == "Unknown(5)" and value(R.label_name(F.lit(0), LABELS)) == "Không tốt"
    assert value(R.translate(F.lit("POSITIVE"), LABEL_TRANSLATIONS)) == "Tích cực"
    assert value(R.translate(F.lit("Mixed"), LABEL_TRANSLATIONS)) == "Mixed"
    assert value(R.format_ts(F.lit(0))) == "1970-01-01 00:00:00"
    assert value(R.argmax(F.array(*map(F.lit, (0.1, 2.0, 2.0))))) == 1
    assert [round(p, 4) for p in value(R.softmax(F.array(*map(F.lit, (0.1, 2.0, 0.5)))))] == [0.109, 0.7285, 0.1625]
    assert value(R.softmax(F.array(F.lit(1000.0), F.lit(1000.0)))) == [0.5, 0.5]
    assert value(R.product_url(F.lit(""))) == "" and value(R.product_url(F.lit("7"))).endswith("-p7.html")
    assert value(R.tokens(F.lit(" The cat  AND dog\n"), ["the", "and"])) == ["cat", "dog"]


@pytest.mark.parametrize("n", [2, 3, 7, 10, 64, 1000])
def test_md5_mod_is_exact(spark, n):
    import hashlib

    keys = ["", "x", "tốt"] + [str(i) for i in range(200)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", R.md5_mod(F.col("k"), n).alias("m"))
    assert all(r.m == int(hashlib.md5(r.k.encode()).hexdigest(), 16) % n for r in df.collect())


def test_split_is_a_partition(spark):
    df = reviews(spark, *[{} for _ in range(200)])
    routed = route(df).groupBy("topic").count().collect()
    assert sum(r["count"] for r in routed) == 200 and len(routed) == 2


def test_insert_keeps_first_and_empty_ids_collapse(spark):
    new = reviews(
        spark, {"review_id": "a", "crawled_at": 2.0}, {"review_id": "a", "crawled_at": 1.0},
        {"review_id": None, "crawled_at": 5.0}, {"review_id": "", "crawled_at": 4.0}, {"review_id": "b", "crawled_at": 1.0},
    )
    stored = reviews(spark, {"review_id": "b"})
    got = insert_new(new, stored, ["review_id"], ["crawled_at"]).select("review_id", "crawled_at")
    assert rows(got) == [("", 4.0), ("a", 1.0)]


def test_upsert_is_idempotent_and_model_is_part_of_the_key(spark):
    schema = "review_id string, model string, v int, ts bigint"
    table = spark.createDataFrame([("a", "m", 1, 1), ("a", "n", 1, 1)], schema)
    change = spark.createDataFrame([("a", "m", 2, 2), ("a", "m", 0, 0)], schema)
    once = upsert_latest(table, change, ["review_id", "model"], ["ts"])
    twice = upsert_latest(once, change, ["review_id", "model"], ["ts"])
    assert rows(once) == rows(twice) == [("a", "m", 2, 2), ("a", "n", 1, 1)]
    by_id = upsert_latest(table, change, ["review_id"], ["ts"])  # the older key: models overwrite one another
    assert rows(by_id) == [("a", "m", 2, 2)]


def test_key_check_exempts_rows_without_any_key(spark):
    df = spark.createDataFrame([(None, None), (None, None), ("a", None), ("a", None), ("b", "m")], "review_id string, model string")
    assert rows(key_violations(df, ["review_id", "model"])) == [("a", None, 2)]


def test_rules_upsert_and_precedence(spark):
    commands = spark.createDataFrame(
        [("", "", "both", 1), ("7", None, "phobert", 2), (None, "E", "both", 3), (None, "E", "spark-baseline", 4), (None, None, "phobert", 5)],
        "product_id string, category_id string, active_model string, seq long",
    )
    rules = upsert_rules(spark.createDataFrame([(None, None, "global", "spark-baseline")], CONTROL_RULE), commands)
    assert rows(rules) == sorted(
        [("7", None, None, "phobert"), (None, "E", None, "spark-baseline"), (None, None, "global", "phobert")], key=repr)
    df = reviews(spark, {"product_id": "7", "category_id": "E"}, {"product_id": "8", "category_id": "E"}, {"product_id": "8"})
    got = apply_rules(df, rules).orderBy("review_id").select("active_model")
    assert [r[0] for r in got.collect()] == ["phobert", "spark-baseline", "phobert"]
    within = spark.createDataFrame([("7", "E", "both", 9)], commands.schema)
    got = apply_rules(df, upsert_rules(rules, within)).orderBy("review_id").select("active_model")
    assert [r[0] for r in got.collect()] == ["both", "spark-baseline", "phobert"]
    none = apply_rules(df, rules.filter("false"))
    assert {r.active_model for r in none.collect()} == {"both"}


def test_search_prefers_the_exact_id(spark):
    df = reviews(spark, {"product_id": "12", "product_name": "x"}, {"product_id": "5", "product_name": "No 12 ĐẸP"}, {"product_id": "6"})
    assert [r.product_id for r in search_products(df, "12").collect()] == ["12"]
    assert [r.product_id for r in search_products(df, "no 1[0-9] đẹp").collect()] == ["5"]
    assert search_products(df, "zzz").count() == 0


def test_chart_tells_products_with_one_short_name_apart(spark):
    name = "p" * 40
    df = score_rules(reviews(
        spark, {"product_id": "1", "product_name": name + "a", "rating": 1}, {"product_id": "2", "product_name": name + "b", "rating": 1}))
    assert rows(A.worst_products(df)) == [("1", name + "...", 1), ("2", name + "...", 1)]
    assert A.worst_products(df, by="full").count() == 2
    assert rows(A.worst_products(df, by="display")) == [(name + "...", 2)]


def test_summary_of_nothing_is_zero(spark):
    row = A.summary(score_rules(reviews(spark, {"rating": 5})).filter("false")).first()
    assert (row.total, row.positive, row.positive_pct) == (0, 0, 0.0)


def test_prediction_log_without_review(spark):
    scored = score_rules(reviews(spark, {"review_id": "r1", "product_id": "9", "rating": 5, "content": "abcd", "category_name": "C"}))
    pred = to_prediction(scored, "baseline", F.lit(0))
    row = latest_predictions(pred, reviews(spark, {"review_id": "other"})).first()
    assert (row.product, row.category, row.review, row.timestamp) == ("Product 9", "C", "r1...", "1970-01-01 00:00:00")
    raw = reviews(spark, {"review_id": "r1", "product_name": "N" * 50, "category_name": "D"})
    row = latest_predictions(pred, raw).first()
    assert (row.product, row.category) == ("N" * 40 + "...", "D")


def test_links(spark):
    html = '<link href="/product/css"><a href="/product/1">a</a><a class=x href=\'/item/2\'>b</a><a href="/product/1">c</a><a href="/x">d</a>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert rows(product_links(df)) == [(1, "/item/2"), (1, "/product/1")]
