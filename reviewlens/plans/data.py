"""Reviews derived by Spark from the given ``documents`` and ``part`` tables.

The texts hold none of the lexicon's words, so each review begins with a cue phrase chosen by its
id, followed by the whole document text. Every tenth review arrives a second time, later and with
rating 5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reviewlens.functions import product_url
from reviewlens.operators.documents import to_prediction, to_prediction_v1
from reviewlens.operators.keyed import first_by
from reviewlens.operators.routing import topic_for
from reviewlens.operators.scoring import score_rating, score_rules
from reviewlens.schema import (
    MODEL_BASELINE, MODEL_TRANSFORMER, REVIEW, TOPIC_BASELINE, V1_RULES,
)

FIRST_TS = 1_762_508_000


# The given tables' columns: with a declared schema, building a query reads no file footer.
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "pages": "page_id bigint, url string, html string",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def cycle(n: int, values: dict[int, Column | str], otherwise: Column | str) -> Column:
    """A value chosen by ``doc_id % n``."""
    slot = F.col("doc_id") % n
    chosen = None
    for i, value in values.items():
        chosen = F.when(slot == i, value) if chosen is None else chosen.when(slot == i, value)
    return chosen.otherwise(otherwise)


def product_of(doc: Column) -> Column:
    """The part that a document is a review of."""
    return F.when(doc % 7 == 3, 0).otherwise(F.floor(doc / 20)).cast("bigint")


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as they arrive, repeats included, from one scan of the documents.

    Twenty documents in a row share a product, so that the reviews are of the first parts only, one
    in forty at the given sizes; a seventh of all reviews is of one hot product.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    part = table(spark, sf_dir, "part")
    joined = documents.withColumn("p_partkey", product_of(F.col("doc_id"))).join(part, "p_partkey")
    doc, text = F.col("doc_id"), F.col("text")
    pid = F.col("p_partkey").cast("string")
    again = F.explode(F.when(doc % 10 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    name = F.concat_ws(" ", "p_name", "p_type", "p_brand", F.lit("limited collector edition no"), pid)
    values = {
        "platform": F.when(doc % 9 == 4, "shopee").otherwise("tiki"),
        "review_id": doc.cast("string"),
        "product_id": pid,
        "product_name": name,
        "product_url": product_url(pid),
        "category_id": F.col("p_type"),
        "category_name": F.when(doc % 11 != 0, F.col("p_type")),
        "rating": F.when(F.col("_again"), 5).otherwise((doc % 6).cast("int")),
        "title": F.when(doc % 3 == 0, "").otherwise(F.col("source")),
        "content": cycle(
            8,
            {
                0: "ok",
                1: F.concat(F.lit("Sản phẩm tốt, giao hàng nhanh. "), text),
                2: F.concat(F.lit("Chất lượng tệ, kém. "), text),
                3: F.concat(F.lit("KHÔNG TỐT "), text),
                4: F.concat(F.lit("good but bad "), text),
                5: "",
                6: F.concat(F.lit("notebook cover "), text),
            },
            text,
        ),
        "reviewer_name": F.when(doc % 13 != 0, F.concat(F.lit("user"), (doc % 17).cast("string"))),
        "create_time": cycle(
            5,
            {0: "", 1: "1753674740", 2: "2020-01-01T00:00:00", 3: "2020-01-01T00:00:00Z"},
            "2025-11-05T07:58:35",
        ),
        "crawled_at": (
            F.lit(1_762_500_000) + doc + (doc % 7) * 60 + F.when(F.col("_again"), 100_000).otherwise(0)
        ).cast("double"),
        "source_type": F.lit("category"),
        "source_id": F.col("p_type"),
    }
    repeated = joined.withColumn("_again", again)
    return repeated.select(*[values[name].alias(name) for name in REVIEW.names])


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored reviews: first arrival per id."""
    return first_by(arrivals(spark, sf_dir), ["review_id"], ["crawled_at"])


def cue() -> Column:
    """The rating that a review's first words say, if they are a clear cue."""
    return F.when(F.col("content").startswith("Sản phẩm tốt"), 5).when(F.col("content").startswith("Chất lượng tệ"), 1)


def cued(reviews: DataFrame) -> DataFrame:
    """Reviews that begin with a clear cue, rated as the cue says; the others go."""
    return reviews.withColumn("rating", cue()).filter("rating IS NOT NULL")


def cued_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cued`` of the stored reviews; texts without a cue go before the first-arrival step, so none is shuffled."""
    slim = arrivals(spark, sf_dir).withColumn("content", F.when(cue().isNotNull(), F.col("content")))
    return cued(first_by(slim, ["review_id"], ["crawled_at"]))


def number() -> Column:
    """The review's number, from which prediction times are derived."""
    return F.col("review_id").cast("bigint")


def prediction_time() -> Column:
    return F.lit(FIRST_TS) + number()


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule predictions of every stored review whose content is long enough.

    Scoring and the length test come before the first-arrival step, so a query that needs no text
    shuffles none.
    """
    scored = score_rules(arrivals(spark, sf_dir)).withColumn("_long", F.length("content") > 3)
    return to_prediction(_kept(scored), MODEL_BASELINE, prediction_time())


def _kept(scored: DataFrame) -> DataFrame:
    return first_by(scored, ["review_id"], ["crawled_at"]).filter("_long")


def scored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with their product names, as the evaluation views use them."""
    scored = score_rules(arrivals(spark, sf_dir)).withColumn("_long", F.length("content") > 3)
    return _kept(scored).drop("_long")


def split_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of both models, each on its half of the reviews; the second by rating alone."""
    base = arrivals(spark, sf_dir).withColumn("_topic", topic_for(F.col("review_id")))
    base = base.withColumn("_long", F.length("content") > 3)
    rules = score_rules(base.filter(F.col("_topic") == TOPIC_BASELINE))
    rating = score_rating(base.filter(F.col("_topic") != TOPIC_BASELINE))
    return to_prediction(_kept(rules), MODEL_BASELINE, prediction_time()).unionByName(
        to_prediction(_kept(rating), MODEL_TRANSFORMER, prediction_time())
    )


def predictions_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older record version of the same reviews."""
    scored = score_rules(arrivals(spark, sf_dir), V1_RULES).withColumn("_long", F.length("content") > 3)
    stamp = F.date_format(F.timestamp_seconds(prediction_time()), "yyyy-MM-dd'T'HH:mm:ss")
    return to_prediction_v1(_kept(scored), MODEL_BASELINE, stamp)
