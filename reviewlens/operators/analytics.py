"""Counts and summaries. All are partial aggregates: a hot key costs one row per map task."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from reviewlens.functions import ellipsize
from reviewlens.operators.paging import newest
from reviewlens.schema import V2_RULES

LABEL_ORDER = (V2_RULES.positive.label, V2_RULES.neutral.label, V2_RULES.negative.label)


def _n(name: str = "n") -> Column:
    return F.count("*").alias(name)


def counts(reviews: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: totals of both tables; neither scan reads a data column."""
    one = reviews.sparkSession.range(1)
    return one.select(
        reviews.agg(F.count("*")).scalar().alias("raw"), predictions.agg(F.count("*")).scalar().alias("pred")
    )


def by_model(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("model").agg(_n())


def by_platform(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("platform").agg(_n())


def by_label(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("pred_label").agg(_n())


def tally(df: DataFrame, key: str, kind: str) -> DataFrame:
    """Rows ``kind, name, n``: how many rows there are (empty name), and per value of ``key`` as ``<kind>_<key>``."""
    named = df.select(F.coalesce(F.col(key), F.lit("")).alias("name"))
    counted = named.rollup("name").agg(_n(), F.grouping("name").alias("all"))
    which = F.when(F.col("all") == 1, kind).otherwise(f"{kind}_{key}")
    return counted.select(which.alias("kind"), F.coalesce("name", F.lit("")).alias("name"), "n")


def stamped(tallies: DataFrame, as_of: datetime) -> DataFrame:
    stamp = int(as_of.replace(tzinfo=as_of.tzinfo or timezone.utc).timestamp())
    return tallies.withColumn("ts", F.lit(stamp).cast("bigint"))


def snapshot(reviews: DataFrame, predictions: DataFrame, as_of: datetime) -> DataFrame:
    """Rows ``kind, name, n, ts``: both totals (empty name) and the counts per platform and model.

    Each table is read once. ``running_totals`` of the streaming jobs gives the same without reading them.
    """
    return stamped(tally(reviews, "platform", "raw").unionByName(tally(predictions, "model", "pred")), as_of)


def stored_counts(spark: SparkSession, reviews: str, predictions: str) -> DataFrame:
    """One row ``raw, pred``: the rows of two parquet folders, from the files' footers alone.

    Spark answers the counts by aggregate push-down, which its second-generation reader offers; a
    session of its own has it switched on. No row group is read. Every stored row counts, so for a
    table of versions this is an estimate of its keys.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    total = lambda path, name: own.read.parquet(path).agg(F.count("*")).scalar().alias(name)
    return own.range(1).select(total(reviews, "raw"), total(predictions, "pred"))


NAME_LENGTH = 40


def with_display_name(df: DataFrame, by: str = "product", n: int = NAME_LENGTH) -> DataFrame:
    """Add ``display_name``: the product name (else id, else ``Unknown``), cut if ``by='display'``."""
    full = F.coalesce("product_name", "product_id", F.lit("Unknown"))
    return df.withColumn("display_name", ellipsize(full, n) if by == "display" else full)


def _by_product(df: DataFrame, by: str) -> tuple[DataFrame, list[str]]:
    """Rows with the columns that tell products apart: id and full name, or the (cut) name alone."""
    named = with_display_name(df, by).withColumn("product_id", F.coalesce("product_id", F.lit("")))
    return named, ["product_id", "display_name"] if by == "product" else ["display_name"]


def _shown(df: DataFrame, by: str) -> DataFrame:
    """Names cut for display once products have been told apart."""
    return df.withColumn("display_name", ellipsize(F.col("display_name"), NAME_LENGTH)) if by == "product" else df


def top_keys(df: DataFrame, k: int = 10, by: str = "product") -> DataFrame:
    """The ``k`` products with most rows, and their ``total``; equal counts by name, then id."""
    named, keys = _by_product(df, by)
    totals = named.groupBy(*keys).agg(_n("total"))
    return newest(totals, k, [F.desc("total"), *[F.asc(c) for c in reversed(keys)]])


def top_products(df: DataFrame, k: int = 10, by: str = "product") -> DataFrame:
    """Label counts of the ``k`` products with most reviews; equal counts by name, then id.

    The table is aggregated once per product and label. Totals, ranking and the semi join work on
    that small result. ``by`` is ``product`` (id and full name, cut for display), ``full`` (the full
    name) or ``display`` (the cut name: products that share it are one).
    """
    named, keys = _by_product(df, by)
    per_label = named.groupBy(*keys, "pred_label_vn").agg(_n())
    totals = per_label.groupBy(*keys).agg(F.sum("n").alias("total"))
    top = newest(totals, k, [F.desc("total"), *[F.asc(c) for c in reversed(keys)]])
    return _shown(per_label.join(F.broadcast(top), keys), by).select(*keys, "pred_label_vn", "n", "total")


def by_category(df: DataFrame) -> DataFrame:
    category = F.coalesce("category_name", F.lit("Unknown")).alias("category_name")
    return df.groupBy(category, "pred_label_vn").agg(_n())


def by_category_wide(df: DataFrame, labels: Sequence[str] = LABEL_ORDER) -> DataFrame:
    """As ``by_category``, one column per label."""
    category = F.coalesce("category_name", F.lit("Unknown")).alias("category_name")
    return df.groupBy(category).pivot("pred_label_vn", list(labels)).count().na.fill(0)


def worst_products(df: DataFrame, k: int = 10, by: str = "product", label: str = LABEL_ORDER[2]) -> DataFrame:
    """The ``k`` products with most negative reviews; equal counts by name, then id. ``by`` as above."""
    negative, keys = _by_product(df.filter(F.col("pred_label_vn") == label), by)
    counted = negative.groupBy(*keys).agg(_n("negative_count"))
    return _shown(newest(counted, k, [F.desc("negative_count"), *[F.asc(c) for c in reversed(keys)]]), by)


def summary(df: DataFrame) -> DataFrame:
    """One row: total, and count and percentage of each label; 0 when there is nothing."""
    positive, neutral, negative = (F.count_if(F.col("pred_label_vn") == label) for label in LABEL_ORDER)
    counted = df.agg(
        _n("total"), positive.alias("positive"), neutral.alias("neutral"), negative.alias("negative")
    )

    def share(name: str) -> Column:
        return F.when(F.col("total") > 0, F.col(name) * 100.0 / F.col("total")).otherwise(0.0)

    return counted.select(
        "*", *[share(name).alias(f"{name}_pct") for name in ("positive", "neutral", "negative")]
    )


def product_names(df: DataFrame) -> DataFrame:
    """Sorted distinct full names."""
    return df.select("product_name").filter(F.col("product_name").isNotNull()).distinct().orderBy("product_name")


def matched_products(df: DataFrame, shown: int = 3) -> DataFrame:
    """One row: how many products match, the first ``shown`` names, and how many more there are.

    Only the names shown are collected, never the whole set.
    """
    names = df.select("product_name").filter(F.col("product_name").isNotNull()).distinct()
    first = newest(names, shown, [F.asc("product_name")])
    listing = first.agg(F.array_join(F.array_sort(F.collect_list("product_name")), ", ")).scalar()
    total = names.agg(F.count("*")).scalar()
    return df.sparkSession.range(1).select(
        total.alias("matched"), listing.alias("names"), F.greatest(total - shown, F.lit(0)).alias("more")
    )


def rating_mix(reviews: DataFrame) -> DataFrame:
    """Count and share of positive (4-5), negative (1-2) and neutral (3) ratings."""
    mood = (
        F.when(F.col("rating").isin(4, 5), "positive")
        .when(F.col("rating").isin(1, 2), "negative")
        .when(F.col("rating") == 3, "neutral")
    )
    groups = reviews.select(mood.alias("mood")).filter(F.col("mood").isNotNull()).groupBy("mood").agg(_n())
    # At most three rows reach this window.
    return groups.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def outcome_counts(decoded: DataFrame, min_chars: int = 3) -> DataFrame:
    """One row: processed, skipped and rejected records of a ``decode_reviews`` result."""
    return decoded.agg(*outcome_metrics(min_chars))


def outcome_metrics(min_chars: int = 3) -> list[Column]:
    """The same counters as aggregates, for ``df.observe`` on a stream."""
    good = F.col("reject_reason").isNull()
    long_enough = F.length("content") > min_chars
    return [
        F.count_if(good & long_enough).alias("processed"),
        F.count_if(good & ~long_enough).alias("skipped"),
        F.count_if(~good).alias("errors"),
    ]


def word_count(df: DataFrame, column: str) -> DataFrame:
    """Frequency of every lower-case word."""
    words = df.select(F.explode(F.split(F.lower(F.col(column)), r"[^\p{L}\p{M}\p{N}_]+")).alias("word"))
    return words.filter("word != ''").groupBy("word").agg(_n())


def sentiment_trend(predictions: DataFrame, window: str = "5 minutes", delay: str | None = None) -> DataFrame:
    """Predictions per tumbling window of event time and label; ``delay`` sets a watermark on streams."""
    timed = predictions.withColumn("event_time", F.timestamp_seconds("ts"))
    if delay is not None:
        timed = timed.withWatermark("event_time", delay)
    return (
        timed.groupBy(F.window("event_time", window).alias("w"), "pred_label_vn")
        .agg(_n())
        .select(
            F.unix_timestamp("w.start").alias("window_start"),
            F.unix_timestamp("w.end").alias("window_end"),
            "pred_label_vn",
            "n",
        )
    )


def negative_burst(
    predictions: DataFrame, key: str = "product_id", n: int = 3, within_seconds: int = 600,
    label: str = LABEL_ORDER[2],
) -> DataFrame:
    """Negatives that are the ``n``-th within less than ``within_seconds``, per key.

    A row needs to see only rows less than ``within_seconds`` older: those of its own time slice of
    that length and of the slice before. Every row is therefore sent to its slice and the next one,
    and windows span one key and two slices instead of all history of a key that may hold a third
    of the table.
    """
    negatives = predictions.filter(F.col("pred_label_vn") == label).select(key, "review_id", "ts")
    own = F.floor(F.col("ts") / within_seconds)
    sliced = negatives.withColumn("_own", own).withColumn(
        "_slice", F.explode(F.array(F.col("_own"), F.col("_own") + 1))
    )
    window = Window.partitionBy(key, "_slice").orderBy("ts", "review_id")
    started = F.lag("ts", n - 1).over(window)
    return (
        sliced.withColumn("burst_start", started)
        .filter((F.col("_slice") == F.col("_own")) & (F.col("ts") - F.col("burst_start") < within_seconds))
        .select(key, "review_id", "ts", "burst_start")
    )
