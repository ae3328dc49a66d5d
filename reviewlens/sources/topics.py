"""Reading from and writing to topics: a message broker, or folders of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.operators.routing import route
from reviewlens.sources import landed
from reviewlens.sources.decode import encode

REPLAY_COLUMNS = ("product_id", "category_id", "rating", "title", "content", "create_time")


def read_review_stream(
    spark: SparkSession, fmt: str, source: str, starting: str = "earliest", **options
) -> DataFrame:
    """A stream with a ``value`` string column and its place in the order of arrival, ``seq``.

    ``seq`` is a struct: of a broker the time, topic partition and offset (``in_order`` of the streaming
    jobs makes an order of it, as producers may set the time), of files one that grows with arrival.
    ``fmt`` is ``kafka`` (``source`` is the topic; pass ``kafka__bootstrap__servers`` and, for
    micro-batch size, ``maxOffsetsPerTrigger``), ``text`` (``source`` is a folder, whose files are one
    message per line) or ``landed`` (the same folder, with ``maxRecordsPerTrigger``; ``seq`` then has the
    number of the record's batch, as a trigger may take several by ``batchesPerTrigger``).
    """
    if fmt == "landed":
        landed.register(spark)
    reader = spark.readStream.format(fmt)
    for name, value in options.items():
        reader = reader.option(name.replace("__", "."), value)
    if fmt == "kafka":
        return broker_messages(reader.option("subscribe", source).option("startingOffsets", starting).load())
    if fmt == "landed":
        return reader.load(source).select("value", F.struct("file", "line", "batch").alias("seq"))
    file = F.col("_metadata")
    place = F.struct(
        file["file_modification_time"].alias("at"),
        F.concat(file["file_path"], F.lit(":"), F.lpad(file["file_block_start"].cast("string"), 20, "0")).alias("part"),
    )
    return reader.load(source).select("value", place.alias("seq"))


def broker_messages(records: DataFrame) -> DataFrame:
    """``value`` and ``seq`` of a broker's records (``value, timestamp, partition, offset``)."""
    place = F.struct(F.col("timestamp").alias("at"), F.col("partition").alias("part"), F.col("offset").alias("pos"))
    return records.select(F.col("value").cast("string").alias("value"), place.alias("seq"))


def routed_messages(reviews: DataFrame) -> DataFrame:
    """``topic`` and ``value`` of every review."""
    return route(reviews).select("topic", encode(reviews).alias("value"))


def write_routed(reviews: DataFrame, fmt: str, path: str, mode: str = "append", **options) -> None:
    """Publish each review as UTF-8 JSON on its topic: a broker, or one sub-folder per topic."""
    writer = routed_messages(reviews).write.format(fmt)
    for name, value in options.items():
        writer = writer.option(name.replace("__", "."), value)
    if fmt == "kafka":
        writer.save()
    else:
        writer.partitionBy("topic").mode(mode).save(path)


def replay(reviews: DataFrame) -> DataFrame:
    """Stored reviews newest first as six-field JSON messages; the sort is range-partitioned."""
    ordered = reviews.orderBy(F.desc("crawled_at"), F.asc("review_id"))
    return ordered.select("review_id", encode(reviews.select(*REPLAY_COLUMNS)).alias("value"))
