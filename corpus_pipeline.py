"""From documents to packed training sequences: five stages, each a table that the next one reads.

A stage takes ``(spark, docs, sf_dir)``, works on every row its predecessor kept and returns the
columns of ``documents``; the last one returns the packed pieces. Null texts count as empty in every
stage, repeated rows are rows (the second stage keeps one of them), extra columns are carried along,
and an empty table stays one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reviewlens.llm import language, packing, repeats, secrets, simhash
from reviewlens.llm.common import table, written

#: Under this score a text shares next to nothing with any learned language.
LEAST_SCORE = 0.15


def packed_rows(docs: DataFrame, *columns) -> DataFrame:
    """The given rows as one struct ``row``, beside columns that a stage works with: no names can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)


def unpacked(rows: DataFrame, docs: DataFrame, text=None) -> DataFrame:
    """The columns of ``docs``, with a new text and its length if one is given."""
    new = {} if text is None else {"text": text, "n_chars": F.length(text).cast("bigint")}
    return rows.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without a letter or far from all languages go."""
    model = language.fit(docs.filter(~language.held_out()))
    known = language.identify(packed_rows(docs, "text"), model, keep=["row"], pred="lang", score="score")
    kept = (F.col("lang") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return unpacked(known.filter(kept), docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    key = F.struct("doc_id", repeats.text_key().alias("text_id")).alias("key")
    groups = simhash.near_duplicates(docs.select(key, "text"), "key", width=4, radius=4)
    firsts = groups.filter("key = component_id").select("key").distinct()
    order = Window.partitionBy("key").orderBy(*[F.col("row").getField(c) for c in docs.columns if c not in ("doc_id", "text")])
    once = packed_rows(docs, key).join(firsts, "key", "left_semi").withColumn("turn", F.row_number().over(order))
    return unpacked(once.filter("turn = 1"), docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 200 bytes or more that occur anywhere else."""
    cut = repeats.without_repeats(docs, length=200, whole_chars=True)
    cut = cut.select("text_id", F.col("kept").cast("string").alias("kept"))
    joined = packed_rows(docs, repeats.text_key().alias("text_id")).join(cut, "text_id", "left")
    return unpacked(joined, docs, F.coalesce("kept", "row.text"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret."""
    found = secrets.scan(packed_rows(docs, "text"), out="spans")
    return unpacked(found, docs, secrets.redacted(F.col("text"), F.col("spans")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 1024 tokens."""
    return packing.packed(docs, size=1024, end_id=2)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: SQL expresses neither the language model nor the tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
