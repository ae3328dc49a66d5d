"""Search by name through a trigram index, so that a pattern is tested on few products only."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

with warnings.catch_warnings():
    warnings.simplefilter("ignore", DeprecationWarning)
    import re._constants as C
    import re._parser as parser

#: A pattern as a list of alternatives, each the strings that any match of it must hold.
Needed = list[frozenset[str]]
BUCKETS, RAREST, ALTERNATIVES = 64, 4, 32
_NOTHING: Needed = [frozenset()]


def fold(text: Column) -> Column:
    """One form for all spellings that a case-insensitive match takes for equal (a dotted capital I,
    a dotless i, the long s, the sharp s, the final sigma)."""
    low = F.translate(F.lower(text), "ς", "σ")  # a bare upper(lower(x)) would be simplified to upper(x)
    return F.translate(F.lower(F.translate(F.upper(low), "\u0307", "")), "ς", "σ")


def folded(text: str) -> str:
    low = text.lower().replace("ς", "σ")
    return low.upper().replace("\u0307", "").lower().replace("ς", "σ")


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a folded text; an empty array if it has fewer than three characters."""
    at = F.sequence(F.lit(1), F.length(text) - 2)
    parts = F.array_distinct(F.transform(at, lambda i: F.substring(text, i, F.lit(3))))
    return F.when(F.length(text) >= 3, parts).otherwise(F.array().cast("array<string>"))


# Which strings a pattern needs


def _both(a: Needed, b: Needed) -> Needed:
    if len(a) * len(b) > ALTERNATIVES:  # too many to follow up: keep the part that has fewer
        return min(a, b, key=len)
    return [x | y for x in a for y in b]


def _strings(items: list) -> Needed:
    """The needed strings of a sequence; neighbouring literals form one string."""
    found, run = _NOTHING, ""
    for op, value in [*items, (None, None)]:
        if op is C.LITERAL:
            run += chr(value)
            continue
        if run:
            found, run = _both(found, [frozenset([run])]), ""
        if op is C.SUBPATTERN:
            found = _both(found, _strings(list(value[-1])))
        elif op is C.BRANCH:
            options = [s for branch in value[1] for s in _strings(list(branch))]
            found = _both(found, options if len(options) <= ALTERNATIVES else _NOTHING)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and value[0] > 0:
            found = _both(found, _strings(list(value[2])))
        elif op is C.ATOMIC_GROUP:
            found = _both(found, _strings(list(value)))
    return found


def needed_trigrams(pattern: str) -> list[frozenset[str]]:
    """Sets of trigrams of which a name must hold at least one set whole to match ``pattern``.

    An empty list: any name may match. That is the answer too for a pattern that Python's parser
    does not take, or that has an alternative without three literal characters in a row.
    """
    if "\\Q" in pattern or "(?" in pattern.replace("(?:", "").replace("(?>", ""):
        return []  # flags, look-arounds and quotes change what a literal means
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")  # such as nested sets, which the two dialects read differently
            parsed = list(parser.parse(pattern))
    except Exception:  # noqa: BLE001  a construct of the other dialect
        return []
    sets = []
    for strings in _strings(parsed):
        grams = frozenset(s[i : i + 3] for s in map(folded, strings) for i in range(len(s) - 2))
        if not grams:
            return []
        sets.append(grams)
    return sorted(set(sets), key=sorted)


# The index


def write_name_index(products: DataFrame, path: str, key: str = "product_id", name: str = "product_name") -> None:
    """Index the names of ``products``: each trigram's products, in buckets of trigrams, and its frequency.

    ``path/postings`` has one row per trigram, product and name, partitioned by a hash of the trigram;
    ``path/sizes`` one row per trigram. A product may have several names. Rows without name or key
    are left out.
    """
    named = products.select(F.col(key).alias("key"), F.col(name).alias("name")).dropna().distinct()
    grams = named.select("key", F.xxhash64("name").alias("name_id"), F.explode(trigrams(fold(F.col("name")))).alias("gram"))
    placed = grams.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(BUCKETS)).cast("int"))
    # A frequent trigram is spread over several files of its bucket by its products.
    dealt = placed.repartition("bucket", F.pmod(F.xxhash64("key"), F.lit(8)))
    dealt.sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    stored = placed.sparkSession.read.parquet(f"{path}/postings")
    stored.groupBy("bucket", "gram").agg(F.count("*").alias("n")).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/sizes")


def _bucket_of(spark: SparkSession, grams: set[str]) -> dict[str, int]:
    """The bucket of each trigram, a handful per pattern."""
    rows = spark.createDataFrame([(g,) for g in sorted(grams)], "gram string")
    return {r.gram: r.bucket for r in rows.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(BUCKETS))).collect()}


def candidate_products(spark: SparkSession, path: str, pattern: str) -> DataFrame | None:
    """``key``: the products with a name that may match; None if the pattern rules out none.

    Of each alternative only its ``RAREST`` trigrams are looked up. The scan reads the buckets of
    these trigrams and, as a bucket's files are sorted, their row groups.
    """
    sets = needed_trigrams(pattern)
    if not sets:
        return None
    every = {g for s in sets for g in s}
    bucket = _bucket_of(spark, every)
    within = lambda grams: F.col("bucket").isin(sorted({bucket[g] for g in grams})) & F.col("gram").isin(sorted(grams))
    # At most one row per trigram of the pattern.
    size = {r.gram: r.n for r in spark.read.parquet(f"{path}/sizes").filter(within(every)).select("gram", "n").collect()}
    chosen = [sorted(s, key=lambda g: (size[g], g))[:RAREST] for s in sets if all(g in size for g in s)]
    if not chosen:
        return spark.read.parquet(f"{path}/postings").select("key").limit(0)

    def holding(grams: list[str]) -> DataFrame:
        rows = spark.read.parquet(f"{path}/postings").filter(within(grams))
        counted = rows.groupBy("key", "name_id").agg(F.count("*").alias("n"))
        return counted.filter(F.col("n") == len(grams)).select("key")

    return reduce(DataFrame.union, map(holding, chosen)).distinct()


def search_with_index(
    rows: DataFrame, path: str, query: str, key: str = "product_id", name: str = "product_name"
) -> DataFrame:
    """The rows that ``search_products`` finds: those of product ``query``, or else those whose name matches it.

    The pattern is tested on the rows of the products that the index names. If ``rows`` has a column
    ``bucket`` by which its files are partitioned (``with_bucket``), only the candidates' partitions
    are read.
    """
    spark = rows.sparkSession
    exact = rows.filter(_in_bucket(rows, F.lit(query)) & (F.col(key) == query))
    if not exact.limit(1).isEmpty():
        return exact
    matches = F.coalesce(F.col(name).rlike("(?iu)" + query), F.lit(False))
    found = candidate_products(spark, path, query)
    if found is None:
        return rows.filter(matches)
    on = [key]
    found = found.withColumnRenamed("key", key)
    if "bucket" in rows.columns:
        found, on = with_bucket(found, key), [key, "bucket"]
    return rows.join(found, on, "left_semi").filter(matches)


def with_bucket(rows: DataFrame, key: str = "product_id") -> DataFrame:
    """``rows`` with the partition column that keeps a product's rows together."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))


def _in_bucket(rows: DataFrame, value: Column) -> Column:
    if "bucket" not in rows.columns:
        return F.lit(True)
    return F.col("bucket") == F.pmod(F.xxhash64(value), F.lit(BUCKETS)).cast("int")
