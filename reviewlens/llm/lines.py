"""Line dedup: a sharded minimal perfect hash over the distinct lines, probed by the documents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.common import map_batches, sorted_by, text_or_empty, whole_groups, written
from reviewlens.operators.evaluate import computed_once

WHITE = " \t\n\x0b\x0c\r"
#: Distinct lines of a shard, probes that one task takes to a shard.
SHARD, PROBES = 1 << 16, 1 << 18
#: Bits per line in a level of the hash; counts are kept up to MOST.
ROOM, MOST = 2, 255
#: Stands for a missing id: such rows are one document, the last of all.
NO_ID = (1 << 63) - 1

INDEX = "shard bigint, bits binary, sizes binary, prints binary, counts binary, firsts binary, load bigint"


def slots(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    """A position below ``size`` for each line hash ``(a, b)``, another one on each level."""
    h = a ^ (b + np.uint64(2 * level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


def fingerprint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((b ^ (a >> np.uint64(7))) * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Numbers 0 to n-1 for n different keys, in about 3 bits a key.

    A level marks the positions that exactly one of its keys falls on; the others go on to the next
    level. A key's number is the count of marks before its own.
    """

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.bits, self.sizes = bits, sizes
        self.rank = np.cumsum(bits, dtype=np.int64) - bits

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        marks, sizes = [np.zeros(0, np.uint8)], []
        while len(a):
            size = max(64, ROOM * len(a))
            at = slots(a, b, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            marks.append(alone.astype(np.uint8))
            sizes.append(size)
            left = ~alone[at]
            a, b = a[left], b[left]
        return cls(np.concatenate(marks), np.array(sizes, np.int64))

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each key; -1, or any number, for one that the hash was not built over."""
        out = np.full(len(a), -1, np.int64)
        open_, base = np.arange(len(a)), 0
        for level, size in enumerate(self.sizes):
            at = base + slots(a[open_], b[open_], level, int(size))
            hit = self.bits[at] == 1
            out[open_[hit]] = self.rank[at[hit]]
            open_, base = open_[~hit], base + int(size)
        return out


def build_shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of ``INDEX`` per shard from the rows ``shard, a, b, n, first, places`` sorted by shard."""
    for t, edges in whole_groups(batches, ["shard"], SHARD):
        a, b = (t.column(c).to_numpy().view(np.uint64) for c in "ab")
        n, first, places, shard = (t.column(c).to_numpy() for c in ("n", "first", "places", "shard"))
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            own = slice(s, e)
            table = PerfectHash.of(a[own], b[own])
            order = np.argsort(table.number(a[own], b[own]))
            row = [
                int(shard[s]),
                np.packbits(table.bits).tobytes(),
                table.sizes.tobytes(),
                fingerprint(a[own], b[own])[order].tobytes(),
                np.minimum(n[own], MOST).astype(np.uint8)[order].tobytes(),
                first[own][order].tobytes(),
                int(places[own].sum()),
            ]
            types = [pa.int64(), *[pa.binary()] * 5, pa.int64()]
            names = ["shard", "bits", "sizes", "prints", "counts", "firsts", "load"]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, types, strict=True)], names=names)


class Shard:
    """The arrays of one shard, as a task that probes them holds them."""

    def __init__(self, bits: bytes, sizes: bytes, prints: bytes, counts: bytes, firsts: bytes):
        widths = np.frombuffer(sizes, np.int64)
        marks = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(widths.sum()))
        self.hash = PerfectHash(marks, widths)
        self.prints, self.counts = np.frombuffer(prints, np.uint32), np.frombuffer(counts, np.uint8)
        self.firsts = np.frombuffer(firsts, np.int64)

    def repeats(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray, min_docs: int) -> np.ndarray:
        """Whether a line is known, in enough documents, and first in another one than its own."""
        at = self.hash.number(a, b)
        known = at >= 0
        known[known] = self.prints[at[known]] == fingerprint(a[known], b[known])
        known[known] = (self.counts[at[known]] >= min_docs) & (self.firsts[at[known]] != doc[known])
        return known


def probe(min_docs: int):
    """Arrow rows ``u, v, at`` of the lines to drop, from cells that begin with their shard's arrays."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            heads = np.flatnonzero(batch.column("kind").to_numpy() == 0)
            edges = np.concatenate([[0], heads, [batch.num_rows]])
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(s, e - s)
                if part.num_rows and part.column("kind")[0].as_py() == 0:
                    shard = Shard(*(part.column(c)[0].as_py() for c in ("bits", "sizes", "prints", "counts", "firsts")))
                    part = part.slice(1)
                if not part.num_rows:
                    continue
                a, b = (part.column(c).to_numpy().view(np.uint64) for c in "ab")
                drop = pa.array(shard.repeats(a, b, part.column("doc").to_numpy(), min_docs))
                yield part.select(["u", "v", "at"]).filter(drop)

    return run


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(F.btrim(line, F.lit(WHITE)), upper, upper.lower())


def without_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """``id_col, n_lines, n_dropped, kept`` per row: its text without the lines that earlier documents hold.

    A line's key is the line without white space at its ends, A-Z in lower case. A key of at least
    ``min_chars`` characters in at least ``min_docs`` documents (at most 255) loses all its lines
    but those in the document with the smallest id; all other lines stay as they are.

    The distinct keys, as 128-bit hashes, are dealt to shards of about ``SHARD``. A shard is a
    minimal perfect hash with arrays of fingerprints, of document counts and of first holders. Each
    line's hash, without its text, goes to its shard and is probed there; a shard with many probes
    is sent to as many tasks as they need, so that a line in a third of all documents is no hot key.

    A null or empty text is one empty line. Rows of one id are one document; rows without id are
    one document after all others, and keep a null id. Repeated rows get the same answer. No rows
    give no rows; other columns are ignored.
    """
    if not 2 <= min_docs <= MOST:
        raise ValueError(f"min_docs is from 2 to {MOST}")
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("text"))
    rows = rows.withColumns(
        {"doc": F.coalesce(F.col("id").cast("bigint"), F.lit(NO_ID)), "u": F.xxhash64("id", "text"), "v": F.xxhash64(F.lit(1), "id", "text")}
    )
    places = rows.select("u", "v", "doc", F.posexplode(lines_of(F.col("text"))).alias("at", "line"))
    places = places.withColumn("key", line_key(F.col("line"))).filter(F.length("key") >= min_chars)
    places = places.select("u", "v", "doc", "at", F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), "key").alias("b"))
    places = written(places.dropDuplicates(["u", "v", "at"]), "lines")

    held = places.groupBy("a", "b", "doc").agg(F.count("*").alias("places"))
    counted = F.count("*").alias("n"), F.min("doc").alias("first"), F.sum("places").alias("places")
    keys = written(held.groupBy("a", "b").agg(*counted), "line-keys")
    shards = max(1, -(-keys.count() // SHARD))
    shard = F.pmod(F.col("a"), F.lit(shards))
    index = map_batches(sorted_by(keys.withColumn("shard", shard), ["shard"]), build_shards, INDEX)
    index = written(index, "line-index")

    # A shard goes to as many tasks as its probes need: salts follow from the load it was built with.
    salts = F.ceil(F.col("load") / PROBES).cast("int")
    arrays = ["bits", "sizes", "prints", "counts", "firsts"]
    none = lambda kind: F.lit(None).cast(kind)
    heads = index.select(
        "shard", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(0).alias("kind"), *arrays,
        *[none(k).alias(c) for c, k in (("u", "bigint"), ("v", "bigint"), ("at", "int"), ("doc", "bigint"), ("a", "bigint"), ("b", "bigint"))],
    )
    probes = places.withColumn("shard", shard).join(index.select("shard", salts.alias("salts")), "shard").select(
        "shard", F.pmod(F.xxhash64("u", "v", "at"), "salts").cast("int").alias("salt"), F.lit(1).alias("kind"),
        *[none("binary").alias(c) for c in arrays], "u", "v", "at", "doc", "a", "b",
    )
    cell = ["shard", "salt"]
    dealt = heads.unionByName(probes).repartition(*cell).sortWithinPartitions(*cell, "kind")
    dropped = map_batches(dealt, probe(min_docs), "u bigint, v bigint, at int")
    dropped = dropped.groupBy("u", "v").agg(F.collect_list("at").alias("dropped"))

    joined = rows.select("id", "text", "u", "v").join(dropped, ["u", "v"], "left")
    split = computed_once(joined, "lines", lines_of(F.col("text")))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    chosen = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    return split.select(
        F.col("id").alias(id_col),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size(F.coalesce("dropped", F.array().cast("array<int>"))).cast("bigint").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(chosen).alias("kept"),
    )
