"""SimHash near-duplicates: fingerprints of word shingles, linked at a few differing bits."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField

from reviewlens.llm.common import add_columns, cells, map_batches, repeated, sorted_by, whole_groups, written
from reviewlens.llm.components import connected_components

BITS = 64
#: Shingles that are hashed at once, rows of a bucket's part, and groups compared pair by pair.
BLOCK, CAP, SMALL = 1 << 15, 4096, 16


def fingerprint(text: bytes | None, width: int, seed: int = 42) -> int:
    """The unsigned fingerprint of one text: each bit by the majority of its shingles' hashes."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    counts = np.zeros(BITS, np.int64)
    n = len(words) - width + 1
    for at in range(0, n, BLOCK):
        part = words[at : at + BLOCK + width - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(width)), strict=False))
        digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed)))
        bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str, width: int, out: str, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of ``text`` in column ``out``."""

    def make(texts: list[bytes | None]) -> list[pa.Array]:
        prints = np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts))
        return [pa.array(prints.view(np.int64))]

    return add_columns(docs, text, [StructField(out, LongType())], make, keep)


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes: row ``b`` packs bit ``b`` of all values, 64 values to a word."""
    n = -(-len(values) // BITS) * BITS
    padded = np.zeros(n, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)


EVERY = np.uint64(np.iinfo(np.uint64).max)


def close_lanes(planes: np.ndarray, ones: np.ndarray, n: int, radius: int) -> np.ndarray:
    """Words whose bits tell, for each query, the lanes that differ from it in at most ``radius`` bits.

    ``planes`` holds ``n`` lanes as bit planes, ``ones`` the queries' bits (64 x queries) as full or
    empty words. Vertical counters take each difference plane with a ripple of carry-saves; a lane
    whose counter passes the radius is marked. Blocks of 64 lanes that no query can reach any more
    are abandoned.
    """
    width = planes.shape[1]
    over = np.zeros((ones.shape[1], width), np.uint64)
    if n % BITS:
        over[:, -1] = EVERY << np.uint64(n % BITS)
    counters = [np.zeros_like(over) for _ in range((radius + 1).bit_length())]
    words = np.arange(width)
    for b in range(BITS):
        carry = planes[b, words][None, :] ^ ones[b][:, None]
        above = EVERY
        for k, counter in enumerate(counters):
            counters[k], carry = counter ^ carry, counter & carry
            above = above & (counters[k] if (radius + 1) >> k & 1 else ~counters[k])
        over |= above | carry
        if b % 8 == 7:
            alive = (over != EVERY).any(axis=0)
            if not alive.any():
                return np.zeros((ones.shape[1], width), np.uint64)
            if 2 * alive.sum() < len(words):
                words, over, counters = words[alive], over[:, alive], [c[:, alive] for c in counters]
    close = np.zeros((ones.shape[1], width), np.uint64)
    close[:, words] = ~over
    return close


def lanes(words: np.ndarray, n: int) -> np.ndarray:
    """The bits of the last axis as booleans, the first ``n`` of each row."""
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=-1, bitorder="little")[..., :n].astype(bool)


def near_pairs(values: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs within ``radius``, for many small groups at once (``group`` ascends)."""
    for d in range(1, SMALL):
        i = np.flatnonzero(group[d:] == group[:-d])
        if not len(i):
            return
        differ = planes_of(values[i] ^ values[i + d])
        close = lanes(close_lanes(differ, np.zeros((BITS, 1), np.uint64), len(i), radius), len(i))[0]
        yield i[close], i[close] + d


def near_links(values: np.ndarray, side: np.ndarray, within: bool, radius: int) -> Iterator[tuple[int, int]]:
    """Links that join the same values as all pairs within ``radius`` do, for one large cell.

    With ``within``, every value meets every other; else those of one side meet those of the other.
    """
    rows = np.arange(len(values)) if within else np.flatnonzero(side)
    cols = rows if within else np.flatnonzero(~side)
    if not len(rows) or not len(cols):
        return
    planes, label = planes_of(values[cols]), np.arange(len(values))
    for at in range(0, len(rows), BITS):
        block = rows[at : at + BITS]
        ones = (values[block][None, :] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1)
        close = lanes(close_lanes(planes, ones * EVERY, len(cols), radius), len(cols))
        for r, hit in zip(block, close, strict=True):
            found = cols[hit]
            other, first = np.unique(label[found], return_index=True)
            new = other != label[r]
            if new.any():
                for j in found[first[new]]:
                    yield int(r), int(j)
                label[np.isin(label, other[new])] = label[r]


def bit_blocks(blocks: int, radius: int) -> list[int]:
    """Masks of ``blocks - radius`` blocks each: two values within ``radius`` bits agree under one at least."""
    edge = [round(i * BITS / blocks) for i in range(blocks + 1)]
    whole = [sum(1 << b for b in range(edge[i], edge[i + 1])) for i in range(blocks)]
    return [sum(chosen) for chosen in combinations(whole, blocks - radius)]


def fingerprint_links(prints: DataFrame, column: str, radius: int, blocks: int) -> DataFrame:
    """Links ``u, v`` that connect the same values of ``column`` as all pairs within ``radius`` do.

    ``column`` holds distinct bigints. Two values within ``radius`` of each other have
    ``blocks - radius`` equal blocks, so they share a bucket; buckets above ``CAP`` values are
    split into cells. More ``blocks`` give longer keys and so fewer chance meetings.
    """
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in bit_blocks(blocks, radius)]
    keys = F.posexplode(F.array(*[F.col(column).bitwiseAND(F.lit(m).cast("bigint")) for m in signed]))
    rows = repeated(prints.select(F.col(column).alias("value"), keys.alias("mask", "bucket")), ["mask", "bucket"], "n")
    key = ["mask", "bucket", "lo", "hi"]
    dealt = sorted_by(cells(rows, ["mask", "bucket"], "value", CAP, "n").select(*key, "side", "value"), key)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, edges in whole_groups(batches, key):
            values = t.column("value").to_numpy().view(np.uint64)
            side = t.column("side").to_numpy()
            within = t.column("lo").to_numpy()[edges[:-1]] == t.column("hi").to_numpy()[edges[:-1]]
            sizes = np.diff(edges)
            small = within & (sizes <= SMALL)
            group = np.repeat(np.arange(len(sizes)), sizes)
            i = np.flatnonzero(small[group])
            found = [(i[a], i[b]) for a, b in near_pairs(values[i], group[i], radius)]
            for g in np.flatnonzero(~small):
                s, e = edges[g], edges[g + 1]
                links = np.array([*near_links(values[s:e], side[s:e], bool(within[g]), radius)], np.int64).reshape(-1, 2)
                found.append((s + links[:, 0], s + links[:, 1]))
            u, v = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
            u, v = values[u].view(np.int64), values[v].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    return map_batches(dealt, run, "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4, blocks: int = 6
) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Fingerprints of at most ``radius`` differing bits are linked; ``component_id`` is the smallest
    id that links reach, the row itself included. Copies share a fingerprint and are compared once.
    ``blocks`` trades shuffled rows (``C(blocks, radius)`` per fingerprint) for shorter
    buckets and never changes the result: 6 suits up to about 10^8 distinct texts, 8 beyond.

    A null text counts as empty; a text without words has fingerprint zero and is linked like any
    other. Repeated rows give repeated rows. Rows without id keep their fingerprint and get the id
    of their component. No rows give no rows.
    """
    prints = with_fingerprint(docs, text, width, "_fp", keep=[id_col])
    prints = written(prints.select(F.col(id_col).alias("id"), "_fp"), "fingerprints")
    firsts = prints.groupBy("_fp").agg(F.min("id").alias("first"))
    found = connected_components(fingerprint_links(firsts, "_fp", radius, blocks))
    labelled = written(
        firsts.join(found.withColumnRenamed("node", "_fp"), "_fp", "left").select(
            "_fp", "first", F.coalesce("root", "_fp").alias("root")
        ),
        "roots",
    )
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = labelled.join(smallest, "root").select("_fp", "component_id")
    digits = F.lower(F.lpad(F.hex("_fp"), 16, "0"))
    return prints.join(of_print, "_fp").select(F.col("id").alias(id_col), digits.alias("fingerprint"), "component_id")
