"""Best-fit packing of tokenized documents into sequences, by rounds over growing groups of bins."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from reviewlens.llm.common import map_batches, written

#: The split of a text before the merges, as the tokenizer file's byte-level step does it. Fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A run of white space that ``tiktoken`` may not split: at 1,000,000 its search runs out of stack. Fixed value.
LONG_SPACE = r"(?<!\s)\s{100000}"
#: Items that one task packs at once.
GROUP = 1 << 16


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str):
    """The byte-level BPE of a tokenizer file as a ``tiktoken`` encoding, kept for the process's life.

    It gives the ids of the file's own library several times as fast. That library ranks merges by
    their order in the file, this one by the id of the result; a file where these differ is refused.
    So is one with added tokens that take in their surroundings or begin each other.
    """
    import tiktoken
    from tiktoken import registry

    if path not in registry.ENCODINGS:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, added = content["model"], content.get("added_tokens") or []
        names = sorted(t["content"] for t in added)
        flags = [t["content"] for t in added if t["lstrip"] or t["rstrip"] or t["single_word"]]
        if flags or any(b.startswith(a) for a, b in zip(names, names[1:], strict=False)):
            raise ValueError(f"{path}: added tokens are no plain strings")
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        results = [model["vocab"][a + b] for a, b in merges]
        singles = [model["vocab"][c] for c in byte_of]
        if results != sorted(results) or max(singles) > min(results, default=len(singles)):
            raise ValueError(f"{path}: ids do not follow the order of the merges")
        parts = [*byte_of, *(a + b for a, b in merges)]
        ranks = {bytes(byte_of[c] for c in p): model["vocab"][p] for p in parts}
        special = {t["content"]: t["id"] for t in added}
        registry.ENCODINGS[path] = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
    return registry.ENCODINGS[path]


def token_ids(path: str) -> Callable[[str], np.ndarray]:
    """What the library of a tokenizer file gives for a text without ``add_special_tokens``.

    The file's added tokens are found in the text. White space beyond ``LONG_SPACE`` goes to the
    library itself.
    """
    fast, library = encoder(path), []

    def ids(text: str) -> np.ndarray:
        if len(text) < 100_000 or not re.search(LONG_SPACE, text):
            return fast.encode_to_numpy(text, allowed_special="all", disallowed_special=())
        if not library:
            from tokenizers import Tokenizer

            library.append(Tokenizer.from_file(path))
        return np.array(library[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return ids


def piece_rows(
    docs: DataFrame, id_col: str, text: str, size: int, end_id: int, path: str, with_ids: bool
) -> DataFrame:
    """The pieces of each row's token ids: ``id_col, piece, start, length, ids_crc32`` (and ``ids``)."""
    fields = [
        *(f for f in docs.schema.fields if f.name == id_col),
        StructField("piece", IntegerType()),
        *(StructField(name, LongType()) for name in ("start", "length", "ids_crc32")),
        *[StructField("ids", ArrayType(IntegerType()))] * with_ids,
    ]
    names = [f.name for f in fields]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids

    def cut(own: np.ndarray) -> Iterator[tuple]:
        ids = np.append(own, end_id).astype("<u4")
        n = len(ids)
        edges = [0, *range(n % size or size, n + 1, size)]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            yield (k, a, b - a, zlib.crc32(ids[a:b].tobytes()), *[ids[a:b]] * with_ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = token_ids(path)
        for batch in batches:
            found = [(i, *row) for i, text in enumerate(batch.column(1).to_pylist()) for row in cut(ids(text or ""))]
            if found:
                at, *columns = zip(*found, strict=True)
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *arrays], names=names)

    return map_batches(docs.select(id_col, text), run, StructType(fields))


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each item's bin and offset, and each bin's fill.

    Open bins are kept by their room; a bit mask of the rooms in use finds the least that fits.
    """
    bin_of, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, fill = 0, []
    for i in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[i])
        fits = used >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                used ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bin_of[i], offset[i] = b, fill[b]
        fill[b] += n
        by_room[room - n].append(b)
        used |= 1 << room - n
    return bin_of, offset, np.array(fill, np.int64)


PLACES = "item bigint, bin bigint, offset bigint, fill bigint"


def placed(items: DataFrame, groups: int, capacity: int) -> DataFrame:
    """``items`` (``item``, ``length``) packed within ``groups`` groups; a bin is named by its first item."""

    def pack(table: pa.Table) -> pa.RecordBatch:
        item, length = table.column("item").to_numpy(), table.column("length").to_numpy()
        bin_of, offset, fill = best_fit(length, capacity)
        first = np.flatnonzero(offset == 0)
        name = np.zeros(len(fill), np.int64)
        name[bin_of[first]] = item[first]
        columns = [pa.array(x) for x in (item, name[bin_of], offset, fill[bin_of])]
        return pa.RecordBatch.from_arrays(columns, names=["item", "bin", "offset", "fill"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= GROUP:
                yield pack(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield pack(pa.Table.from_batches(held))

    dealt = items.select("item", "length").repartition(groups, "item").sortWithinPartitions("item")
    return map_batches(dealt, run, PLACES)


def pack(items: DataFrame, capacity: int = 1024, group: int = GROUP) -> DataFrame:
    """``item, sequence_id, offset`` for ``items`` of distinct ``item`` and a ``length`` of 1 to ``capacity``.

    Round by round, groups of about ``group`` items are packed best-fit decreasing. Bins with little
    room left are done; the others are the next round's items, in fewer groups. The room that counts
    as little doubles each round, so the bins that go on shrink to one group, which ends the merge.
    Each round is a written table: a lost executor repeats no placement differently.
    """
    left = items.select("item", "length")
    rounds: list[DataFrame] = []
    room = 1
    while n := left.count():
        groups = -(-n // group)
        done = written(placed(left, groups, capacity), "packing")
        rounds.append(done)
        if groups == 1:
            break
        left = done.filter((F.col("offset") == 0) & (F.col("fill") < capacity - room))
        left = left.select(F.col("bin").alias("item"), F.col("fill").alias("length"))
        room *= 2
    if not rounds:
        return left.select("item", F.col("item").alias("sequence_id"), F.col("length").alias("offset"))
    found = rounds[0].select("item", F.col("bin").alias("sequence_id"), "offset")
    for later in rounds[1:]:
        step = later.select(F.col("item").alias("sequence_id"), F.col("bin"), F.col("offset").alias("more"))
        found = found.join(step, "sequence_id", "left").select(
            "item",
            F.coalesce("bin", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"),
        )
    return found


def packed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    size: int = 1024,
    end_id: int = 2,
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    A row's ids are its text's, by the tokenizer file ``path`` (its added tokens, like
    ``<|endoftext|>``, are one id wherever they stand), and ``end_id``. Rows of more than ``size`` ids are cut into pieces of ``size``, the first one
    shorter if need be. Whole pieces are sequences of their own; shorter ones are packed together.

    A null text counts as empty and is one piece, its end id. Rows with equal or null ids are
    packed row by row. Sequences are numbered arbitrarily and filled from 0 without gaps. No rows
    give no rows.
    """
    cut = piece_rows(docs, id_col, text, size, end_id, path or default_path(), with_ids)
    cut = written(cut.withColumn("item", F.monotonically_increasing_id()), "pieces")
    places = pack(cut.filter(F.col("length") < size), size)
    zero = F.lit(0).cast("bigint")
    return cut.join(places, "item", "left").select(
        *[c for c in cut.columns if c not in ("item", "ids")],
        F.coalesce("sequence_id", "item").alias("sequence_id"),
        F.coalesce("offset", zero).alias("offset"),
        *["ids"] * with_ids,
    )


def sequences(rows: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from rows of ``packed`` with ids; a sequence is bounded by its size."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
