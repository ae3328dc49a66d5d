"""Repeated substrings by a suffix array that is cut into cells at minimizers.

Every string of ``length`` bytes (a window) is filed under its minimizer, the least hash of its
``GRAM``-byte substrings. Equal windows have equal minimizers at equal offsets, so a match is found
where the suffixes that begin at one minimizer meet. The suffixes of a cell form an enhanced suffix
array; a stack scan of its common prefixes gives the tree of intervals, and within an interval the
members' left contexts, sorted, give what can be extended to the left and by whom.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.common import map_batches, sorted_by, text_or_empty, whole_groups, written

GRAM = 40
#: Window starts hashed at once; their positions fit the 16 low bits of a packed hash.
BLOCK = 60_000
#: Different segments that one cell compares (10 MB of bytes at most); beyond it, windows are
#: compared by their hashes.
CAP = 1 << 15


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``GRAM`` bytes, by doubling polynomial hashes."""
    codes = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)
    base = 0x9E3779B97F4A7C15
    power = {1: codes[data]}
    n = 1
    while 2 * n <= GRAM:
        h = power[n]
        power[2 * n] = h[: len(h) - n] * np.uint64(pow(base, n, 1 << 64)) + h[n:]
        n *= 2
    h, have = power[n], n
    for part in sorted((p for p in power if p < n), reverse=True):
        if have + part <= GRAM:
            tail = power[part][have : have + len(data) - have - part + 1]
            h = h[: len(tail)] * np.uint64(pow(base, part, 1 << 64)) + tail
            have += part
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        values = np.minimum(values[: len(values) - n], values[n:])
        n *= 2
    rest = width - n
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(data: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimizer: start, windows, minimizer's offset from the start, its hash.

    ``end`` holds for each byte where its text ends; windows that pass it do not exist. The leftmost
    of equal minimizers counts.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    hashes = gram_hashes(data)
    packed = (hashes & ~np.uint64(0xFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    at = (sliding_min(packed, length - GRAM + 1) & np.uint64(0xFFFF)).astype(np.int64)
    real = np.flatnonzero(np.arange(len(at)) + length <= end[: len(at)])
    if not len(real):
        return none, none, none, none
    new = np.append(True, (at[real[1:]] != at[real[:-1]]) | (np.diff(real) != 1))
    start = real[new]
    count = np.diff(np.append(np.flatnonzero(new), len(real)))
    return start, count, at[start] - start, hashes[at[start]].view(np.int64)


def text_blocks(offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Parts ``(text, from, to)`` of the texts, in blocks; a cut text overlaps itself by a window less one."""
    held, size = [], 0
    for row in range(len(offsets) - 1):
        a, b = int(offsets[row]), int(offsets[row + 1])
        while b - a >= length:
            to = min(b, a + BLOCK - size)
            if to - a >= length:
                held.append((row, a, to))
                size += to - a
                if to == b:
                    break
                a = to - length + 1
            yield held
            held, size = [], 0
    if held:
        yield held


SEGMENTS = "key bigint, content bigint, text_id bigint, loc bigint, run bigint"


def segment_rows(length: int):
    """Arrow rows of ``SEGMENTS`` for all segments of texts ``(text_id, data)``.

    ``content`` hashes the segment's bytes; ``loc`` packs its start, the minimizer's offset and the
    number of windows. Equal segments in a row, as in text of a short period, are one row that says
    how many they are (``run``).
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0).to_numpy(), batch.column(1)
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            whole = np.frombuffer(column.buffers()[2] or b"", np.uint8)
            view = memoryview(whole)
            for parts in text_blocks(offsets, length):
                if not parts:
                    continue
                row, a, b = (np.array(x, np.int64) for x in zip(*parts, strict=True))
                ends = np.cumsum(b - a)
                data = np.concatenate([whole[i:j] for _, i, j in parts])
                part = np.repeat(np.arange(len(parts)), b - a)
                start, count, anchor, key = segments(data, ends[part], length)
                of = part[start]
                absolute = start - (ends - (b - a))[of] + a[of]
                stops = absolute + count + (length - 1)
                content = np.fromiter(
                    (xxhash.xxh3_64_intdigest(view[i:j]) for i, j in zip(absolute, stops, strict=True)),
                    np.uint64, len(start),
                )
                again = (key[1:] == key[:-1]) & (content[1:] == content[:-1]) & (absolute[1:] == absolute[:-1] + count[:-1])
                first = np.flatnonzero(np.append(True, ~again)[: len(start)])
                run_length = np.diff(np.append(first, len(start)))
                loc = (absolute - offsets[row[of]].astype(np.int64)) << 16 | anchor << 8 | count
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[first]) for x in (key, content.view(np.int64), ids[row[of]], loc)]
                    + [pa.array(run_length)],
                    names=["key", "content", "text_id", "loc", "run"],
                )

    return run


def common_prefix(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    x, y = x[:n], y[:n]
    if x == y:
        return n
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(prefixes: list[int], n: int) -> Iterator[tuple[int, int, int]]:
    """``(lcp, first, end)`` of every interval of the array, by one scan with a stack.

    ``prefixes[i]`` is the common prefix of entries ``i - 1`` and ``i``.
    """
    stack: list[tuple[int, int]] = []
    for i in range(1, n + 1):
        lcp = prefixes[i] if i < n else 0
        first = i - 1
        while stack and stack[-1][0] > lcp:
            height, first = stack.pop()
            yield height, first, i
        if lcp and (not stack or stack[-1][0] < lcp):
            stack.append((lcp, first))


def cell_groups(
    pieces: list[bytes], anchors: list[int], length: int
) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats ``(back, ahead, pieces)`` of at least ``length`` bytes around the anchors.

    The members agree in ``back`` bytes before their anchor and ``ahead`` bytes from it on, and no
    further as a whole: an interval's members are split where their left contexts diverge, and a
    set that lies in one deeper interval is left to that one.
    """
    n = len(pieces)
    right = [p[a:] for p, a in zip(pieces, anchors, strict=True)]
    left = [p[:a][::-1] for p, a in zip(pieces, anchors, strict=True)]
    array = sorted(range(n), key=right.__getitem__)
    place = {m: i for i, m in enumerate(array)}
    prefixes = [0] + [common_prefix(right[array[i - 1]], right[array[i]]) for i in range(1, n)]
    for ahead, first, end in intervals(prefixes, n):
        members = sorted(array[first:end], key=left.__getitem__)
        shared = [0] + [common_prefix(left[x], left[y]) for x, y in zip(members, members[1:], strict=False)]
        groups = [*intervals(shared, len(members)), (0, 0, len(members))]
        for back, i, j in groups:
            if back + ahead < length:
                continue
            at = [place[m] for m in members[i:j]]
            if min(prefixes[min(at) + 1 : max(at) + 1]) == ahead:
                yield back, ahead, members[i:j]


def cell_repeats(pieces: list[bytes], anchors: list[int], length: int, every: bool) -> Iterator[tuple[int, int, int]]:
    """``(piece, first, last)`` of the repeats; unless ``every``, without those inside a longer one."""
    reach: list[set[tuple[int, int]]] = [set() for _ in pieces]
    for back, ahead, members in cell_groups(pieces, anchors, length):
        for m in members:
            reach[m].add((back, ahead))
    for m, (a, found) in enumerate(zip(anchors, reach, strict=True)):
        best = -1
        for back, ahead in sorted(found, key=lambda x: (-x[1], -x[0])):
            if every or back > best:
                best = max(best, back)
                yield m, a - back, a + ahead


RANGES = "key bigint, content bigint, first bigint, last bigint, repeat bigint"


def compare_cells(length: int, every: bool):
    """Arrow rows of ``RANGES`` (byte range in the segment, hash of its bytes) from sorted segments with bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, edges in whole_groups(batches, ["key"], 1 << 13):
            key, content, loc = (t.column(c).to_numpy() for c in ("key", "content", "loc"))
            pieces = t.column("piece").to_pylist()
            rows: list[tuple[int, int, int, int]] = []
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                anchors = [int(x) >> 8 & 0xFF for x in loc[s:e]]
                for i, a, b in cell_repeats(pieces[s:e], anchors, length, every):
                    rows.append((s + i, a, b, xxhash.xxh3_64_intdigest(pieces[s + i][a:b]) - (1 << 63)))
            i, a, b, h = np.array(rows, np.int64).reshape(-1, 4).T
            columns = [pa.array(x) for x in (key[i], content[i], a, b, h)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "content", "first", "last", "repeat"])

    return run


def window_hashes(length: int):
    """Arrow rows ``key, content, window, at``: the hash of each window of each segment."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, content, piece in zip(*(batch.column(c).to_pylist() for c in ("key", "content", "piece")), strict=True):
                view = memoryview(piece)
                rows += [(key, content, xxhash.xxh3_64_intdigest(view[i : i + length]), i) for i in range(len(piece) - length + 1)]
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            types = [pa.int64(), pa.int64(), pa.uint64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
            arrays[2] = arrays[2].view(pa.int64())
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "content", "window", "at"])

    return run


def other_windows(length: int):
    """Arrow rows of ``RANGES``: runs of the windows of ``piece`` whose numbers are not in ``single``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, content, piece, single in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                alone = set(single or ())
                again = [(i, i + length) for i in range(len(piece) - length + 1) if i not in alone]
                for a, b in merged(again):
                    rows.append((key, content, a, b, xxhash.xxh3_64_intdigest(piece[a:b]) - (1 << 63)))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(columns, names=["key", "content", "first", "last", "repeat"])

    return run


def piece_of(length: int) -> Column:
    start, windows = F.shiftright("loc", 16), F.col("loc").bitwiseAND(F.lit(0xFF))
    return F.substring(F.col("data"), (start + 1).cast("int"), (windows + length - 1).cast("int"))


def text_key(text: str = "text") -> Column:
    """The 64-bit identity of a text; null counts as empty."""
    return F.xxhash64(text_or_empty(text))


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``text_id, data`` (UTF-8 bytes) of each different text; copies are combined before the shuffle."""
    rows = docs.select(text_key(text).alias("text_id"), text_or_empty(text).alias("_t"))
    return rows.groupBy("text_id").agg(F.max("_t").cast("binary").alias("data"))


def repeat_spans(texts: DataFrame, length: int = 200, cap: int = CAP, every: bool = False) -> DataFrame:
    """``text_id, first, last, repeat``: repeated byte ranges over different texts ``(text_id, data)``.

    Together the rows cover exactly the bytes that lie in a string of ``length`` bytes which also
    starts elsewhere in these texts. ``repeat`` identifies the repeated string. With ``every``, each
    maximal repeat (within its minimizer's windows) is listed with all its occurrences; else a range
    inside a longer one of the same segment is left out. In a cell beyond ``cap``, ranges are runs
    of repeated windows.

    Segments are shuffled as four numbers. A minimizer that occurs once ends there. Where all
    segments of a minimizer have the same bytes, they repeat as a whole and no text is read. Only
    the different segments of the other minimizers are read, each once, and compared in the cell of
    their minimizer; beyond ``cap`` of them, their windows are counted by hashes instead, which a
    shuffle spreads over all tasks, and those that occur once are taken away. A hash of a text or of a segment stands for its bytes (64 bits
    each, the segment's beside the 64 of its minimizer).
    """
    if not GRAM < length < GRAM + 255:
        raise ValueError(f"length must be over {GRAM} and under {GRAM + 255}")
    found = map_batches(texts, segment_rows(length), SEGMENTS)
    keys = found.groupBy("key").agg(
        F.sum("run").alias("n"), F.min("content").alias("least"), F.max("content").alias("most")
    )
    shared = found.join(keys.filter("n > 1"), "key")
    shared = written(shared.select("key", "content", "text_id", "loc", "run", F.expr("least <> most").alias("mixed")), "segments")
    mixed = shared.filter("mixed").drop("mixed")
    one = mixed.groupBy("key", "content").agg(F.sum("run").alias("n"), F.min(F.struct("text_id", "loc")).alias("rep"))
    width = one.groupBy("key").agg(F.count("*").alias("width"))
    reps = one.join(width, "key").select("key", "content", "n", "width", "rep.text_id", "rep.loc")
    pieces = reps.join(texts, "text_id").select("key", "content", "n", "width", "loc", piece_of(length).alias("piece"))
    pieces = written(pieces, "pieces")

    cells = pieces.filter(F.col("width") <= cap).select("key", "content", "loc", "piece")
    compared = map_batches(sorted_by(cells, ["key"]), compare_cells(length, every), RANGES)
    large = pieces.filter(F.col("width") > cap).select("key", "content", "piece")
    windows = map_batches(large, window_hashes(length), "key bigint, content bigint, window bigint, at bigint")
    place = F.struct("content", "at")
    windows = windows.groupBy("key", "window").agg(F.min(place).alias("a"), F.max(place).alias("b"))
    single = windows.filter("a = b").groupBy("key", F.col("a.content").alias("content")).agg(F.collect_list("a.at").alias("single"))
    others = large.join(single, ["key", "content"], "left").select("key", "content", "piece", "single")
    hashed = map_batches(others, other_windows(length), RANGES)
    ranges = compared.union(hashed)

    start = F.shiftright("loc", 16)
    size = F.col("loc").bitwiseAND(F.lit(0xFF)) * F.col("run") + (length - 1)
    copied = mixed.join(pieces.filter("n > 1").select("key", "content"), ["key", "content"], "left_semi")
    same = shared.filter("NOT mixed").drop("mixed").unionByName(copied.select(*mixed.columns))
    whole = same.select("text_id", start.alias("first"), (start + size).alias("last"), F.col("content").alias("repeat"))
    inside = mixed.join(ranges, ["key", "content"]).select(
        "text_id", (start + F.col("first")).alias("first"), (start + F.col("last")).alias("last"), "repeat"
    )
    return whole.union(inside)


CUT = "text_id bigint, kept binary, n_removed bigint, n_spans bigint"


def cut_out(whole_chars: bool):
    """Arrow rows of ``CUT`` from ``text_id, data, firsts, lasts``; ranges may overlap."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, data, firsts, lasts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kept, at, removed, spans = [], 0, 0, 0
                for a, b in merged(sorted(zip(firsts, lasts, strict=True))):
                    if whole_chars:
                        while a < b and data[a] & 0xC0 == 0x80:
                            a += 1
                        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
                            b -= 1
                        if a == b:
                            continue
                    kept.append(data[at:a])
                    at, removed, spans = b, removed + b - a, spans + 1
                kept.append(data[at:])
                rows.append((key, b"".join(kept), removed, spans))
            if rows:
                types = [pa.int64(), pa.binary(), pa.int64(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["text_id", "kept", "n_removed", "n_spans"])

    return run


def merged(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Sorted ranges with overlapping and touching ones joined."""
    start = end = None
    for a, b in ranges:
        if end is not None and a <= end:
            end = max(end, b)
            continue
        if end is not None:
            yield start, end
        start, end = a, b
    if end is not None:
        yield start, end


def without_repeats(docs: DataFrame, text: str = "text", length: int = 200, whole_chars: bool = False) -> DataFrame:
    """``text_id, kept, n_removed, n_spans`` of each different text of ``docs`` that loses bytes.

    Each byte goes that a string of ``length`` bytes covers which also starts anywhere else, in the
    same row or another; strings are judged on the input and never cross rows. ``n_spans`` counts
    maximal removed runs. Rows of ``docs`` find their result by ``text_key``; texts without a row
    stay as they are. With ``whole_chars``, a removed run shrinks to whole UTF-8 characters.

    Null texts count as empty; texts shorter than ``length`` lose nothing. Texts that occur in
    several rows go as a whole if they have ``length`` bytes. No rows give no rows.
    """
    texts = distinct_texts(docs, text)
    spans = repeat_spans(texts, length)
    size = F.octet_length(text_or_empty(text)).cast("bigint")
    copied = docs.select(text_key(text).alias("text_id"), size.alias("last")).filter(F.col("last") >= length)
    copied = copied.groupBy("text_id", "last").agg(F.count("*").alias("n")).filter("n > 1")
    spans = spans.select("text_id", "first", "last").unionByName(
        copied.select("text_id", F.lit(0).cast("bigint").alias("first"), "last")
    )
    of_text = spans.groupBy("text_id").agg(F.collect_set(F.struct("first", "last")).alias("s"))
    rows = of_text.join(texts, "text_id").select("text_id", "data", F.col("s.first"), F.col("s.last"))
    return map_batches(rows, cut_out(whole_chars), CUT)
