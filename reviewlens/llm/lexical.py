"""Ranked lexical search by a dual tree: bounds of item nodes against document nodes prune whole batches."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.llm.common import map_batches, written

#: A-Z in lower case; ASCII bytes that are neither digits nor letters separate terms.
FOLD = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Bits of the filter over item terms, documents of a shard, items of a block, children of a node, documents of a leaf.
FILTER_BITS, SHARD, BLOCK, FAN, LEAF = 20, 16_384, 8_192, 8, 32
#: Terms whose hash a worker remembers.
REMEMBERED = 1 << 20


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def term_hash(term: bytes) -> int:
    """A signed 64-bit number for a term."""
    value = xxhash.xxh3_64_intdigest(term)
    return value - (value >> 63 << 64)


def counted_terms(rows: DataFrame, out: str, bitmap: bytes | None = None) -> DataFrame:
    """``rows`` (whose last column is a text as binary) with ``n`` and arrays ``terms, tf`` in its place.

    ``n`` counts all terms, repeats included. With a bitmap of hash slots, terms outside it are left
    out of the arrays; it is 128 KB, however many terms it was made from.
    """
    kept = rows.columns[:-1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int | None] = {}
        slots = None if bitmap is None else np.unpackbits(np.frombuffer(bitmap, np.uint8)).tobytes()

        def known(term: bytes) -> int | None:
            value = term_hash(term)
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen[term] = value = value if slots is None or slots[slot(value)] else None
            return value

        for batch in batches:
            n, start, terms, tf = [], [0], [], []
            for text in batch.column(len(kept)).to_pylist():
                own = terms_of(text)
                n.append(len(own))
                for term, times in Counter(own).items():
                    value = seen[term] if term in seen else known(term)
                    if value is not None:
                        terms.append(value)
                        tf.append(times)
                start.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(v, pa.int64())) for v in (terms, tf)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n, pa.int64()), *lists], names=[*kept, "n", "terms", "tf"]
            )

    return map_batches(rows, run, out)


def slot(value: int) -> int:
    return (value >> 7) & ((1 << FILTER_BITS) - 1)


def slot_column(term: Column) -> Column:
    return F.shiftright(term, 7).bitwiseAND((1 << FILTER_BITS) - 1)


def ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one after the other, and where each range begins among them."""
    size = end - start
    first = np.cumsum(size) - size
    return np.arange(size.sum()) + np.repeat(start - first, size), first


class Vectors:
    """Sparse rows of whole numbers: row ``i`` has ``value`` at ``term`` for the places start[i]..start[i+1]."""

    def __init__(self, start: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.start, self.term, self.value = start, term, value

    def __len__(self) -> int:
        return len(self.start) - 1

    def ordered(self, order: np.ndarray) -> Vectors:
        at, _ = ranges(self.start[order], self.start[order + 1])
        size = (self.start[1:] - self.start[:-1])[order]
        return Vectors(np.append(0, np.cumsum(size)), self.term[at], self.value[at])

    def leaders(self) -> np.ndarray:
        """The term of the largest value of each row (the smaller term of equal ones), then the second's: similar rows sort together."""
        row = np.repeat(np.arange(len(self)), np.diff(self.start))
        by = np.lexsort((self.term, -self.value, row))
        filled = np.diff(self.start)
        lead = np.full((2, len(self)), -1, np.int64)
        for i in range(2):
            has = filled > i
            lead[i, has] = self.term[by[self.start[:-1][has] + i]]
        return np.lexsort((lead[1], lead[0]))

    def maxima(self, fan: int) -> Vectors:
        """The coordinate maxima of each ``fan`` rows in a row."""
        group = np.repeat(np.arange(len(self)) // fan, np.diff(self.start))
        by = np.lexsort((self.term, group))
        group, term, value = group[by], self.term[by], self.value[by]
        new = np.append(True, (group[1:] != group[:-1]) | (term[1:] != term[:-1]))[: len(term)]
        at = np.flatnonzero(new)
        most = np.maximum.reduceat(value, at) if len(at) else value
        nodes = -(-len(self) // fan)
        return Vectors(np.searchsorted(group[at], np.arange(nodes + 1)), term[at], most)


def hierarchy(rows: Vectors, fan: int) -> list[Vectors]:
    """The rows, then the maxima of each ``fan`` of them, and so on up to one node."""
    levels = [rows]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].maxima(fan))
    return levels


class Items:
    """The items of a block as a tree, with the best documents found for each so far.

    A node's bound is the weakest k-th score among its items: a batch of documents that reaches it
    for none of the node's coordinates cannot change any of their answers.
    """

    def __init__(self, weights: Vectors, least: np.ndarray, k: int):
        self.order = weights.leaders()
        self.levels = hierarchy(weights.ordered(self.order), FAN)
        self.k = k
        self.least = least[self.order]  # a score that the k-th best is known to reach
        self.score = np.zeros((len(weights), k), np.int64)
        self.doc = np.full((len(weights), k), np.iinfo(np.int64).max)
        self.pairs = 0
        self._refresh()

    def _refresh(self) -> None:
        self.weakest = [np.maximum(self.least, self.score.min(axis=1))]
        for _ in self.levels[1:]:
            below = self.weakest[-1]
            self.weakest.append(np.minimum.reduceat(below, np.arange(0, len(below), FAN)))

    def bounds(self, level: int, nodes: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Of each node, the sum over its terms of its value times that of ``dense``: no score inside is higher."""
        rows = self.levels[level]
        at, first = ranges(rows.start[nodes], rows.start[nodes + 1])
        out = np.zeros(len(nodes), np.int64)
        full = rows.start[nodes + 1] > rows.start[nodes]
        if len(at):
            out[full] = np.add.reduceat(rows.value[at] * dense[rows.term[at]], first[full])
        self.pairs += len(nodes)
        return out

    def reached(self, level: int, nodes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The nodes for which documents with such bounds may matter; equal scores may win by id."""
        return (bounds > 0) & (bounds >= self.weakest[level][nodes])

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        below = nodes[:, None] * FAN + np.arange(FAN)
        return below[below < len(self.levels[level - 1])]

    def offer(self, items: np.ndarray, scores: np.ndarray, docs: np.ndarray) -> None:
        """Take in the exact scores (items x documents) of a leaf."""
        worst = np.maximum(self.least[items], self.score[items].min(axis=1))
        hit = (scores > 0) & (scores >= worst[:, None])
        for i in np.flatnonzero(hit.any(axis=1)):
            own = hit[i]
            score = np.append(self.score[items[i]], scores[i, own])
            doc = np.append(self.doc[items[i]], docs[own])
            first = np.lexsort((doc, -score))[: self.k]
            self.score[items[i]], self.doc[items[i]] = score[first], doc[first]
        self._refresh()


def search(items: Items, docs: Vectors, ids: np.ndarray, n_terms: int) -> None:
    """Offer ``items`` every document that the bounds do not rule out.

    Both trees are descended together, depth first. A document node carries the item nodes that its
    parent could not rule out; each is opened level by level as long as its bound reaches its
    weakest k-th score. Of sibling document nodes the one with the highest bound comes first.
    """
    if not len(docs) or not len(items.order):
        return
    order = docs.leaders()
    rows, ids = docs.ordered(order), ids[order]
    levels = [rows, *hierarchy(rows.maxima(LEAF), FAN)]  # leaves of LEAF documents, then FAN children each
    dense = np.zeros(n_terms, np.int64)
    top = len(items.levels) - 1

    def against(level: int, node: int, frontier: list[tuple[int, np.ndarray]]) -> tuple[int, list[tuple[int, np.ndarray]]]:
        """The item nodes that a document node may matter to, one level further down, and the best bound."""
        rows = levels[level]
        own = slice(rows.start[node], rows.start[node + 1])
        dense[rows.term[own]] = rows.value[own]
        best, left = 0, []
        for at, nodes in frontier:
            bound = items.bounds(at, nodes, dense)
            ok = items.reached(at, nodes, bound)
            if ok.any():
                best = max(best, int(bound[ok].max()))
                left.append((at - 1, items.children(at, nodes[ok])) if at else (0, nodes[ok]))
        dense[rows.term[own]] = 0
        return best, left

    def leaf(node: int, frontier: list[tuple[int, np.ndarray]]) -> None:
        while frontier and any(at for at, _ in frontier):
            _, frontier = against(1, node, frontier)
        _, frontier = against(1, node, frontier)
        if not frontier:
            return
        chosen = np.concatenate([nodes for _, nodes in frontier])
        rows = levels[0]
        docs_in = np.arange(node * LEAF, min((node + 1) * LEAF, len(rows)))
        at, _ = ranges(rows.start[docs_in], rows.start[docs_in + 1])
        local, place = np.unique(rows.term[at], return_inverse=True)
        impact = np.zeros((len(local), len(docs_in)), np.int64)
        impact[place, np.repeat(np.arange(len(docs_in)), rows.start[docs_in + 1] - rows.start[docs_in])] = rows.value[at]
        dense[local] = np.arange(1, len(local) + 1)
        mine = items.levels[0]
        entry, _ = ranges(mine.start[chosen], mine.start[chosen + 1])
        of = np.repeat(np.arange(len(chosen)), mine.start[chosen + 1] - mine.start[chosen])
        row = dense[mine.term[entry]]
        dense[local] = 0
        held = row > 0
        scores = np.zeros((len(chosen), len(docs_in)), np.int64)
        of, part = of[held], mine.value[entry[held]][:, None] * impact[row[held] - 1]
        begin = np.flatnonzero(np.append(True, of[1:] != of[:-1])[: len(of)])
        if len(begin):
            scores[of[begin]] = np.add.reduceat(part, begin, axis=0)
        items.offer(chosen, scores, ids[docs_in])

    def visit(level: int, node: int, frontier: list[tuple[int, np.ndarray]]) -> None:
        if level == 1:
            leaf(node, frontier)
            return
        below = range(node * FAN, min((node + 1) * FAN, len(levels[level - 1])))
        found = [(child, *against(level - 1, child, frontier)) for child in below]
        for child, _, left in sorted(found, key=lambda f: -f[1]):
            if left:
                visit(level - 1, child, left)

    _, start = against(len(levels) - 1, 0, [(top, np.arange(len(items.levels[top])))])
    if start:
        visit(len(levels) - 1, 0, start)


def run_cells(n_k: int):
    """Arrow rows ``item, score, doc`` from cells of items (``kind`` 0) followed by documents (``kind`` 1)."""

    def pack(rows: list[tuple[np.ndarray, np.ndarray]], number: dict[int, int], grow: bool) -> Vectors:
        start, term, value = [0], [], []
        for terms, values in rows:
            if grow:
                own = [number.setdefault(t, len(number)) for t in terms.tolist()]
                keep = np.ones(len(own), bool)
            else:
                own = [number.get(t, -1) for t in terms.tolist()]
                keep = np.array(own, np.int64) >= 0
            term.append(np.array(own, np.int64)[keep])
            value.append(values[keep])
            start.append(start[-1] + int(keep.sum()))
        empty = np.zeros(0, np.int64)
        return Vectors(np.array(start), np.concatenate([empty, *term]), np.concatenate([empty, *value]))

    def answers(asked: list, held: list) -> pa.RecordBatch | None:
        number: dict[int, int] = {}
        weights = pack([a[2:] for a in asked], number, True)
        items = Items(weights, np.array([a[1] for a in asked], np.int64), n_k)
        docs = pack([h[1:] for h in held], number, False)
        search(items, docs, np.array([h[0] for h in held], np.int64), len(number))
        found = items.score > 0
        item = np.array([a[0] for a in asked], np.int64)[items.order]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(item, found.sum(axis=1))), pa.array(items.score[found]), pa.array(items.doc[found])],
            names=["item", "score", "doc"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, asked, held = None, [], []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "kind", "ref", "least")), strict=True)
            terms, values = batch.column("terms"), batch.column("weights")
            for i, (shard, block, kind, ref, least) in enumerate(keys):
                if place != (shard, block):
                    if asked and held:
                        yield answers(asked, held)
                    place, asked, held = (shard, block), [], []
                own = terms[i].values.to_numpy(), values[i].values.to_numpy()
                if kind == 0:
                    asked.append((ref, least, *own))
                elif asked:
                    held.append((ref, *own))
        if asked and held:
            yield answers(asked, held)

    return run


def search_items(
    items: DataFrame, docs: DataFrame, item_col: str = "item_id", id_col: str = "doc_id", text: str = "text", k: int = 10,
    shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """``item_col, rank, id_col, score``: the ``k`` rows of ``docs`` with the highest score for each item.

    Terms are the runs of digits, letters and characters beyond ASCII, A-Z in lower case. With N rows
    that have a term, L terms in all, n in a row, df the rows with a term and tf its times in the
    row: w = floor(1000*ln((2N+2)/(2df+1))), m = 25 + 75nN div L, and a row scores the sum over the
    item's terms, repeats included, of w*(1000000000*tf div (1000*tf+8m)). Only scores above 0 rank;
    equal ones by id. All but w is exact 64-bit arithmetic.

    One pass counts terms; only those that items may hold stay, by a bitmap of fixed size. Rows are
    dealt to shards of about ``shard`` by a hash and items to blocks of about ``block``; a task has
    one shard and one block as trees of coordinate maxima. The first shard is searched before the
    others, and its k-th scores are what they must reach.

    Null texts and texts without terms are never found, and such items find nothing. Repeated rows
    are found as often as they occur; an item repeated with its text is asked once, one id with two
    texts is two items. A null id of an item stays null; rows without id are not found, though they
    count. No rows give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t")).distinct()
    id_type = asked.schema["id"].dataType.simpleString()
    asked = asked.select("id", F.monotonically_increasing_id().alias("item"), "t")
    arrays = "n bigint, terms array<bigint>, tf array<bigint>"
    asked = written(counted_terms(asked, f"id {id_type}, item bigint, {arrays}"), "items").filter("n > 0")
    item_terms = asked.select("id", "item", F.explode(F.arrays_zip("terms", "tf")).alias("e"))
    item_terms = item_terms.select("id", "item", F.col("e.terms").alias("term"), F.col("e.tf").alias("times"))

    # At most one number per slot of the bitmap comes to the driver.
    bitmap = np.zeros(1 << FILTER_BITS, bool)
    for row in item_terms.select(slot_column(F.col("term")).alias("slot")).distinct().toLocalIterator():
        bitmap[row["slot"]] = True
    given = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.xxhash64(id_col, text).alias("h"), F.col(text).cast("binary").alias("t")
    )
    counted = written(counted_terms(given, f"id bigint, h bigint, {arrays}", np.packbits(bitmap).tobytes()), "counted")
    total = counted.filter("n > 0").agg(F.count("*").alias("rows"), F.sum("n").alias("terms"), F.sum(F.signum(F.size("terms"))).alias("hits"))
    rows_n, terms_n, hits = total.first()
    empty = spark.createDataFrame([], f"id {id_type}, rank int, doc bigint, score bigint")
    named = [F.col("id").alias(item_col), "rank", F.col("doc").alias(id_col), "score"]
    if not hits:
        return empty.select(*named)

    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2 * rows_n + 2) / (2 * F.col("df") + 1)).cast("double")))
    weighed = item_terms.join(df, "term").select("id", "item", "term", (F.col("times") * weight).alias("weight"))
    asked = weighed.filter("weight > 0").groupBy("id", "item").agg(F.collect_list(F.struct("term", "weight")).alias("e"))
    asked = written(asked.select("id", "item", F.col("e.term").alias("terms"), F.col("e.weight").alias("weights")), "asked")

    m = F.lit(25) + F.expr(f"(75 * n * {rows_n}L) div {terms_n}L")
    impact = F.transform("tf", lambda x: F.call_function("div", 1_000_000_000 * x, 1000 * x + 8 * F.col("m")))
    shards = max(1, -(-int(hits) // shard))
    stored = counted.filter("size(terms) > 0 AND id IS NOT NULL").withColumn("m", m).select(
        F.pmod(F.col("h"), F.lit(shards)).cast("int").alias("shard"), F.col("id").alias("ref"), "terms", impact.alias("weights")
    )
    blocks = max(1, -(-asked.count() // block))
    every = lambda n, first=0: F.explode(F.sequence(F.lit(first), F.lit(n - 1)))
    dealt_items = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))

    def searched(items_: DataFrame, docs_: DataFrame) -> DataFrame:
        cell = ["shard", "block"]
        columns = [*cell, "kind", "ref", "least", "terms", "weights"]
        heads = items_.withColumns({"kind": F.lit(0), "ref": F.col("item")}).select(*columns)
        below = docs_.withColumns({"block": every(blocks), "kind": F.lit(1), "least": F.lit(0).cast("bigint")}).select(*columns)
        cells = heads.unionByName(below).repartition(*cell).sortWithinPartitions(*cell, "kind")
        return written(map_batches(cells, run_cells(k), "item bigint, score bigint, doc bigint"), "found")

    first = searched(
        dealt_items.withColumns({"shard": F.lit(0), "least": F.lit(0).cast("bigint")}), stored.filter("shard = 0")
    )
    found = first
    if shards > 1:
        kth = first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k)
        reach = dealt_items.join(kth.select("item", "least"), "item", "left").fillna(0, ["least"])
        found = first.unionByName(searched(reach.withColumn("shard", every(shards, 1)), stored.filter("shard > 0")))
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("id", "item"), "item").select(*named)
