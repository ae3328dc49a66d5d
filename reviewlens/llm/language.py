"""Language identification by a string kernel: n-gram presence, Nyström landmarks, kernel ridge."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, DoubleType, StringType, StructField

from reviewlens.llm.common import add_columns

#: n-gram lengths in bytes, slots that n-grams are hashed to, texts per matrix, bytes hashed at once.
ORDERS, SLOTS, ROWS, BLOCK = (1, 2, 3, 4), 1 << 14, 128, 1 << 18
#: Letters fold to lower case; other ASCII characters all count as one break.
FOLD = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: Parts that the labelled rows of a language are thinned in.
PARTS = 32
UNDETERMINED = "und"


@dataclass(frozen=True)
class Model:
    """``weights`` maps the presence of each slot to a score per language; empty if nothing was learned."""

    langs: tuple[str, ...]
    weights: np.ndarray


def blocks(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Folded bytes and the text that each belongs to, in blocks; a cut text overlaps itself."""
    held, size = [], 0
    step = BLOCK - max(ORDERS) + 1
    for row, text in enumerate(texts):
        text = (text or b"").translate(FOLD)
        for at in range(0, max(len(text) - max(ORDERS) + 1, 1), step):
            held.append((row, text[at : at + BLOCK]))
            size += len(held[-1][1])
            if size >= BLOCK:
                yield joined(held)
                held, size = [], 0
    if held:
        yield joined(held)


def joined(parts: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(p for _, p in parts), np.uint8)
    return data, np.repeat([r for r, _ in parts], [len(p) for _, p in parts])


def presence(texts: list[bytes | None]) -> np.ndarray:
    """Texts x slots: 1 where a text holds an n-gram of the slot, over all orders at once."""
    found = np.zeros((len(texts), SLOTS), np.uint8)
    flat = found.reshape(-1)
    for data, row in blocks(texts):
        base = row * SLOTS
        gram = np.zeros(len(data), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if len(data) < n:
                break
            gram = gram[: len(data) - n + 1] * np.uint32(257) + data[n - 1 :]
            if n in ORDERS:
                slot = (gram * np.uint32(2_654_435_769) ^ np.uint32(n * 0x9E37)) >> np.uint32(32 - 14)
                inside = row[n - 1 :] == row[: len(data) - n + 1]
                flat[(base[: len(slot)] + slot)[inside]] = 1
    return found


def picked(docs: DataFrame, per_lang: int, total: int) -> DataFrame:
    """``id, lang, text`` of at most ``per_lang`` labelled rows of each language and ``total`` in all, by a
    hash of the id. Rows are chosen by id, language and a hash of the text: equal ones count once, and
    rows that share an id are rows of their own."""
    labelled = docs.filter(F.col("id").isNotNull() & F.col("lang").isNotNull()).withColumn("h", F.xxhash64("text"))
    order = [F.xxhash64("id", F.lit(8)), F.col("id"), F.col("h")]
    ranked = labelled.select("id", "lang", "h").distinct().withColumn("part", F.pmod(F.xxhash64("id", "h"), F.lit(PARTS)))
    for group in (["lang", "part"], ["lang"]):  # a language is thinned in parts first, so no task meets all its rows
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
        ranked = ranked.filter(F.col("rank") <= per_lang)
    keys = ranked.orderBy("rank", *order).limit(total).select("id", "lang", "h").collect()  # ``total`` rows at most
    chosen = docs.sparkSession.createDataFrame(keys, labelled.select("id", "lang", "h").schema)
    return labelled.join(F.broadcast(chosen), ["id", "lang", "h"], "left_semi").dropDuplicates(["id", "lang", "h"])


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_lang: int = 300,
    max_rows: int = 4000,
    landmarks: int = 256,
    ridge: float = 0.1,
) -> Model:
    """Learn from a bounded sample: ``per_lang`` rows of each language, ``max_rows`` in all.

    The kernel of two texts is the number of n-gram slots that both hold, over the geometric mean
    of the numbers each holds. Landmarks (a part of the sample, languages alike) give Nyström
    features; ridge regression on them scores each language against the rest. As a score is linear
    in the kernel row, and that in the text's presence vector, the product of landmarks and weights
    is kept as one slots x languages matrix. The driver receives presence bits only (2 KB a row), of
    ``max_rows`` rows at most, however often rows or ids repeat.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    chosen = picked(named, per_lang, max_rows)

    def make(texts: list[bytes | None]) -> list[pa.Array]:
        return [pa.array([np.packbits(presence([t])[0]).tobytes() for t in texts], pa.binary())]

    rows = add_columns(chosen, "text", [StructField("_bits", BinaryType())], make, ["id", "lang"])
    sample = sorted({(r[0], r[1], bytes(r[2])) for r in rows.collect()})
    if not sample:
        return Model((), np.zeros((SLOTS, 0), np.float32))
    langs = tuple(sorted({r[1] for r in sample}))
    bits = np.stack([np.unpackbits(np.frombuffer(r[2], np.uint8)) for r in sample]).astype(np.float64)
    bits /= np.sqrt(np.maximum(bits.sum(axis=1, keepdims=True), 1))
    of_lang = np.array([langs.index(r[1]) for r in sample])
    turn = np.zeros(len(sample), np.int64)
    for k in range(len(langs)):
        turn[of_lang == k] = np.arange((of_lang == k).sum())
    marks = bits[np.lexsort((of_lang, turn))[:landmarks]]
    value, vector = np.linalg.eigh(marks @ marks.T)
    use = value > 1e-8 * value.max()
    whiten = vector[:, use] / np.sqrt(value[use])
    features = bits @ marks.T @ whiten
    share = np.bincount(of_lang)[of_lang]
    weight = (len(sample) / len(langs) / share)[:, None]
    target = np.eye(len(langs))[of_lang]
    gram = features.T @ (weight * features) + ridge * np.eye(features.shape[1])
    beta = np.linalg.solve(gram, features.T @ (weight * target))
    return Model(langs, (marks.T @ (whiten @ beta)).astype(np.float32))


def has_letter(text: bytes | None) -> bool:
    return text is not None and any(map(str.isalpha, text.decode("utf-8", "replace")))


def identify(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    keep: list[str] | None = None,
    pred: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """``docs`` with the language ``pred`` and its ``score`` (0 to 1), from whole texts alone.

    A text that is null or has no letter, or any text under an empty model, gets ``und`` with score
    0. Equal scores go to the first language by name. Rows are scored one by one, so repeated rows
    get the same answer; columns of the two names are replaced.
    """
    langs, weights = model.langs, model.weights

    def make(texts: list[bytes | None]) -> list[pa.Array]:
        lang, sure = [], []
        for at in range(0, len(texts), ROWS):
            part = texts[at : at + ROWS]
            if not langs:
                lang += [UNDETERMINED] * len(part)
                sure += [0.0] * len(part)
                continue
            held = presence(part).astype(np.float32)
            out = held @ weights / np.sqrt(np.maximum(held.sum(axis=1, keepdims=True), 1))
            best = out.argmax(axis=1)
            known = [has_letter(t) for t in part]
            lang += [langs[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
            top = np.clip(out[np.arange(len(part)), best], 0, 1)
            sure += [float(s) if k else 0.0 for s, k in zip(top, known, strict=True)]
        return [pa.array(lang, pa.string()), pa.array(sure, pa.float64())]

    fields = [StructField(pred, StringType()), StructField(score, DoubleType())]
    return add_columns(docs, text, fields, make, keep)


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is kept from learning; a row without id is."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))
