"""SentencePiece encoding by forward search over a trie of words, and decoding."""

from __future__ import annotations

import gc
import hashlib
import re
import sys
import types
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)

from reviewlens.llm.common import map_batches

MARK = "▁"
#: A run of marks with what follows, or a line break, which no piece contains.
WORD = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
#: Words whose ids a worker keeps, and pairs of pieces whose fit it keeps.
KEPT_WORDS, KEPT_PAIRS = 400_000, 500_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A vocabulary, and the forward step that both kinds of model share.

    For every prefix of a word, the step finds the last piece of the prefix's best segmentation from
    those of shorter prefixes. With a unigram model, that is the piece with the best sum of scores.
    The longest of equals counts. A byte-pair model merges by score, so sums do not decide; but each prefix of its segmentation is
    the segmentation of that prefix, so exactly one last piece fits its predecessor: the one that
    merging the two alone would leave apart (at a word's beginning, the one that merging gives whole).
    """

    def __init__(self, scores: dict[str, float], unigram: bool):
        self.scores = scores
        self.last = self.last_by_score if unigram else self.last_by_merges
        self.unknown = min(scores.values(), default=0.0) - 10
        self.rank = {piece: -score for piece, score in scores.items()}
        #: All ends of pieces: a search for pieces that end somewhere stops at the first that is none.
        self.ends = {piece[i:] for piece in scores for i in range(len(piece))}
        self.fits: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Byte-pair segmentation: the best-scored neighbours are merged first, the leftmost of equals."""
        parts, rank = list(text), self.rank
        while True:
            best = at = None
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def apart(self, pair: tuple[str, str]) -> bool:
        if len(self.fits) >= KEPT_PAIRS:
            self.fits.clear()
        fit = self.fits[pair] = self.merged(pair[0] + pair[1]) == [p for p in pair if p]
        return fit

    def last_by_merges(self, word: str, end: int, states: list[tuple[str, float]]) -> tuple[str, float]:
        for begin in range(end - 1, -1, -1):
            piece = word[begin:end]
            if piece not in self.ends:
                break
            if piece in self.scores:
                pair = (states[begin][0], piece)
                fit = self.fits.get(pair)
                if fit or fit is None and self.apart(pair):
                    return piece, 0.0
        return word[end - 1 : end], 0.0

    def last_by_score(self, word: str, end: int, states: list[tuple[str, float]]) -> tuple[str, float]:
        best = (word[end - 1 : end], states[end - 1][1] + self.scores.get(word[end - 1], self.unknown))
        for begin in range(end - 2, -1, -1):
            piece = word[begin:end]
            if piece not in self.ends:
                break
            if piece in self.scores and states[begin][1] + self.scores[piece] >= best[1]:
                best = (piece, states[begin][1] + self.scores[piece])
        return best

    def segment(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """Each distinct word with its pieces.

        Sorted words are the trie's paths in depth-first order; the states (last piece, score) along
        the current path are kept, and a word takes up after the prefix that it shares with the one
        before.
        """
        path, states, last = "", [("", 0.0)], self.last
        for word in sorted(set(words)):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del states[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                states.append(last(word, end, states))
            path, pieces, end = word, [], len(word)
            while end:
                piece = states[end][0]
                pieces.append(piece)
                end -= len(piece)
            yield word, pieces[::-1]


class Codec:
    """Ids of texts and texts of ids under one model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(size)]
        special = lambda i: self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i)
        self.ids = {names[i]: i for i in range(size) if not special(i)}
        self.bytes = {int(names[i][3:-1], 16): i for i in range(size) if self.model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.names = names
        if any(MARK in n.lstrip(MARK) for n in self.ids):
            raise ValueError(f"{path}: a piece spans words")
        self.pieces = Pieces({n: self.model.get_score(i) for n, i in self.ids.items()}, unigram=not self.is_byte_pair())
        #: Neighbours inside any piece; between two others, no piece can reach over.
        self.inside = {n[i : i + 2] for n in self.ids for i in range(len(n) - 1)}
        self.words: dict[str, tuple[int, ...]] = {}
        self.parts: dict[str, tuple[int, ...]] = {}

    def is_byte_pair(self) -> bool:
        """Byte-pair models score pieces by falling whole numbers, the order of the merges."""
        scores = [self.model.get_score(i) for i in self.ids.values()]
        return all(s == int(s) for s in scores) and len(scores) > 1

    def number(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        if self.bytes:
            return [self.bytes[b] for b in piece.encode()]
        return [self.model.unk_id()]

    def cut(self, word: str) -> list[str]:
        """A word's parts, cut where no piece can reach over."""
        inside, begin, parts = self.inside, 0, []
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in inside:
                parts.append(word[begin:i])
                begin = i
        parts.append(word[begin:])
        return parts

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = [WORD.findall(self.model.normalize(t)) if t else [] for t in texts]
        if max(len(self.words), len(self.parts)) > KEPT_WORDS:
            self.words, self.parts = {}, {}
        fresh = {w: self.cut(w) for w in set(chain.from_iterable(split)) if w not in self.words}
        for part, pieces in self.pieces.segment(set(chain.from_iterable(fresh.values())) - self.parts.keys()):
            ids = [*map(self.ids.get, pieces)]
            self.parts[part] = tuple(ids if None not in ids else chain.from_iterable(map(self.number, pieces)))
        for word, parts in fresh.items():
            self.words[word] = tuple(chain.from_iterable(map(self.parts.__getitem__, parts)))
        return [list(chain.from_iterable(map(self.words.__getitem__, words))) for words in split]

    def decode(self, ids: list[int]) -> str:
        """The text: byte pieces in a row are UTF-8, marks are spaces, and the first one is left out."""
        out: list[bytes] = []
        for i in ids:
            out.append(bytes([self.byte_of[i]]) if i in self.byte_of else self.names[i].encode())
        text = b"".join(out).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def codec(path: str) -> Codec:
    """The codec of a file, one per worker process."""
    kept = sys.modules.setdefault("_piece_codecs", types.ModuleType("_piece_codecs")).__dict__
    if path not in kept:
        kept[path] = Codec(path)
    return kept[path]


def encoded(path: str, texts: list[str]) -> list[list[int]]:
    gc.disable()  # scans of all kept words would take as long as the segmentation
    try:
        return codec(path).encode(texts)
    finally:
        gc.enable()


def encode(docs: DataFrame, text: str = "text", out: str = "ids", path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the ids of ``text`` in column ``out``.

    The ids are those of the model's own library. Words are segmented once per batch, in the order
    of a trie, and whole texts are put together from them. A null or empty text has no ids; repeated
    rows get the same ids; a column named ``out`` is replaced.
    """
    path = path or default_path()
    stay = [c for c in (docs.columns if keep is None else keep) if c != out]
    schema = StructType([f for c in stay for f in docs.schema.fields if f.name == c] + [StructField(out, ArrayType(IntegerType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(len(stay)).to_pylist()]
            ids = pa.array(encoded(path, texts), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(stay)], ids], names=[*stay, out])

    return map_batches(docs.select(*stay, docs[text].alias("_text")), run, schema)


def decode(rows: DataFrame, ids: str = "ids", out: str = "text", path: str | None = None) -> DataFrame:
    """``rows`` with the text of column ``ids`` in column ``out``; null ids give an empty text."""
    path = path or default_path()
    stay = [c for c in rows.columns if c != out]
    schema = StructType([f for c in stay for f in rows.schema.fields if f.name == c] + [StructField(out, StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [codec(path).decode(i or []) for i in batch.column(len(stay)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(stay)], pa.array(texts, pa.string())], names=[*stay, out])

    return map_batches(rows.select(*stay, rows[ids].alias("_ids")), run, schema)


def round_trips(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``id_col, n_ids, ids_crc32, decoded_sha256, same``: each text's ids and what they decode to.

    ``ids_crc32`` is over little-endian unsigned 32-bit ids. ``same`` is false for texts that hold
    the mark itself, which decodes to a space. A null text counts as empty.
    """
    path = path or default_path()
    fields = [f for f in docs.schema.fields if f.name == id_col] + [
        StructField("n_ids", LongType()),
        StructField("ids_crc32", LongType()),
        StructField("decoded_sha256", StringType()),
        StructField("same", BooleanType()),
    ]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [t or "" for t in batch.column(1).to_pylist()]
            own = encoded(path, given)
            back = [codec(path).decode(i) for i in own]
            columns = [
                pa.array([len(i) for i in own], pa.int64()),
                pa.array([zlib.crc32(np.array(i, "<u4").tobytes()) for i in own], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()),
                pa.array([t == g for t, g in zip(back, given, strict=True)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[f.name for f in fields])

    return map_batches(docs.select(id_col, text), run, StructType(fields))
