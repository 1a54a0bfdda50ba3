"""SentencePiece encoding and decoding by streaming Viterbi.

The best path is the one with the highest sum of piece scores; of equal sums the one whose last
piece is longest. A window runs along the text: every place keeps its best score and where its
last piece began. When the paths of all places that a further piece can start from have
met, what lies before is decided: its ids go out and the window moves on. Where no piece of the
vocabulary crosses a place, all paths meet, so words that come again need not be solved again.

The scores of a BPE model are merge ranks: there the best path is not what SentencePiece itself
gives. The model's own ids come from its merges (`Merges`), by a function of their own (`merged`).
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from accessaudit.llm.common import lean

SPACE = "▁"  # how pieces spell a space
OWN = "\ud800"  # stands for that character in a text; no text holds it
PENALTY = 10.0  # of a character without a piece, below the lowest score
MOST_WORDS, MOST_PARTS = 1 << 17, 1 << 19  # kept; the older half of the parts besides
LONG_WORD = 64
ROWS = 500  # of a batch given out
MISSING = object()


class Pieces(dict):
    """A vocabulary, and the ids (bytes of unsigned 32-bit numbers) of words seen before."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.byte = {}
        self.score, self.number, self.bytes = {}, {}, []
        for i in range(size):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(text[1:-1], 16)] = i
                self.bytes.append(bytes([int(text[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes.append(b"")
            else:
                self.score[text], self.number[text] = model.get_score(i), i
                self.bytes.append(text.replace(SPACE, " ").encode())
        if len(self.byte) != 256:
            raise ValueError("a vocabulary without byte pieces")
        self.longest = max(map(len, self.score))
        #: The score of every piece, and None for what some piece begins with.
        self.prefix = {text[:n]: None for text in self.score for n in range(1, len(text))} | self.score
        self.pairs = {text[i : i + 2] for text in self.score for i in range(len(text) - 1)}
        self.old: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.least = min(self.score.values()) - PENALTY
        #: A space begins a new word unless a piece reaches over it.
        self.splits = not any(SPACE in text.lstrip(SPACE) for text in self.score)

    def _ids(self, part: str) -> list[int]:
        known = self.number.get(part)
        if known is not None:
            return [known]
        return [self.byte[b] for b in (SPACE if part == OWN else part).encode()]

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of the best path, in order, as soon as they are decided."""
        find, longest, size = self.prefix.get, self.longest, len(text)
        base, best, back = 0, [0.0], [0]  # of the places from `base` on; None: not reached yet
        check = 2 * longest
        for start in range(size):
            here, end, stop = best[start - base], start + 1, min(size, start + longest)
            while len(best) <= stop - base:
                best.append(None)
                back.append(start)
            value = find(text[start:end], MISSING)
            if value is MISSING or value is None:  # the character has no piece of its own
                at = end - base
                if best[at] is None or here + self.least > best[at]:
                    best[at], back[at] = here + self.least, start
            while value is not MISSING:
                if value is not None:
                    at = end - base
                    known = best[at]
                    if known is None or here + value > known:  # an equal path came from further left
                        best[at], back[at] = here + value, start
                if end == stop:
                    break
                end += 1
                value = find(text[start:end], MISSING)
            if start + 1 - base >= check:
                met = self._meeting(base, best, back, start + 1)
                if met > base:
                    yield self._path(text, base, back, met)
                    drop = met - base
                    zero = best[drop]
                    best, back = [x if x is None else x - zero for x in best[drop:]], back[drop:]
                    base = met
                check = start + 1 - base + longest
        yield self._path(text, base, back, size)

    def _meeting(self, base: int, best: list, back: list[int], start: int) -> int:
        """The last place on the paths of all places reached from `start` on."""
        live = {base + i for i in range(start - base, len(best)) if best[i] is not None}
        while len(live) > 1:
            last = max(live)
            live.discard(last)
            live.add(max(base, back[last - base]))
        return live.pop()

    def _path(self, text: str, base: int, back: list[int], end: int) -> list[int]:
        parts = []
        while end > base:
            start = back[end - base]
            parts.append(text[start:end])
            end = start
        return [i for part in reversed(parts) for i in self._ids(part)]

    def _solved(self, text: str) -> bytes:
        """Ids of a text, part by part: between two characters that no piece has side by side, all paths meet."""
        pairs, low, out = self.pairs, 0, []
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in pairs:
                out.append(self._part(text[low:i]))
                low = i
        out.append(self._part(text[low:]))
        return b"".join(out)

    def _found(self, part: str) -> list[int]:
        return [i for ids in self.stream(part) for i in ids]

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.old.get(part)
            if ids is None:
                ids = np.array(self._found(part), "<u4").tobytes()
            if len(part) <= LONG_WORD:
                if len(self.parts) >= MOST_PARTS:  # parts that come again move on from the old half
                    self.old, self.parts = self.parts, {}
                self.parts[part] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self._solved(word if word[:1] == SPACE else SPACE + word)
        if len(word) <= LONG_WORD:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers; a space goes before the first word."""
        if not text:
            return b""
        if SPACE in text:
            text = text.replace(SPACE, OWN)
        if not self.splits:
            return self._solved(SPACE + text.replace(" ", SPACE))
        if text[0] != " " and text[-1] != " " and "  " not in text:
            return b"".join(map(self.__getitem__, text.split(" ")))
        return b"".join(map(self.__getitem__, re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))))

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become the replacement character."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")[1:]


class Merges(Pieces):
    """The ids SentencePiece gives for a BPE model: of all neighbours that make a piece the best merge first, equals from the left."""

    def _found(self, part: str) -> list[int]:
        score, size = self.score, len(part)
        known = self.number.get(part) if size == 1 else None
        if known is not None:
            return [known]
        ends, last = list(range(1, size + 1)), list(range(-1, size - 1))  # of the symbol that begins at a place; where the one before begins
        heap = [(-score[two], i, i + 2) for i in range(size - 1) if (two := part[i : i + 2]) in score]
        heapq.heapify(heap)
        while heap:
            _, start, end = heapq.heappop(heap)
            middle = ends[start]
            if not start < middle < end or ends[middle] != end:  # one of the two is merged already
                continue
            ends[start], ends[middle] = end, 0
            if end < size:
                last[end] = start
                both = part[start : ends[end]]
                if both in score:
                    heapq.heappush(heap, (-score[both], start, ends[end]))
            before = last[start]
            if before >= 0:
                both = part[before:end]
                if both in score:
                    heapq.heappush(heap, (-score[both], before, end))
        out, start = [], 0
        while start < size:
            out += self._ids(part[start : ends[start]])
            start = ends[start]
        return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    values = pa.array(np.concatenate(rows).astype(np.int32) if rows else [], pa.int32())
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(r) for r in rows])].astype(np.int32)), values)


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (array of int), n_ids, ids_crc32 (of little-endian 32-bit ids) and round_trip of every row of `docs`.

    ids are the best path by score. round_trip tells
    whether decoding the ids gives the text back. Defined cases: null and empty
    texts have no ids; characters without a piece, and the mark that spells spaces, are
    spelled in bytes; rows without a doc_id are encoded like others. Other columns are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(model)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                flat, sizes, crcs, same = [], [], [], []
                for value in part.column("text"):
                    text = value.as_py()
                    blob = known.encode(text)
                    ids = np.frombuffer(blob, "<u4")
                    flat.append(ids)
                    sizes.append(len(ids))
                    crcs.append(zlib.crc32(blob))
                    same.append(known.decode(ids.tolist()) == text)
                columns = [part.column("doc_id"), _lists(flat), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "n_ids", "ids_crc32", "round_trip"])

    return _texts(docs).mapInArrow(lean(scan), "doc_id long, ids array<int>, n_ids long, ids_crc32 long, round_trip boolean")


def merged(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ids of every row of `docs` by the merges of a BPE model: what its library gives."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = merges(model)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                ids = _lists([np.frombuffer(known.encode(text.as_py()), "<u4") for text in part.column("text")])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    return _texts(docs).mapInArrow(lean(scan), "doc_id long, ids array<int>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give an empty text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(model)
        for batch in batches:
            texts = pa.array([known.decode(ids or []) for ids in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(lean(scan), "doc_id long, text string")
