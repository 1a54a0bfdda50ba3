"""Documents packed into sequences of a fixed number of tokens by best-two-fit.

A sequence is filled greedily, always with the longest piece that fits. If room is left, its smallest
piece gives way to the two unpacked pieces that fill the room then free most tightly. Pieces of one length
can stand for one another, so the choice needs only how many there are of each length: a table
of `capacity` numbers whatever the size of the corpus. Sequences of one make-up are planned
together. The n-th piece of a length takes the n-th place the plan has for that length;
pieces are numbered by the task that wrote them, so no length is gathered anywhere.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from tokenizers import Tokenizer

from accessaudit.llm.common import hinted
from accessaudit.session import fresh_folder, written

CAPACITY = 2048
END_ID = 0
BATCH_BYTES = 4 << 20  # of ids given out at once
LONGEST_RUN = 1 << 14  # bytes without white space, or of nothing else; texts with longer ones go to the library whose time is no square of it

PIECE = "doc_id long, piece int, start long, length int, ids binary, task int, place long"
PLACED = "sequence_id long, offset long"


# Ids -------------------------------------------------------------------------------------


class Encoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library.

    Such a file's merges are ranks of byte strings: id 256 + n is the n-th merge. Where that holds the
    same merges are run by tiktoken. Texts with an added token's string, and those with
    a very long word, go to the tokenizers library itself, and so do all texts of any other kind of file.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        spec = json.loads(self.whole.to_str())
        self.added = [x["content"] for x in spec["added_tokens"]]
        self.fast = _ranked(spec)

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or any(x in text for x in self.added) or _longest_run(text) > LONGEST_RUN:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), np.uint32)


#: The words of byte-level BPE, a fixed value.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranked(spec: dict) -> tiktoken.Encoding | None:
    """The same merges as ranks of byte strings, or None where the file says something else."""
    model, words = spec["model"], spec["pre_tokenizer"]
    plain = model["type"] == "BPE" and not any(
        model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    if not plain or spec["normalizer"] or not words or words["type"] != "ByteLevel" or words["add_prefix_space"] or not words["use_regex"]:
        return None
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte = {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}
    added = {x["content"] for x in spec["added_tokens"]}
    vocab = model["vocab"]
    ranks = {bytes(byte[c] for c in token): id for token, id in vocab.items() if token not in added}
    merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    if len(ranks) != 256 + len(merges) or any(vocab.get(a + b) != 256 + n for n, (a, b) in enumerate(merges)):
        return None
    return tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


def _longest_run(text: str) -> int:
    """An upper bound for the bytes of a word or of a run of white space."""
    if len(text) * 4 <= LONGEST_RUN:
        return 0
    data = np.frombuffer(text.encode(), np.uint8)
    turns = np.flatnonzero((data[1:] <= 32) != (data[:-1] <= 32)) + 1
    return int(np.diff(turns, prepend=0, append=len(data)).max())


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The ids of every row of `docs`, closed by `end_id` and cut into pieces of `capacity`, the first one shorter if need be.

    `ids` are little-endian, 32 bits each. `task` and `place` number the pieces of one length; write
    the rows before using them.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        encode, last = encoder(tokenizer).encode, np.uint32(end_id)
        rows: list[tuple] = []
        held = 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids", "task", "place"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py()), last).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    rows.append((doc.as_py(), n, a, b - a, ids[a:b].tobytes(), task, int(seen[b - a])))
                    seen[b - a] += 1
                    held += 4 * (b - a)
                    if held >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.mapInArrow(scan, PIECE)


# The plan --------------------------------------------------------------------------------


@dataclass
class Plan:
    """Where the n-th piece of each length goes.

    Entry i holds the pieces of `length[i]` from number `first[i]` on: each of its sequences, from `sequence[i]` on, takes
    `units[i]` of them, at `offsets[at[i] : at[i] + units[i]]`. Entries are ordered by length and first.
    """

    length: np.ndarray
    first: np.ndarray
    units: np.ndarray
    sequence: np.ndarray
    at: np.ndarray
    offsets: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sequence_id and offset of pieces given by their lengths and their numbers among pieces of that length."""
        low = np.searchsorted(self.length, length)
        high = np.searchsorted(self.length, length, "right")
        while np.any(high - low > 1):  # the last entry that does not begin later
            middle = (low + high) // 2
            later = self.first[np.minimum(middle, len(self.first) - 1)] > number
            high = np.where((high - low > 1) & later, middle, high)
            low = np.where((high - low > 1) & ~later, middle, low)
        turn = number - self.first[low]
        return self.sequence[low] + turn // self.units[low], self.offsets[self.at[low] + turn % self.units[low]]


def one_sequence(left: np.ndarray, capacity: int) -> tuple[dict[int, int], dict[int, int]]:
    """Lengths of the next sequence, and how many of each length had to be there for it to be chosen.

    `left[n]` is how many pieces of length n are unpacked.
    """
    ready = np.flatnonzero(left)
    gap, taken = capacity, {}
    at = len(ready)
    while gap and (at := min(at, int(np.searchsorted(ready, gap, "right")))) > 0:  # the longest that fits, as often as it does
        n = int(ready[at - 1])
        taken[n] = min(gap // n, int(left[n]))
        gap -= n * taken[n]
        at -= 1
    need = dict(taken)
    if gap and sum(taken.values()) > 1:
        small = min(taken)
        free = left[ready] - np.array([taken.get(int(n), 0) for n in ready])
        free[ready == small] += 1
        usable, free = ready[free > 0], free[free > 0]
        other = np.searchsorted(usable, gap + small - usable, "right") - 1
        other = np.minimum(other, np.arange(len(usable)))  # the shorter one of the two
        other -= (other == np.arange(len(usable))) & (free < 2)
        total = np.where(other >= 0, usable + usable[other], 0)
        best = len(total) - 1 - int(np.argmax(total[::-1])) if len(total) else 0
        if len(total) and total[best] > small:
            taken[small] -= 1
            for n in (int(usable[best]), int(usable[other[best]])):
                taken[n] = taken.get(n, 0) + 1
            need = {n: max(need.get(n, 0), taken.get(n, 0)) for n in {*need, *taken}}
            taken = {n: c for n, c in taken.items() if c}
    return taken, need


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Sequences for `counts[n]` pieces of each length n. Sequences of the same make-up are planned at once."""
    left, used = np.zeros(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64)
    for n, count in counts.items():
        if not 1 <= n <= capacity:
            raise ValueError("lengths lie between 1 and the capacity")
        left[n] = count
    entries, offsets, sequences = [], [], 0
    while left.any():
        taken, need = one_sequence(left, capacity)
        # the choice stays the same while what it looked at is still there
        times = min((int(left[n]) - need[n]) // c + 1 for n, c in taken.items())
        offset = 0
        for n in sorted(taken, reverse=True):
            entries.append((n, int(used[n]), taken[n], sequences, len(offsets)))
            offsets.extend(range(offset, offset + n * taken[n], n))
            offset += n * taken[n]
            used[n] += taken[n] * times
            left[n] -= taken[n] * times
        sequences += times
    table = np.array(sorted(entries), np.int64).reshape(-1, 5)
    return Plan(*table.T.copy(), np.array(offsets, np.int64), sequences)


# Packing ---------------------------------------------------------------------------------


def packed(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, folder: str | None = None
) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id and offset of every piece of every row of `docs`.

    The pieces are written below `folder` once. What the driver sees is the number of pieces of each
    length, `capacity` rows. Defined cases: null and empty texts are one piece, the end id; rows without a doc_id or sharing
    one are documents of their own; other columns are not read; an empty table has no pieces.
    """
    if capacity < 1:
        raise ValueError("a sequence holds one token at least")
    spark = docs.sparkSession
    rows = written(pieces(docs, tokenizer, capacity, end_id), folder or fresh_folder(spark, "pieces"))
    held = rows.groupBy("length", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    held = written(held, fresh_folder(spark, "piece-counts"))
    found = plan({r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)

    @arrow_udf(PLACED)
    def placed(length: pa.Array, number: pa.Array) -> pa.Array:
        sequence, offset = found.place(length.to_numpy(zero_copy_only=False), number.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=["sequence_id", "offset"])

    numbered = rows.join(hinted(held.drop("n")), ["length", "task"])
    numbered = numbered.withColumn("at", placed("length", F.col("before") + F.col("place")))
    return numbered.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids", F.col("at.sequence_id").alias("sequence_id"), F.col("at.offset").alias("offset")
    )


def sequences(table: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens, ids (little-endian, 32 bits each) and lengths, in the order of the pieces.

    A sequence has at most as many pieces as it has tokens, so its group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    rows = table.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select(
        "sequence_id",
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("n_tokens"),
        F.concat_ws("", F.transform("parts", lambda p: F.hex(p["ids"]))).alias("hex"),
        F.col("parts.length").alias("lengths"),
    ).select("sequence_id", "n_tokens", F.unhex("hex").alias("ids"), "lengths")
