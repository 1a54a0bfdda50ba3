"""Token ids in binary files of 64-bit words (Simple-8b), and back.

A word's upper 4 bits select how many ids share its lower 60 bits; ids too large for that are
escapes, kept in a table. Words are cut into blocks of BLOCK ids; the offset of each block's
first word lets all blocks be decoded at once. A file is a row of frames, each with its
documents, its blocks' offsets, escapes and words. Files follow one another by doc_id.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from accessaudit.llm.common import NO_ID, ids_column, total_bytes
from accessaudit.session import fresh_folder, written

END_ID = 2
BLOCK = 1024
FRAME_IDS = 1 << 17
MOST_WORDS = 3 << 18  # results kept in memory
FILE_BYTES = 16 << 20  # of text in a file, about
MIN_FILES = 128
MAGIC = b"S8BF"

#: Selector s packs COUNTS[s] ids of WIDTHS[s] bits; selector 0 is an escape: its 60 bits are a place in the table.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([60, *(60 // c for c in COUNTS[1:])])
_LOW = np.uint64((1 << 60) - 1)
_POWERS = np.uint64(1) << np.arange(60, dtype=np.uint64)
_BITS = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=np.uint64), "right").astype(np.uint8)


def _bits(ids: np.ndarray) -> np.ndarray:
    """How many bits each id takes."""
    if ids.max(initial=0) < len(_BITS):
        return _BITS[ids]
    return np.searchsorted(_POWERS, ids, "right").astype(np.uint8)


def encode_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the offset of the first word of each block, and escaped ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    escaped = ids > _LOW
    escapes = ids[escaped]
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), escapes
    wide = int(COUNTS.max())
    row = BLOCK + wide  # a block is followed by zeros: its last word reaches into them, not into the next block
    size = n - (blocks - 1) * BLOCK  # of the last block

    def padded(values: np.ndarray) -> np.ndarray:
        out = np.zeros((blocks, row), values.dtype)
        out[:-1, :BLOCK] = values[: n - size].reshape(blocks - 1, BLOCK)
        out[-1, :size] = values[n - size :]
        return out

    bits = padded(_bits(ids))
    bits[padded(escaped)] = 255
    reach = {1: bits}  # the widest of so many neighbours
    while max(reach) * 2 <= wide:
        last = max(reach)
        reach[2 * last] = np.maximum(reach[last][:, :-last], reach[last][:, last:])
    choice = np.zeros((blocks, row), np.uint8)
    own = choice[:, :BLOCK]
    own += 1
    for s in range(1, len(COUNTS)):  # what one selector can pack, the next can: the first that can is taken
        count = int(COUNTS[s])
        near = max(p for p in reach if p <= count)
        most = np.maximum(reach[near][:, :BLOCK], reach[near][:, count - near : count - near + BLOCK])
        own += most > WIDTHS[s]
    own[own == len(COUNTS)] = 0
    step = COUNTS[choice]
    step[:, BLOCK:] = 0  # a block that is through stays where it is
    step[-1, size:] = 0
    step, at, starts = step.ravel(), np.arange(blocks) * row, np.zeros(blocks * row, bool)
    ends = None
    while ends is None or (ends != at).any():
        at = at if ends is None else ends
        starts[at] = True
        ends = at + step[at]
    start = np.flatnonzero(starts & (step > 0))
    selector = choice.ravel()[start]
    words = selector.astype(np.uint64) << np.uint64(60)
    flat = padded(ids).ravel()
    for s in range(1, len(COUNTS)):
        at = np.flatnonzero(selector == s)
        if not len(at):
            continue
        here, value = start[at], np.zeros(len(at), np.uint64)
        for j in range(int(COUNTS[s])):
            value |= flat[here + j] << np.uint64(j * int(WIDTHS[s]))
        words[at] |= value
    out = np.flatnonzero(selector == 0)
    words[out] |= np.arange(len(out), dtype=np.uint64)
    return words, np.searchsorted(start, np.arange(blocks) * row).astype(np.uint32), escapes


def decode_ids(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The `n` ids that `encode_ids` put into words."""
    out = np.zeros(n, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    block = np.searchsorted(offsets, np.arange(len(words)), "right") - 1
    before = np.cumsum(counts) - counts
    start = block * BLOCK + before - before[offsets[block]] if len(words) else before
    limit = np.minimum((block + 1) * BLOCK, n)
    for s in range(1, len(COUNTS)):
        at = np.flatnonzero(selector == s)
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for j in range(int(COUNTS[s]) if len(at) else 0):
            here = start[at] + j
            good = here < limit[at]
            out[here[good]] = (words[at[good]] >> np.uint64(j * int(WIDTHS[s]))) & mask
    at = np.flatnonzero(selector == 0)
    out[start[at]] = escapes[(words[at] & _LOW).astype(np.int64)]
    return out


def frame(docs: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One frame: magic, sizes (documents, ids, blocks, escapes, words), then these five as little-endian numbers."""
    words, offsets, escapes = encode_ids(ids)
    sizes = np.array([len(docs), len(ids), len(offsets), len(escapes), len(words)], "<u8")
    parts = (sizes, docs.astype("<i8"), counts.astype("<u8"), offsets.astype("<u4"), escapes.astype("<u8"), words.astype("<u8"))
    return MAGIC + b"".join(p.tobytes() for p in parts)


def frames(data: bytes | pa.Buffer) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, their numbers of ids, all ids) of every frame of a file."""
    at, data = 0, memoryview(data)
    while at < len(data) and data[at : at + 1] != b"\n":
        if data[at : at + 4] != MAGIC:
            raise ValueError("no token file")
        n_docs, n_ids, n_blocks, n_escapes, n_words = np.frombuffer(data, "<u8", 5, at + 4).astype(int).tolist()
        at += 44
        parts = []
        for kind, n in (("<i8", n_docs), ("<u8", n_docs), ("<u4", n_blocks), ("<u8", n_escapes), ("<u8", n_words)):
            parts.append(np.frombuffer(data, kind, n, at))
            at += np.dtype(kind).itemsize * n
        docs, counts, offsets, escapes, words = parts
        yield docs, counts.astype(np.int64), decode_ids(words, offsets, escapes, n_ids)


class _Cache(dict):
    """Results by key. When full, the older half goes; keys that come again stay."""

    def __init__(self, make, most: int):
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most // 2:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Ids of texts by a tokenizer file whose words never reach across white space.

    Words between white space are encoded once and kept. In texts of Latin-1 characters, whose
    lower case and normal form are those of each character alone, runs of marks are set apart
    first, so that a word is kept once, however it is written.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        spec = json.loads(self.whole.to_str())
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]], [x["type"] for x in spec["pre_tokenizer"]["pretokenizers"]]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
            raise ValueError("a tokenizer that normalizes and splits in another way")
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {n: spell.pre_tokenize_str(chr(n))[0][0] for n in range(256)}
        self.model = self.whole.model
        self.lower = _Cache(self._lower, MOST_WORDS)
        self.words = _Cache(self._ids, MOST_WORDS // 8)
        # runs of marks; one with an apostrophe or underline is left to the tokenizer's pattern
        self.marks = re.compile(r"(?<![^\w\s])(?<!_)[^\w\s']+(?![^\w\s]|_)").sub
        self.odd = re.compile("[\x1c-\x1f]").search  # white space to Python, not to the pattern
        latin = map(chr, range(256))
        self.kinds = "".join("o" if self.odd(c) else "m" if re.match(r"[^\w\s]", c) else "_" if c == "_" else " " for c in latin).encode()

    def _ids(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        """Ids of what the pattern takes as one; printable ASCII is spelled as it is, other characters as the library does."""
        spelled = part if part.isascii() and part.isprintable() else part.translate(self.spelled)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _lower(self, word: str) -> bytes:
        return self._part(word) if word.isalpha() else b"".join(map(self._part, self.pattern.findall(word)))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        kinds = self._kinds(text)
        if self.odd(text) if kinds is None else b"o" in kinds:
            return self._ids(text)
        if kinds is None or "<|" in text:  # a special token's text is one token
            return b"".join(map(self.words.__getitem__, text.split()))
        text = text.lower()
        if b"mm" in kinds or b"_" in kinds:
            text = self.marks(r" \g<0> ", text)
        else:
            text = text.replace(",", " , ").replace(".", " . ")
        return b"".join(map(self.lower.__getitem__, text.split()))

    def _kinds(self, text: str) -> bytes | None:
        """The kind of each character of a Latin-1 text: mark, underline, odd or other."""
        try:
            return text.encode("latin-1").translate(self.kinds)
        except UnicodeEncodeError:
            return None


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> None:
    """Write the ids of all `docs`, each closed by `end_id`, as files below `folder`, by doc_id.

    Files hold ranges of doc_ids, taken from quantiles of the ids alone; texts are encoded where they
    are read, and only ids are shuffled. Rows without a doc_id come last; rows that share one
    follow one another by their ids.
    """
    files = max(MIN_FILES, -(-total_bytes(docs) // FILE_BYTES))
    cuts = [i / files for i in range(1, files)]
    found = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), cuts, max(10_000, 10 * files))).first()[0]
    edges = np.unique(np.array(found or [], np.int64))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encoder(tokenizer).encode, np.uint32(end_id).tobytes()
        for batch in batches:
            ids = ids_column(pa.table([batch.column("doc_id")], names=["doc_id"]), "doc_id")
            made = []
            for text in batch.column("text"):
                own = np.frombuffer(encode(text.as_py()) + last, "<u4")
                made.append(own.astype("<u2").tobytes() + b"2" if own.max() < 1 << 16 else own.tobytes() + b"4")
            file = pa.array(np.searchsorted(edges, ids, "right").astype(np.int32))
            yield pa.RecordBatch.from_arrays([file, pa.array(ids), pa.array(made, pa.binary())], names=["file", "doc_id", "ids"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()  # what scans kept is not wanted beside whole files
        file, parts, done, size = None, [], [], 0

        def close() -> None:
            nonlocal parts, size
            if parts:
                arrays = [x for _, x in parts]
                done.append(frame(np.array([d for d, _ in parts]), np.array([len(x) for x in arrays]), np.concatenate(arrays)))
            parts, size = [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": pa.array([file], pa.int32()), "data": pa.array([b"".join(done)], pa.binary())})

        for batch in batches:
            for f, doc, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), map(pa.BinaryScalar.as_py, batch.column(2)), strict=True):
                if f != file:
                    close()
                    if done:
                        yield row()
                    file, done = f, []
                parts.append((doc, np.frombuffer(blob[:-1], "<u2" if blob[-1:] == b"2" else "<u4")))
                size += len(parts[-1][1])
                if size >= FRAME_IDS:
                    close()
        close()
        if done:
            yield row()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.mapInArrow(scan, "file int, doc_id long, ids binary")
    rows = rows.repartition("file").sortWithinPartitions("file", "doc_id", "ids")
    data = rows.mapInArrow(pack, "file int, data binary").select("file", F.col("data").cast("string").alias("data"))
    data.write.partitionBy("file").text(folder)


def read_tokens(spark: SparkSession, folder: str, crc: bool = False) -> DataFrame:
    """file, doc_id, start (ids before it in its file), n_tokens and ids, from the files below `folder`.

    Ids are little-endian, 32 bits each, or 64 where one of a frame needs them. With `crc` their
    ids_crc32 comes in their place, and no ids leave the task.
    """

    last = "ids_crc32" if crc else "ids"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()
        for batch in batches:
            for file, data in zip(batch.column("file"), batch.column("content"), strict=True):
                file, before = file.as_py(), 0
                for docs, counts, ids in frames(data.as_buffer()):
                    kind = "<u4" if ids.max(initial=0) < 1 << 32 else "<u8"
                    ends = np.cumsum(counts)
                    flat = ids.astype(kind)
                    own = [flat[a:b].tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                    held = pa.array(map(zlib.crc32, own), pa.int64()) if crc else pa.array(own, pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(docs), file, np.int32)),
                            pa.array(docs, mask=docs == NO_ID),
                            pa.array(before + ends - counts),
                            pa.array(counts),
                            held,
                        ],
                        names=["file", "doc_id", "start", "n_tokens", last],
                    )
                    before += int(ends[-1]) if len(ends) else 0

    files = spark.read.format("binaryFile").load(folder).select(F.col("file").cast("int").alias("file"), "content")
    return files.mapInArrow(scan, f"file int, doc_id long, start long, n_tokens long, {last} {'long' if crc else 'binary'}")


def token_table(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every row of `docs`, from files written and read again.

    Defined cases: null and empty texts hold the end id alone; rows without a doc_id come after
    all others; rows that share one follow one another. Other columns are not read. An empty
    table writes no file and gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or fresh_folder(spark, "tokens")
    write_tokens(docs, tokenizer, folder, end_id)
    if docs.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    rows = read_tokens(spark, folder, crc=True)
    rows = written(rows, fresh_folder(spark, "token-index"))
    sizes = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    totals = sorted((r["file"], r["n"]) for r in sizes.collect())  # one row per file
    before, sums = 0, []
    for file, n in totals:
        sums.append((file, before))
        before += n
    offsets = spark.createDataFrame(sums, "file int, before long")
    return rows.join(F.broadcast(offsets), "file").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
