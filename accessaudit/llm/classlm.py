"""Brown class-based bigrams: words in classes, classes in sequence.

The most frequent words are clustered by exchange one by one, from the counts of their bigrams.
Every other word then joins the class that explains its neighbours best, and from there on all
words of the vocabulary are exchanged, round after round: a round counts the classes beside every word,
scores all classes for each, moves each to its best, and is undone if the likelihood of the
class bigrams fell. The model then is P(class | class before) times P(word | class); words
unseen in training form a class of their own, whose transitions are learned from the words seen once.

Texts are read once and not shuffled: each task codes its documents into chunks, rows of word numbers with a
list of the chunk's distinct words. The vocabulary lies in buckets by hash. Chunks get the classes of
their words from the buckets and send back how often each word stood beside each class.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessaudit.llm.common import NO_ID, power_of_two, texts
from accessaudit.session import fresh_folder, written

CORE = 2048  # words that are exchanged one by one, to start from
CLASSES = 64
CORE_ROUNDS = 8
ROUNDS = 3  # over the whole vocabulary; the first places the words outside the core
PRIOR = 50.0  # weight of a class's share in its transitions
HELD = "held out of training"
END = b""  # closes a text; no word is empty
REST, CLOSE = 0, 1  # classes of words not yet placed and of the end
UNKNOWN, ONCE = 127, 128  # in class sequences: no class, and a mark on words seen once
CHUNK_TEXT = 8 << 20
MIN_BUCKETS = 256
WORDS_PER_BUCKET = 32_768
SAMPLED = 4096  # one distinct word in so many is counted to size the buckets
ENTRIES = 1 << 21  # counts added up at a time


def words(text: bytes) -> list[bytes]:
    """Words of a text, A-Z in lower case, cut at spaces and the characters 9 to 13, and its end."""
    found = text.lower().split()
    found.append(END)
    return found


def _marked(docs: DataFrame) -> DataFrame:
    """Rows without a doc_id are not held out."""
    remainder = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5
    return docs.withColumn(HELD, F.coalesce(remainder == 1, F.lit(False)))


def _packed(x: np.ndarray) -> bytes:
    return zstandard.compress(x.tobytes(), 1)


def _numbers(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), kind)


def _crcs(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, found), np.int64, len(found))


CODED = "ids binary, flags binary, lengths binary, tokens binary, words binary, sample array<binary>"


def coded(docs: DataFrame) -> DataFrame:
    """Documents in rows of about CHUNK_TEXT bytes of text; a longer text has a row of its own.

    ids, flags (1: held out, 2: no id) and lengths have a number per document, `tokens` one per token: its
    place in `words`, the distinct words ordered by crc32, one a line. `sample` holds one in SAMPLED of those.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: defaultdict = defaultdict()
        number.default_factory = number.__len__
        ids, flags, lengths, tokens, size = [], bytearray(), [], array("I"), 0
        for batch in batches:
            for doc, text, held in zip(batch.column("doc_id"), batch.column("text"), batch.column("carried_0"), strict=True):
                doc, text = doc.as_py(), text.as_py()
                if size and size + len(text) > CHUNK_TEXT:
                    yield out(number, ids, flags, lengths, tokens)
                    number.clear()
                    ids, flags, lengths, tokens, size = [], bytearray(), [], array("I"), 0
                before = len(tokens)
                tokens.extend(map(number.__getitem__, words(text)))
                ids.append(NO_ID if doc is None else doc)
                flags.append(held.as_py() | (doc is None) << 1)
                lengths.append(len(tokens) - before)
                size += len(text) + 1
        if ids:
            yield out(number, ids, flags, lengths, tokens)

    def out(number, ids, flags, lengths, tokens) -> pa.RecordBatch:
        found = list(number)
        crcs = _crcs(found)
        order = np.argsort(crcs, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        row = {
            "ids": _packed(np.array(ids, np.int64)),
            "flags": bytes(flags),
            "lengths": _packed(np.array(lengths, np.int64)),
            "tokens": _packed(place[np.frombuffer(tokens, np.uint32)]),
            "words": zstandard.compress(b"\n".join(found[i] for i in order), 1),
        }
        columns = [pa.array([v], pa.binary()) for v in row.values()]
        columns.append(pa.array([[found[i] for i in np.flatnonzero(crcs % SAMPLED == 0)]], pa.list_(pa.binary())))
        return pa.RecordBatch.from_arrays(columns, names=[*row, "sample"])

    return texts(_marked(docs), (HELD,)).mapInArrow(code, CODED).withColumn("chunk", F.monotonically_increasing_id())


def _training(tokens: bytes, lengths: bytes, flags: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of a chunk, and which are of training documents."""
    train = np.frombuffer(flags, np.uint8) & 1 == 0
    return _numbers(tokens, np.uint32), np.repeat(train, _numbers(lengths, np.int64))


def _each(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Values of the rows, one row at a time."""
    for batch in batches:
        columns = [batch.column(n) for n in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def vocabulary(chunks: DataFrame, buckets: int) -> DataFrame:
    """Two kinds of rows: a bucket's words and counts (chunk -1), and each chunk's words as places in the bucket's list.

    bucket, chunk, places; words, n, n_all (all counts) and distinct (words with a count). Words of held-out
    texts alone have count 0.
    """
    shift = 32 - (buckets.bit_length() - 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, blob, *coded_text in _each(batches, "chunk", "words", "tokens", "lengths", "flags"):
            found = zstandard.decompress(blob).split(b"\n")
            tokens, train = _training(*coded_text)
            n = np.bincount(tokens[train], minlength=len(found))
            bucket = _crcs(found) >> shift
            edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            spans = list(zip(edges, np.r_[edges[1:], len(found)], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[edges].astype(np.int32)),
                    pa.array([chunk] * len(edges), pa.int64()),
                    pa.array([zstandard.compress(b"\n".join(found[a:b]), 1) for a, b in spans], pa.binary()),
                    pa.array([_packed(n[a:b]) for a, b in spans], pa.binary()),
                ],
                names=["bucket", "chunk", "words", "n"],
            )

    def merge(key, asked):
        number: defaultdict = defaultdict()
        number.default_factory = number.__len__
        places, total = [], np.zeros(1 << 10, np.int64)
        for words_blob, n_blob in zip(asked.column("words"), asked.column("n"), strict=True):
            found = zstandard.decompress(words_blob.as_py()).split(b"\n")
            at = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
            if len(number) > len(total):
                total = np.append(total, np.zeros(max(len(total), len(number)), np.int64))
            total[at] += _numbers(n_blob.as_py(), np.int64)  # a chunk asks for a word once
            places.append(_packed(at.astype(np.uint32)))
        total, rows = total[: len(number)], len(places)
        none = [None] * rows
        return pa.table(
            {
                "bucket": pa.array([key[0].as_py()] * (rows + 1), pa.int32()),
                "chunk": pa.array([*asked.column("chunk").to_pylist(), -1], pa.int64()),
                "places": pa.array([*places, None], pa.binary()),
                "words": pa.array([*none, zstandard.compress(b"\n".join(number), 1)], pa.binary()),
                "n": pa.array([*none, _packed(total)], pa.binary()),
                "n_all": pa.array([*none, int(total.sum())], pa.int64()),
                "distinct": pa.array([*none, int((total > 0).sum())], pa.int64()),
            }
        )

    asked = chunks.select("chunk", "words", "tokens", "lengths", "flags").mapInArrow(ask, "bucket int, chunk long, words binary, n binary")
    schema = "bucket int, chunk long, places binary, words binary, n binary, n_all long, distinct long"
    return asked.groupBy("bucket").applyInArrow(merge, schema)


def most_frequent(lists: DataFrame, k: int) -> list[bytes]:
    """The k most frequent words but the end; ties by bytes."""

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blob, n in _each(batches, "words", "n"):
            found, n = zstandard.decompress(blob).split(b"\n"), _numbers(n, np.int64)
            least = np.partition(n, len(n) - k)[len(n) - k] if len(n) > k else 0
            at = [i for i in np.flatnonzero(n >= max(1, least)) if found[i] != END]
            yield pa.RecordBatch.from_arrays([pa.array([found[i] for i in at], pa.binary()), pa.array(n[at], pa.int64())], names=["word", "n"])

    top = lists.select("words", "n").mapInArrow(tops, "word binary, n long").orderBy(F.desc("n"), "word").limit(k)
    return [bytes(r["word"]) for r in top.collect()]


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """Add up compressed blocks (block, counts) into `size` numbers; as many rows as blocks reach the driver."""

    def add(key, table):
        total = sum(np.frombuffer(zstandard.decompress(x), np.int64) for x in table.column("counts").to_pylist())
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counts": [zstandard.compress(total.tobytes(), 1)]})

    out, made = np.zeros(size, np.int64), rows.groupBy("block").applyInArrow(add, "block int, counts binary")
    for row in made.collect():
        part = np.frombuffer(zstandard.decompress(row["counts"]), np.int64)
        out[row["block"] * BLOCK : row["block"] * BLOCK + len(part)] = part
    return out


BLOCK = 1 << 17


def _blocks(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(counts), BLOCK):
        part = counts[low : low + BLOCK]
        if part.any():
            blob = pa.array([zstandard.compress(part.astype(np.int64).tobytes(), 1)])
            yield pa.RecordBatch.from_arrays([pa.array([low // BLOCK], pa.int32()), blob], names=["block", "counts"])


def core_bigrams(chunks: DataFrame, core: dict[bytes, int]) -> np.ndarray:
    """How often each of the core's words (1, 2, ...) and the rest (0) follow each other; a text starts after an end."""
    size = len(core) + 1
    shared = chunks.sparkSession.sparkContext.broadcast(core)  # of CORE words at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, end = shared.value.get, shared.value[END]
        total = np.zeros(size * size, np.int64)
        for blob, *coded_text in _each(batches, "words", "tokens", "lengths", "flags"):
            found = zstandard.decompress(blob).split(b"\n")
            of = np.fromiter((get(w, 0) for w in found), np.int64, len(found))
            tokens, train = _training(*coded_text)
            x = np.r_[end, of[tokens[train]]]
            total += np.bincount(x[:-1] * size + x[1:], minlength=size * size)
        yield from _blocks(total)

    rows = chunks.select("words", "tokens", "lengths", "flags").mapInArrow(count, "block int, counts binary")
    return _summed(rows, size * size).reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, fixed: int, classes: int = CLASSES, rounds: int = CORE_ROUNDS) -> np.ndarray:
    """A class for every word of a bigram table, by exchange.

    Words are in order of frequency. The first `fixed` keep a class of their own; the others start in
    turn and move, one at a time, to the class that raises the likelihood of the class bigrams
    most, until a round moves none or `rounds` are over.
    """
    n = len(bigrams)
    table = bigrams.astype(float)
    free = max(1, classes - fixed)
    of = np.where(np.arange(n) < fixed, np.arange(n), fixed + (np.arange(n) - fixed) % free)
    size = fixed + free
    pairs = np.zeros((size, size))
    np.add.at(pairs, (of[:, None].repeat(n, 1), of[None, :].repeat(n, 0)), table)
    for _ in range(rounds):
        moved = 0
        for w in range(fixed, n):
            after, before, own = table[w], table[:, w], table[w, w]
            right = np.bincount(of, after, size)
            left = np.bincount(of, before, size)
            old = of[w]
            right[old] -= own
            left[old] -= own
            pairs[old] -= right
            pairs[:, old] -= left
            pairs[old, old] -= own
            rows, columns = pairs.sum(axis=1), pairs.sum(axis=0)
            grown = _xlogx(pairs + right) + _xlogx(pairs.T + left) - _xlogx(pairs) - _xlogx(pairs.T)
            both = np.diagonal(pairs)
            corner = both + right + left + own
            gain = grown.sum(axis=1) - np.diagonal(grown) + _xlogx(corner) - _xlogx(both)
            gain -= _xlogx(rows + right.sum() + own) - _xlogx(rows) + _xlogx(columns + left.sum() + own) - _xlogx(columns)
            gain[:fixed] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[old] + 1e-9:
                best = old
            moved += best != old
            of[w] = best
            pairs[best] += right
            pairs[:, best] += left
            pairs[best, best] += own
        if not moved:
            break
    return of


def likelihood(pairs: np.ndarray) -> float:
    """Of the class bigrams, but for a term that no exchange changes."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(axis=0)).sum() - _xlogx(pairs.sum(axis=1)).sum())


CLASSED = "bucket int, n binary, class binary"


def first_classes(lists: DataFrame, core_class: dict[bytes, int]) -> DataFrame:
    """bucket, n and class (a byte per word of the bucket): the core's, UNKNOWN without a count, else REST."""
    shared = lists.sparkSession.sparkContext.broadcast(core_class)  # of CORE words at most

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for bucket, blob, n in _each(batches, "bucket", "words", "n"):
            found = zstandard.decompress(blob).split(b"\n")
            of = np.fromiter((get(w, REST) for w in found), np.uint8, len(found))
            of[_numbers(n, np.int64) == 0] = UNKNOWN
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([n], pa.binary()), pa.array([of.tobytes()], pa.binary())], names=["bucket", "n", "class"])

    return lists.select("bucket", "words", "n").mapInArrow(start, CLASSED)


def answers(links: DataFrame, classed: DataFrame, counts: bool = False) -> DataFrame:
    """chunk, bucket, class and (if asked) n of the chunk's words in that bucket."""

    def answer(key, links, known):
        of, n = np.frombuffer(known.column("class")[0].as_py(), np.uint8), _numbers(known.column("n")[0].as_py(), np.int64)
        classes, ns = [], []
        for blob in links.column("places"):
            at = _numbers(blob.as_py(), np.uint32)
            classes.append(of[at].tobytes())
            ns.append(_packed(n[at]) if counts else None)
        made = {"chunk": links.column("chunk"), "bucket": links.column("bucket"), "class": pa.array(classes, pa.binary()), "n": pa.array(ns, pa.binary())}
        return pa.table(made)

    return links.groupBy("bucket").cogroup(classed.groupBy("bucket")).applyInArrow(answer, "chunk long, bucket int, class binary, n binary")


def beside(chunks: DataFrame, answered: DataFrame) -> DataFrame:
    """How often words stand beside classes: bucket, chunk, keys and counts; and with bucket -1 a chunk's class bigrams.

    A key is 256 times the word's place in the chunk's list for the bucket, plus the class before or 128 plus that after.
    """

    def tell(key, row, answers):
        answers = answers.sort_by("bucket")
        parts = answers.column("class").to_pylist()
        starts = np.cumsum([0, *map(len, parts)])
        of = np.frombuffer(b"".join(parts), np.uint8)
        tokens, train = _training(*(row.column(c)[0].as_py() for c in ("tokens", "lengths", "flags")))
        tokens = tokens[train]
        classes = of[tokens]
        # every text closes with an end, so the one before it closes what precedes a text's first word
        before, after = np.r_[np.uint8(CLOSE), classes[:-1]], np.r_[classes[1:], np.uint8(CLOSE)]
        pairs = np.bincount(before[: len(tokens)].astype(np.int32) << 7 | classes, minlength=1 << 14)
        inner = classes != CLOSE
        at = tokens[inner].astype(np.uint32 if len(of) < 1 << 24 else np.uint64) << 8
        keys, counts = np.unique(np.concatenate([at | before[: len(tokens)][inner], at | after[: len(tokens)][inner] | 128]), return_counts=True)
        cuts = np.searchsorted(keys, starts.astype(np.uint64) << np.uint64(8))
        out = {"bucket": [-1], "keys": [None], "counts": [_packed(pairs.astype(np.int64))]}
        for bucket, first, low, high in zip(answers.column("bucket").to_pylist(), starts, cuts, cuts[1:], strict=False):
            if low < high:
                steps = np.diff(keys[low:high].astype(np.int64), prepend=int(first) << 8)
                out["bucket"].append(bucket)
                out["keys"].append(_packed(steps.astype(np.uint32)))
                out["counts"].append(_packed(counts[low:high].astype(np.uint32)))
        chunk = pa.array([key[0].as_py()] * len(out["bucket"]), pa.int64())
        return pa.table({"bucket": pa.array(out["bucket"], pa.int32()), "chunk": chunk, "keys": pa.array(out["keys"], pa.binary()), "counts": pa.array(out["counts"], pa.binary())})

    rows = chunks.select("chunk", "tokens", "lengths", "flags").groupBy("chunk")
    return rows.cogroup(answered.select("chunk", "bucket", "class").groupBy("chunk")).applyInArrow(tell, "bucket int, chunk long, keys binary, counts binary")


def moved(links: DataFrame, classed: DataFrame, told: DataFrame, pairs: np.ndarray, unplaced: bool) -> DataFrame:
    """`classed` after every word went to the class that makes it and what stands beside it likeliest.

    `pairs` are the class bigrams so far. All words move at once, as if their neighbours stayed. With `unplaced` only
    words of the class REST move. The end stays.
    """
    size = len(pairs)
    smooth = pairs + 0.1
    from_class = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    weights = np.concatenate([from_class, from_class.T])  # of the classes before, then of those after
    share = -np.log(np.maximum(pairs.sum(axis=0), 1.0))

    def move(key, held, told):
        chunk, places, of, n = (held.column(c).to_pylist() for c in ("chunk", "places", "class", "n"))
        state = chunk.index(-1)
        of, n, places = np.frombuffer(of[state], np.uint8), n[state], dict(zip(chunk, places, strict=True))
        table = np.zeros(len(of) * 2 * size)
        waiting, held_back = [], 0

        def add():
            at, counts = (np.concatenate(x) for x in zip(*waiting, strict=True))
            table[:] += np.bincount(at, counts, minlength=len(table))
            waiting.clear()

        for c, keys, counts in zip(told.column("chunk").to_pylist(), told.column("keys"), told.column("counts"), strict=True):
            keys = np.cumsum(_numbers(keys.as_py(), np.uint32).astype(np.int64))
            word = _numbers(places[c], np.uint32)[keys >> 8].astype(np.int64)
            waiting.append((word * (2 * size) + (keys >> 7 & 1) * size + (keys & 127), _numbers(counts.as_py(), np.uint32).astype(float)))
            held_back += len(keys)
            if held_back > ENTRIES:
                add()
                held_back = 0
        if waiting:
            add()
        seen = table.reshape(len(of), 2 * size)
        value = seen @ weights + seen[:, :size].sum(axis=1)[:, None] * share[None, :]
        value[:, : CLOSE + 1] = -np.inf
        best = np.argmax(value, axis=1)
        row = np.arange(len(of))
        free = of == REST if unplaced else (of != CLOSE) & (of != UNKNOWN)
        old = np.where(of < size, of, REST)
        new = np.where(free & (value[row, best] > value[row, old] + 1e-9), best, of).astype(np.uint8)
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([n], pa.binary()), "class": pa.array([new.tobytes()], pa.binary())})

    none = F.lit(None).cast("binary")
    held = links.select("bucket", "chunk", "places", none.alias("n"), none.alias("class")).unionByName(
        classed.select("bucket", F.lit(-1).cast("long").alias("chunk"), none.alias("places"), "n", "class")
    )
    return held.groupBy("bucket").cogroup(told.where("bucket >= 0").groupBy("bucket")).applyInArrow(move, CLASSED)


def _class_pairs(told: DataFrame, classes: int) -> np.ndarray:
    """The class bigrams of all chunks, added up by at most 32 tasks."""

    def add(key, table):
        total = sum(_numbers(x.as_py(), np.int64) for x in table.column("counts"))
        return pa.table({"counts": pa.array([_packed(total)], pa.binary())})

    rows = told.where("bucket = -1").select((F.pmod("chunk", F.lit(32))).alias("part"), "counts")
    total = np.zeros((128, 128))
    for row in rows.groupBy("part").applyInArrow(add, "counts binary").collect():
        total += _numbers(row["counts"], np.int64).reshape(128, 128)
    return total[:classes, :classes]


def _sequences(chunks: DataFrame, answered: DataFrame, base: tuple[int, int]) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score, emitted and classes (a byte per token) of every row."""
    n_all, distinct = base

    def read(key, row, answers):
        answers = answers.sort_by("bucket")
        of = np.frombuffer(b"".join(answers.column("class").to_pylist()), np.uint8)
        n = np.concatenate([_numbers(x.as_py(), np.int64) for x in answers.column("n")])
        ids, flags, lengths, tokens = (row.column(c)[0].as_py() for c in ("ids", "flags", "lengths", "tokens"))
        ids, flags, lengths, tokens = _numbers(ids, np.int64), np.frombuffer(flags, np.uint8), _numbers(lengths, np.int64), _numbers(tokens, np.uint32)
        log_base = np.log10((n + 0.5) / (n_all + 0.5 * (distinct + 1)))
        log_n = np.log10(np.maximum(n, 1))
        marked = of | np.where(n == 1, ONCE, 0).astype(np.uint8)
        ends = np.cumsum(lengths)
        starts = ends - lengths  # no text is without its end
        classes = marked[tokens].tobytes()
        return pa.table(
            {
                "doc_id": pa.array(ids, mask=flags & 2 > 0),
                "held_out": pa.array(flags & 1 > 0),
                "n_tokens": pa.array(lengths),
                "n_known": pa.array(np.add.reduceat((n > 0).astype(np.int64)[tokens], starts)),
                "base_score": pa.array(np.add.reduceat(log_base[tokens], starts)),
                "emitted": pa.array(np.add.reduceat(log_n[tokens], starts)),
                "classes": pa.array([classes[a:b] for a, b in zip(starts, ends, strict=True)], pa.binary()),
            }
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, emitted double, classes binary"
    return chunks.drop("words", "sample").groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(read, schema)


def _transitions(sequences: DataFrame) -> np.ndarray:
    """How often bytes of class sequences follow each other in training texts; a text starts after the end's class 1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            flat = np.frombuffer(b"\x01" + b"".join(batch.column("classes").to_pylist()), np.uint8).astype(np.int64)
            total += np.bincount(flat[:-1] << 8 | flat[1:], minlength=1 << 16)
        yield from _blocks(total)

    return _summed(sequences.where("not held_out").select("classes").mapInArrow(count, "block int, counts binary"), 1 << 16).reshape(256, 256)


def _plain(pairs: np.ndarray) -> np.ndarray:
    """Counts of sequence bytes as those of classes."""
    return pairs.reshape(2, 128, 2, 128).sum(axis=(0, 2)).astype(float)


def log_transitions(pairs: np.ndarray) -> np.ndarray:
    """log10 P(class | class before) for classes 0 to 126 and UNKNOWN, from counts of sequence bytes.

    The share of words seen once tells how likely an unknown word is, after each class; what follows
    words seen once tells what follows unknown ones. Both lean to the shares in the whole
    corpus, with the weight PRIOR.
    """
    plain = pairs.reshape(2, 128, 2, 128)  # seen once or not, class
    follows = plain.sum(axis=(0, 2)).astype(float)
    follows[UNKNOWN] = plain[1].sum(axis=(0, 1))
    once = plain[:, :, 1].sum(axis=(0, 2)).astype(float)
    once[UNKNOWN] = plain[1, :, 1].sum()
    tokens = plain.sum(axis=(0, 1, 2)).astype(float)
    total = max(1.0, tokens.sum())
    unknown = max(plain[:, :, 1].sum(), 0.5) / (total + 1)
    out = follows.sum(axis=1)
    p_unknown = (once + PRIOR * unknown) / (out + PRIOR)
    p = (1 - p_unknown)[:, None] * (follows + PRIOR * tokens / total) / (out + PRIOR)[:, None]
    p[:, UNKNOWN] = p_unknown
    return np.log10(np.maximum(p, 1e-300))


def scored(docs: DataFrame, core_words: int = CORE, classes: int = CLASSES, rounds: int = ROUNDS, report: list | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of `docs`.

    Scores are log10 probabilities of the whole text with its end; base_score that of single words.
    Of the `rounds` over the whole vocabulary the first places the words outside the core; `report` takes the
    likelihood of the class bigrams before each and at the end. Classes that lowered it are undone and end the rounds.
    Defined cases: null and empty texts are an end alone; rows without a doc_id are trained on;
    repeated rows are trained on as often as they occur; without training rows every token
    is the one unknown type, with probability 1. Other columns are not read.
    """
    if not 4 <= classes < UNKNOWN or rounds < 1:
        raise ValueError("4 to 126 classes, 1 round or more")
    report = [] if report is None else report
    spark = docs.sparkSession
    folder = fresh_folder(spark, "classes")
    chunks = written(coded(docs), f"{folder}/coded")
    sampled = chunks.select(F.explode("sample").alias("word")).distinct().count()
    buckets = power_of_two(max(MIN_BUCKETS, sampled * SAMPLED / WORDS_PER_BUCKET))
    held = written(vocabulary(chunks, buckets), f"{folder}/vocabulary")
    lists, links = held.where("chunk = -1"), held.where("chunk >= 0").select("bucket", "chunk", "places")
    found = lists.agg(F.sum("n_all").alias("n"), F.sum("distinct").alias("v")).first()
    base = n_all, _ = int(found["n"] or 0), int(found["v"] or 0)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
    train_tokens = F.lit(n_all).cast("long").alias("train_tokens")
    if not n_all:
        rows = _sequences(chunks, answers(links, first_classes(lists, {}), True), base)
        return rows.select(*names[:4], train_tokens, "base_score", F.lit(0.0).alias("score"))
    core = {END: 1} | {w: i for i, w in enumerate(most_frequent(lists, core_words - 2), 2)}
    of = exchange(core_bigrams(chunks, core), 2, classes)
    classed = written(first_classes(lists, {w: int(of[i]) for w, i in core.items()}), f"{folder}/classes-0")

    kept = classed
    for n in range(1, rounds + 1):
        told = written(beside(chunks, answers(links, classed)), f"{folder}/told-{n}")
        pairs = _class_pairs(told, classes)
        report.append(likelihood(pairs))
        if n > 2 and report[-1] <= report[-2]:
            classed = kept
            break
        kept, classed = classed, written(moved(links, classed, told, pairs, n == 1), f"{folder}/classes-{n}")
    else:
        n += 1

    sequences = written(_sequences(chunks, answers(links, classed, True), base), f"{folder}/sequences")
    counts = _transitions(sequences)
    if n > rounds > 1:
        report.append(likelihood(_plain(counts)[:classes, :classes]))
        if report[-1] < report[-2]:
            sequences = written(_sequences(chunks, answers(links, kept, True), base), f"{folder}/sequences-kept")
            counts = _transitions(sequences)
    steps = log_transitions(counts)
    in_class = _plain(counts).sum(axis=0)
    steps = steps - np.log10(np.maximum(in_class, 1))[None, :] * (np.arange(128) != UNKNOWN)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for blob, emitted in zip(batch.column("classes"), batch.column("emitted"), strict=True):
                x = np.frombuffer(b"\x01" + blob.as_py(), np.uint8) & 127
                made.append(float(steps[x[:-1], x[1:]].sum()) + emitted.as_py())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(made, pa.float64())], names=[*names, "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return sequences.mapInArrow(score, schema).select(*names[:4], train_tokens, "base_score", "score")
