"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

The ratios count, over all labelled rows, in how many toxic and other texts each hashed n-gram
occurs. The weights are fitted on a bounded sample of them. Scoring reads every whole text once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from accessaudit.llm.common import hand_back, hinted, lean

BITS = 18  # of a feature's number
GRAMS = (3, 4, 5)
THRESHOLD = 0.7
#: The weights are fitted on at most so many labelled rows of each class, those whose id hashes lowest.
SAMPLE_TOXIC, SAMPLE_OTHER = 1000, 2000
ROUNDS, RATE, DECAY = 120, 0.02, 1e-6
BLOCK = 1 << 14  # features counted in one row

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SPACES = str.maketrans("\t\n\x0b\x0c\r", "     ")


def features(text: str) -> np.ndarray:
    """The numbers of the distinct n-grams of a text: lower case, white space as spaces, one at either end."""
    points = f" {text.lower()} ".translate(_SPACES).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(points, np.uint32).astype(np.uint64)
    points += np.uint64(1)
    hashed, found = points, []
    for n in range(2, max(GRAMS) + 1):
        if len(points) < n:
            break
        hashed = hashed[:-1] * _STEP + points[n - 1 :]
        if n in GRAMS:
            mixed = (hashed ^ (hashed >> np.uint64(29))) * _MIX
            found.append((mixed >> np.uint64(64 - BITS)).astype(np.uint32))
    if not found:
        return np.zeros(0, np.uint32)
    found = np.sort(np.concatenate(found))
    return found[np.r_[True, found[1:] != found[:-1]]]


@dataclass
class Model:
    """`weights` hold the fitted weight times the ratio of each feature."""

    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        z = float(self.weights[features(text)].sum()) + self.bias
        return float(1 / (1 + np.exp(-z))) if z >= 0 else float(np.exp(z) / (1 + np.exp(z)))


def _remainder(name: str, parts: int = 3):
    return F.crc32(F.col(name).cast("string").cast("binary")) % parts


def held_out(name: str = "doc_id"):
    """Whether labels of a row are kept from learning. False without an id: such rows have no label."""
    return F.coalesce(_remainder(name) == 1, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and toxic of the rows to learn from; a doc_id labelled twice counts with the larger label."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic in (0, 1)").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(hinted(known, 1_000_000), "doc_id")


def count_features(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts of either class each feature occurs; the entry after the last feature counts the texts."""
    size = (1 << BITS) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size), np.int64)
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                counts[toxic, features(text)] += 1
                counts[toxic, -1] += 1
        if counts.any():
            low = range(0, size, BLOCK)
            blobs = [zstandard.compress(counts[:, x : x + BLOCK].tobytes(), 1) for x in low]
            yield pa.RecordBatch.from_pydict({"block": pa.array([x // BLOCK for x in low], pa.int32()), "counts": blobs})

    def add(key, table):
        total = sum(np.frombuffer(zstandard.decompress(x), np.int64) for x in table.column("counts").to_pylist())
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counts": [total.tobytes()]})

    schema = "block int, counts binary"
    made = rows.select("text", "toxic").mapInArrow(lean(count), schema).groupBy("block").applyInArrow(lean(add), schema)
    counts = np.zeros((2, size), np.int64)
    for row in made.collect():  # as many rows as blocks, whatever the input
        low = row["block"] * BLOCK
        counts[:, low : low + BLOCK] = np.frombuffer(row["counts"], np.int64).reshape(2, -1)
    return counts[1], counts[0]


def log_count_ratios(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    p, q = toxic[:-1] + 1.0, other[:-1] + 1.0
    return np.log(p / p.sum()) - np.log(q / q.sum())


def fit(sample: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of a logistic regression on the present features' ratios, by gradient steps of adapted size."""
    sizes = np.array([len(x) for x in sample])
    at = np.concatenate(sample).astype(np.int64)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    w, b = np.zeros(len(ratios)), 0.0
    mean, square = np.zeros(len(ratios) + 1), np.zeros(len(ratios) + 1)
    z = np.zeros(len(sample))
    for n in range(1, ROUNDS + 1):
        z[sizes > 0] = np.add.reduceat((w * ratios)[at], starts) if len(at) else 0
        error = weight * (1 / (1 + np.exp(-np.clip(z + b, -30, 30))) - toxic)
        slope = np.append(np.bincount(at, np.repeat(error, sizes), len(ratios)) * ratios + DECAY * w, error.sum())
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        step = RATE * (1 - 0.9 * n / ROUNDS) * (mean / (1 - 0.9**n)) / (np.sqrt(square / (1 - 0.999**n)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w * ratios, float(b)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled rows that are not held out.

    Where either class has no row, all texts get the same score, by the share of toxic rows.
    """
    rows = _labelled(docs, labels)
    toxic, other = count_features(rows)
    if not toxic[-1] or not other[-1]:
        return Model(np.zeros(1 << BITS), float(np.log((toxic[-1] + 1) / (other[-1] + 1))))
    ratios = log_count_ratios(toxic, other)
    share = {1: toxic[-1] / (toxic[-1] + other[-1]), 0: other[-1] / (toxic[-1] + other[-1])}
    sampled = []
    for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_OTHER)):
        ids = rows.where(F.col("toxic") == label).select("doc_id").distinct()
        sampled.append(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    chosen = sampled[0].union(sampled[1])

    def learn(key, table):
        table = table.sort_by("doc_id")
        labelled = table.column("toxic").to_numpy()
        weight = np.where(labelled == 1, share[1] / max(1, (labelled == 1).sum()), share[0] / max(1, (labelled == 0).sum()))
        w, b = fit([features(x.as_py()) for x in table.column("text")], labelled, weight, ratios)
        return pa.table({"weights": [w.tobytes()], "bias": [b]})

    sample = rows.join(hinted(chosen), "doc_id").groupBy(F.lit(0).alias("one"))
    made = sample.applyInArrow(lean(learn), "weights binary, bias double").first()
    return Model(np.frombuffer(made["weights"], np.float64), made["bias"])


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size: 2 ** BITS weights

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array([shared.value.score(x.as_py()) for x in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), score], names=["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    made = texts.mapInArrow(lean(scan), "doc_id long, score double")
    return made.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every row of `docs`.

    Only the text counts. Defined cases: null and empty texts have no n-grams and get the score
    of the bias; rows without a doc_id are scored and never learned from; labels other than 0
    and 1, without an id or of unknown documents are not read; repeated rows are scored alike.
    """
    return scored(docs, train(docs, labels), threshold)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` below the threshold, with all their columns. Learns from `docs` and `labels`.

    Defined cases are those of `toxicity`; columns may have any names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:  # only the text leaves the JVM, only the score comes back
        made = pa.array([shared.value.score(x.as_py() or "") for x in texts], pa.float64())
        if texts.nbytes >= 1 << 20:
            hand_back()
        return made

    return docs.where(score("text") < threshold)
