"""What several operators share: documents as chunks, sizes, hashes of byte strings."""

from __future__ import annotations

import ctypes
import inspect
import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: No document id: sorts after every id and never counts as smaller.
NO_ID = np.iinfo(np.int64).max

#: Tables below both bounds are broadcast, larger ones joined by shuffle.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20

MIN_CHUNKS = 256
CHUNK_BYTES = 24 << 20


def importable(run: Callable) -> Callable:
    """Let the Python workers of a query's session find this package, also where the session was started elsewhere.

    On a cluster the package is installed on every machine under the driver's path, or on its own path.
    """

    @wraps(run)
    def started(spark, *args):
        root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
        known = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
        if root not in [*known, *os.environ.get("PYTHONPATH", "").split(os.pathsep)]:
            environment["PYTHONPATH"] = os.pathsep.join([root, *known])
        return run(spark, *args)

    return started


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """`doc_id` as long, `text` as bytes (null: empty) and the columns to carry along as carried_0, ...; no other columns."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        *[F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)],
    )


def total_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts, counted in one job that reads only the texts."""
    return int(docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)


def hinted(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """`df` marked for a broadcast if a count of its rows and bytes allows it."""
    width = F.sum(sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(8)) for c in df.columns), F.lit(8)))
    found = df.agg(F.count("*"), width).first()
    return F.broadcast(df) if found[0] <= rows and (found[1] or 0) <= size else df


def unused(df: DataFrame, name: str) -> str:
    """`name`, or a longer one that `df` has no column of, whatever the case of its letters."""
    held = {c.lower() for c in df.columns}
    while name in held:
        name += "_"
    return name


def power_of_two(least: float) -> int:
    n = 1
    while n < least:
        n *= 2
    return n


def chunk_count(size: int) -> int:
    """Chunks for texts of `size` bytes: at most about CHUNK_BYTES each, and enough to spread over tasks."""
    return max(MIN_CHUNKS, -(-size // CHUNK_BYTES))


def chunked(docs: DataFrame, chunks: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """`texts(docs)` with the number of the chunk each document belongs to, and columns to carry along as carried_0, ...

    The chunk is a hash of the id, so it is the same whenever a task is run again. Rows
    without an id are dealt by their text.
    """
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id", F.lit(7)))
    return texts(docs, carry).withColumn("chunk", F.pmod(key, F.lit(chunks)).cast("int"))


def hand_back() -> None:
    """Give memory that is free inside this process back to the machine, where its C library can."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(work: Callable) -> Callable:
    """`work` on batches (a generator), or on a key and one or two tables, followed by `hand_back`.

    Spark uses its Python workers again: those a stage is done with would keep the most they ever held beside
    the workers and the JVM of the next. Groups of under a megabyte leave too little behind to look for.
    """
    if inspect.isgeneratorfunction(work):

        def whole(batches):
            yield from work(batches)
            hand_back()

        return whole

    def run(key, *tables):
        made = work(key, *tables)
        if sum(t.nbytes for t in (*tables, made)) >= 1 << 20:
            hand_back()
        return made

    if len(inspect.signature(work).parameters) == 2:
        return lambda key, table: run(key, table)
    return lambda key, left, right: run(key, left, right)


def binary_column(table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow binary column one after another, and the n + 1 places where its values begin."""
    import pyarrow as pa

    column = table.column(name)
    column = column.cast(pa.large_binary()).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def ids_column(table, name: str) -> np.ndarray:
    """A column of longs; null becomes NO_ID."""
    return table.column(name).combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class StringHash:
    """64-bit hashes of substrings: powers of an odd base over random values for the 256 bytes."""

    def __init__(self, seed: int, reach: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1, 1 << 61)) * 8 + 5
        self.powers = self._series(base, reach)
        self.inverses = self._series(pow(base, -1, 1 << 64), reach)

    @staticmethod
    def _series(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base & ((1 << 64) - 1), np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Running sums over `data`, which may be as long as `reach`."""
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.inverses[start])
