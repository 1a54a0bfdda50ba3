"""Exact nearest neighbours by branch and bound over columns.

Vectors are packed into blocks that store one dimension after another. Every block of queries
meets every block of candidates. Inner products grow by a few dimensions at a time; what the
rest can still add is at most the product of the two remaining lengths, so a candidate
whose bound is below the query's k-th best score is dropped and the others are compacted.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
EVERY = 50
CANDIDATES = 16384  # in a block
QUERIES = 1024
DIMENSIONS = 16  # added at a time
DENSE = 0.2  # while more than this share survives, whole columns are multiplied
MIN_BLOCKS = 24


def _scaled(embedding: Column) -> Column:
    return F.transform(embedding.cast("array<double>"), lambda x: F.floor(F.lit(SCALE) * x).cast("long"))


def vectors(table: DataFrame) -> DataFrame:
    """vec_id and the scaled components `v` of the rows that take part: an id, and finite components throughout."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    table = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    return table.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & F.forall("e", finite)).select(
        "vec_id", _scaled(F.col("e")).alias("v"), F.size("e").alias("dimensions")
    )


def _pack(key, table):
    """One row: the distinct vectors of a block by id, dimension by dimension."""
    d = key[0].as_py()
    ids = table.column("vec_id").to_numpy()
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    rows = np.unique(np.column_stack([ids, flat.reshape(len(ids), d)]), axis=0)
    columns = np.ascontiguousarray(rows[:, 1:].T)
    return pa.table(
        {"dimensions": pa.array([d], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()), "ids": [rows[:, 0].tobytes()], "columns": [columns.tobytes()]}
    )


def blocks(table: DataFrame, size: int, salt: int, least: int) -> tuple[DataFrame, int]:
    """Vectors packed into blocks of about `size`, and how many blocks there are of each number of dimensions."""
    count = max(least, -(-table.count() // size))
    block = F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(count)).cast("int")
    packed = table.withColumn("block", block).groupBy("dimensions", "block")
    return packed.applyInArrow(_pack, "dimensions int, block int, ids binary, columns binary"), count


class _Best:
    """The k best candidates so far of each query id: highest score first, then smallest id; an id counts once."""

    def __init__(self, queries: int, k: int):
        self.k, self.least = k, np.full(queries, -np.inf)
        self.query, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0, np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        kind = score.dtype
        query, ids = np.concatenate([self.query, query]), np.concatenate([self.id, ids])
        score = np.concatenate([self.score.astype(kind), score])
        order = np.lexsort((-score, ids, query))
        query, score, ids = query[order], score[order], ids[order]
        once = np.r_[True, (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])][: len(query)]
        query, score, ids = query[once], score[once], ids[once]
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        top = rank < self.k
        self.query, self.score, self.id = query[top], score[top], ids[top]
        full = rank == self.k - 1
        self.least[query[full]] = score[full].astype(float)


def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, columns: np.ndarray, k: int):
    """(query id, candidate id, score) of the k best of one block; `queries` row by row, `columns` by dimension."""
    d = len(columns)
    peak = max(int(np.abs(queries).max(initial=0)), int(np.abs(columns).max(initial=0)))
    exact = peak * peak * max(d, 1) < 1 << 53
    names, owner = np.unique(query_ids, return_inverse=True)
    best = _Best(len(names), k)
    if not exact:  # numbers too large for doubles: whole products, no bounds
        queries, columns = queries.astype(object), columns.astype(object)
        for low in range(len(ids)):
            score = queries @ columns[:, low] if d else np.zeros(len(queries), object)
            other = query_ids != ids[low]
            best.add(owner[other], score[other], np.full(int(other.sum()), ids[low]))
        return names[best.query], best.id, best.score
    order = np.argsort(-(columns.astype(float) ** 2).sum(axis=1), kind="stable")
    queries, columns = queries[:, order].astype(float), columns[order].astype(float)
    edges = [*range(0, d, DIMENSIONS), d] if d else [0, 0]
    rest = lambda x: np.sqrt([(x[e:] ** 2).sum(axis=0) for e in edges[1:]]) * (1 + 1e-9)
    query_rest, rests = rest(queries.T), rest(columns)
    low, step = 0, 64
    while low < len(ids):
        high = min(low + step, len(ids))
        least = best.least[owner]
        dense = np.zeros((len(queries), high - low))
        pairs = None
        for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if pairs is None:
                dense += queries[:, a:b] @ columns[a:b, low:high]
                bound = dense + query_rest[n][:, None] * rests[n][None, low:high]
                alive = bound >= least[:, None]
                if n == len(edges) - 2 or alive.mean() <= DENSE:
                    q, c = np.nonzero(alive)
                    pairs = q, c + low, dense[q, c]
            else:
                q, c, score = pairs
                score = score + np.einsum("ij,ij->i", queries[q, a:b], columns[a:b, c].T)
                alive = score + query_rest[n][q] * rests[n][c] >= least[q]
                pairs = q[alive], c[alive], score[alive]
        q, c, score = pairs
        other = ids[c] != query_ids[q]
        best.add(owner[q[other]], score[other], ids[c[other]])
        low, step = high, min(step * 2, 2048)
    return names[best.query], best.id, best.score


def nearest(table: DataFrame, k: int = 5, every: int = EVERY) -> DataFrame:
    """The `k` highest inner products of every query: query_id, rank (from 1), vec_id, score.

    Queries are the rows whose vec_id is divisible by `every`, candidates all rows but those of
    the query's own vec_id; ties go to the smaller vec_id. Defined cases: rows without an id,
    null vectors and vectors with null or non-finite components take no part; vectors meet only
    those of their own number of dimensions; repeated rows count once; a vec_id with several
    vectors is one query and one candidate, with the best of their scores; scores must fit
    a long. Other columns are not read. Fewer candidates than `k` give fewer rows.
    """
    if k < 1 or every < 1:
        raise ValueError("k and every start at 1")
    rows = vectors(table)
    candidates, n_candidates = blocks(rows, CANDIDATES, 1, MIN_BLOCKS)
    queries, n_queries = blocks(rows.where(F.col("vec_id") % every == 0), QUERIES, 2, 1)
    left = queries.select(
        "dimensions", F.col("block").alias("query_block"), F.explode(F.sequence(F.lit(0), F.lit(n_candidates - 1))).alias("block"), "ids", "columns"
    )
    right = candidates.select(
        "dimensions", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("query_block"), "block", "ids", "columns"
    )

    def meet(key, asking, asked):
        found = [], [], []
        if asking.num_rows and asked.num_rows:
            d = key[0].as_py()
            (qi, q), (ci, c) = (
                (np.frombuffer(t.column("ids")[0].as_py(), np.int64), np.frombuffer(t.column("columns")[0].as_py(), np.int64))
                for t in (asking, asked)
            )
            found = search(qi, q.reshape(d, len(qi)).T, ci, c.reshape(d, len(ci)), k)
        return pa.table(
            {"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array([int(x) for x in found[2]], pa.int64())}
        )

    keys = ("dimensions", "query_block", "block")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score long")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
