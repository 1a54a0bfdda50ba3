"""Joins of traffic with reference tables whose size is measured first.

A list of a few hundred values becomes an `IN` over literals: no join, inside the scan's
own stage, pushed into the scan where the column is stored. A larger table is broadcast,
but only when a count of its rows and bytes says it fits. Beyond that the join is shuffled,
with the hot keys of the traffic spread over as many tasks as their share of the rows asks
for. All ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
LITERAL_ROWS = 1_000
LITERAL_BYTES = 1024 * 1024
SKETCH_ITEMS = 1_000_000  # fixed value: the most items the sketch tracks
HOT_ROWS = 10_000  # a key with fewer rows is not worth spreading
STREAM_SLOTS = 8
SLOTS_PER_SHARE = 4  # slots per fair share of a hot key: small enough that a few may share a task


@dataclass(frozen=True)
class Measured:
    """A reference table with its measured size and the number of NULLs per column."""

    frame: DataFrame
    rows: int
    bytes: int
    nulls: dict[str, int]
    max_rows: int = BROADCAST_ROWS
    max_bytes: int = BROADCAST_BYTES

    @property
    def fits(self) -> bool:
        return self.rows <= self.max_rows and self.bytes <= self.max_bytes

    @property
    def is_short(self) -> bool:
        return self.fits and self.rows <= LITERAL_ROWS and self.bytes <= LITERAL_BYTES

    @property
    def has_null(self) -> bool:
        return any(self.nulls.values())

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Measured:
        """Same size, reshaped frame (renames, filters; nothing that adds rows)."""
        return replace(self, frame=change(self.frame))


@dataclass(frozen=True)
class ShortList:
    """Distinct values of a list known to be short, without its NULL."""

    values: tuple
    has_null: bool
    fits: bool = True


def measure(
    *frames: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> list[Measured]:
    """Size of all `frames` in one job; one row per frame reaches the driver."""

    def size(n: int, frame: DataFrame) -> DataFrame:
        columns = [F.col(f"`{c}`") for c in frame.columns]
        widths = [F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) for c in columns]
        width = reduce(lambda a, b: a + b, widths) + 16
        return frame.agg(
            F.lit(n).alias("n"),
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes"),
            F.array(*[F.count_if(c.isNull()) for c in columns]).alias("nulls"),
        )

    sizes = reduce(DataFrame.unionAll, [size(n, f) for n, f in enumerate(frames)]).collect()
    found = {row["n"]: row for row in sizes}
    return [
        Measured(
            f, found[n]["rows"], found[n]["bytes"], dict(zip(f.columns, found[n]["nulls"])), max_rows, max_bytes
        )
        for n, f in enumerate(frames)
    ]


def as_measured(side: DataFrame | Measured) -> Measured:
    return side if isinstance(side, Measured) else measure(side)[0]


def value_lists(rules: DataFrame | Measured) -> dict[str, ShortList | Measured]:
    """The distinct values of each column of `rules`, as the lists the filters take.

    Each column is judged by itself: one with few distinct values becomes literals, however
    long the table is. Only such values are brought to the driver.
    """
    side = as_measured(rules)
    columns = side.frame.columns
    if side.is_short:
        short = list(columns)
    elif not side.fits and side.max_rows < LITERAL_ROWS:  # a caller who allows next to nothing
        short = []
    else:
        sizes = side.frame.agg(
            *[F.count_distinct(f"`{c}`").alias(f"n{i}") for i, c in enumerate(columns)],
            *[F.max(F.octet_length(F.col(f"`{c}`").cast("string"))).alias(f"w{i}") for i, c in enumerate(columns)],
        ).first()
        short = [
            c
            for i, c in enumerate(columns)
            if sizes[f"n{i}"] <= LITERAL_ROWS and sizes[f"n{i}"] * (sizes[f"w{i}"] or 0) <= LITERAL_BYTES
        ]
    found = side.frame.agg(*[F.collect_set(f"`{c}`").alias(c) for c in short]).first() if short else {}
    return {
        c: ShortList(tuple(sorted(found[c])), bool(side.nulls[c]))
        if c in short
        else replace(side, frame=side.frame.select(F.col(f"`{c}`").alias("value")).distinct(), nulls={"value": side.nulls[c]})
        for c in columns
    }


def as_list(values: DataFrame | Measured | ShortList) -> ShortList | Measured:
    """A one-column frame as a list; lists stay as they are."""
    if isinstance(values, DataFrame):
        return next(iter(value_lists(values).values()))
    return values


@dataclass(frozen=True)
class Spread:
    """How many slots each hot value of a key is spread over. At most one entry per
    shuffle partition, so the table of them is small whatever the data."""

    on: str
    hot: DataFrame
    slots: int  # slots of all rows together, and those of NULL keys
    least: int = 1  # slots of a key that is not hot

    @property
    def column(self) -> str:
        return f"_spread_{self.on}"

    def traffic(self, fact: DataFrame) -> DataFrame:
        """Add the slot of each row: a hash of the row and its partition. A re-run task gives
        the same slots, and even copies of one row differ from partition to partition.

        NULL keys never match; they are spread too instead of meeting in one task.
        """
        if self.column in fact.columns:
            return fact
        slots = F.when(F.col(self.on).isNull(), F.lit(self.slots)).otherwise(
            F.coalesce(F.col("_slots"), F.lit(self.least))
        )
        row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in fact.columns])
        return (
            fact.join(F.broadcast(self.hot), self.on, "left")
            .withColumn(self.column, F.pmod(row_hash, slots).cast("int"))
            .drop("_slots")
            .select(*[f"`{c}`" for c in fact.columns], self.column)
        )

    def reference(self, side: DataFrame) -> DataFrame:
        """Repeat the rows of hot keys once per slot."""
        slots = F.coalesce(F.col("_slots"), F.lit(self.least))
        return (
            side.where(F.col(self.on).isNotNull())
            .join(F.broadcast(self.hot), self.on, "left")
            .withColumn(self.column, F.explode(F.sequence(F.lit(0), slots - 1)))
            .drop("_slots")
        )


def find_spread(fact: DataFrame, on: str, scale: float = 1.0) -> Spread:
    """Values of `on` that hold more rows than one shuffle partition's fair share, and at least HOT_ROWS.
    Each row of `fact` stands for `scale` rows.

    One pass over the key column with a frequent-items sketch (map-side combined). The
    sketch only decides how rows are spread; every row is joined either way.
    """
    spark = fact.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(max(10_000, 4 * partitions), SKETCH_ITEMS)
    found = fact.agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k(`{on}`, {min(partitions, tracked)}, {tracked})").alias("top"),
    ).first()
    rows, top = found["rows"], found["top"] or []
    slots = SLOTS_PER_SHARE * partitions
    hot = [
        (item["item"], ceil(min(item["count"], rows) * slots / rows))
        for item in top
        if item["count"] * partitions > rows and item["count"] * scale >= HOT_ROWS
    ]
    key_type = fact.schema[on].dataType.simpleString()
    return Spread(on, spark.createDataFrame(hot, f"`{on}` {key_type}, _slots int"), slots)


def even_spread(fact: DataFrame, on: str) -> Spread:
    """Every key over STREAM_SLOTS, without a look at the data."""
    key_type = fact.schema[on].dataType.simpleString()
    return Spread(on, fact.sparkSession.createDataFrame([], f"`{on}` {key_type}, _slots int"), STREAM_SLOTS, STREAM_SLOTS)


def join_measured(
    fact: DataFrame,
    side: DataFrame | Measured,
    on: str,
    how: str,
    spread: Spread | None = None,
) -> DataFrame:
    """Join `fact` with a reference table on the column `on` (`left` or `left_semi`).

    The columns are those of `fact`, then those a left join adds, whatever the table's size.
    A `spread` found by the caller is applied once and its slot column kept, last, so several
    large joins on one key share a single shuffle of the traffic. A stream cannot be
    searched for hot keys: there every key is spread over STREAM_SLOTS.
    """
    side = as_measured(side)
    columns = list(fact.columns)
    if how == "left":
        columns += [c for c in side.frame.columns if c != on]
    if side.fits:
        return fact.join(F.broadcast(side.frame), on, how).select(*[f"`{c}`" for c in columns])
    if fact.isStreaming:
        use = even_spread(fact, on)
    else:
        use = spread or find_spread(fact, on)
    joined = use.traffic(fact).join(use.reference(side.frame), [on, use.column], how)
    if spread and use.column not in columns:
        columns.append(use.column)
    return joined.select(*[f"`{c}`" for c in columns])
