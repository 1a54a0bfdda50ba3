"""A Bloom filter of a long list, applied to traffic before it is shuffled to meet the list.

Built by an aggregation: each value sets a few bits, words of 64 bits are combined map-side, and the
filter reaches the tasks as one scalar of at most MOST_BITS bits, whatever the length of the list. Rows that
cannot be members are dropped where they are read; the join that follows removes the few false hits.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StringType

from accessaudit.session import fresh_folder, written

BITS_PER_VALUE = 12  # about one false hit in 200 with HASHES bits a value
HASHES = 5
MOST_BITS = 1 << 26
LEAST_BITS_PER_VALUE = 4  # below, one row in ten and more would pass: no filter


@dataclass(frozen=True)
class ListFilter:
    """The bits of a list, a table of one row with the array `words`, and how many bits there are."""

    words: DataFrame
    bits: int

    def might_hold(self, column: str) -> Column:
        """False for what is not on the list, and for NULL; true for what is, and for few others."""
        words, value = self.words.scalar(), F.col(f"`{column}`")
        tests = []
        for place in _places(value, self.bits):
            word = F.element_at(words, (F.shiftright(place, 6) + 1).cast("int"))
            tests.append(F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return value.isNotNull() & reduce(lambda a, b: a & b, tests)


def _places(value: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(value, F.lit(i)), F.lit(bits).cast("bigint")) for i in range(HASHES)]


def can_filter(kind: DataType, other: DataType) -> bool:
    """Whether equal values of both types have equal hashes."""
    return kind == other and (isinstance(kind, (IntegralType, DateType)) or kind == StringType())


def list_filter(values: DataFrame, rows: int) -> ListFilter | None:
    """The filter of a one-column list of about `rows` values; None if the list is too long for one."""
    bits = 64
    while bits < min(rows * BITS_PER_VALUE, MOST_BITS):
        bits *= 2
    if bits < rows * LEAST_BITS_PER_VALUE:
        return None
    column = values.columns[0]
    known = values.where(F.col(f"`{column}`").isNotNull())
    places = known.select(F.explode(F.array(*_places(F.col(f"`{column}`"), bits))).alias("place"))
    word = places.select(F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 AS int))").alias("bit"))
    held = word.groupBy("word").agg(F.bit_or("bit").alias("set"))
    every = values.sparkSession.range(bits // 64).withColumnRenamed("id", "word")
    whole = every.join(held, "word", "left").select(F.struct("word", F.coalesce("set", F.lit(0).cast("bigint")).alias("set")).alias("w"))
    words = whole.agg(F.array_sort(F.collect_list("w")).alias("w")).select(F.col("w.set").alias("words"))
    # One row of at most MOST_BITS, made once, however often it is asked.
    return ListFilter(written(words, fresh_folder(values.sparkSession, "list-filter")), bits)
