"""Large reference tables laid out once by their key, so that traffic alone is shuffled to meet them.

A reference table beyond a broadcast is shuffled for every micro-batch by `lookup.join_measured`. Here it
is written once into buckets, sorted, and each batch sends only its own rows to the buckets. Hot keys would all go to one
bucket: they are found in the batch, their few reference rows are broadcast, and their traffic is dealt evenly by a key
that matches nothing, as is traffic without a key. All in one pass over the batch.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessaudit.operators.lookup import as_measured, find_spread
from accessaudit.session import fresh_folder

NOBODY = "\x00"  # no key of traffic or reference starts with it


@dataclass(frozen=True)
class LaidOut:
    """A bucketed table of this session's catalog, its key and its number of rows."""

    table: DataFrame
    name: str
    on: str
    buckets: int

    def drop(self) -> None:
        """Forget the table; the files stay in the shared folder."""
        self.table.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def lay_out(side: DataFrame, on: str, buckets: int | None = None, folder: str | None = None) -> LaidOut:
    """Write `side` in buckets of its text column `on`; rows without a key meet nothing and are left out.

    `buckets` is by default the number of shuffle partitions. A task writes one bucket, so there is one file for each.
    """
    spark = side.sparkSession
    if side.schema[on].dataType.simpleString() != "string":
        raise ValueError("tables are laid out by text keys")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"laid_out_{uuid.uuid4().hex}"
    known = side.where(F.col(on).isNotNull()).repartition(buckets, on)
    known.write.bucketBy(buckets, on).sortBy(on).option("path", folder or fresh_folder(spark, "laid-out")).saveAsTable(name)
    return LaidOut(spark.table(name), name, on, buckets)


def join_laid_out(fact: DataFrame, side: LaidOut, how: str) -> DataFrame:
    """Join `fact` with a laid out table on its key (`left` or `left_semi`): the rows of `lookup.join_measured`.

    The table is not shuffled. If the hot keys' own reference rows are beyond a broadcast, their traffic goes
    to the buckets like the rest.
    """
    if how not in ("left", "left_semi"):
        raise ValueError(how)
    on, spark = side.on, fact.sparkSession
    added = [c for c in side.table.columns if c != on] if how == "left" else []
    hot = find_spread(fact, on).hot.select(F.col(on).alias("_hot")) if not fact.isStreaming else None
    rows = fact.withColumn("_met", F.lit(False))
    if hot is not None and not hot.isEmpty():  # at most one row for each shuffle partition
        theirs = side.table.join(F.broadcast(hot), F.col(on) == F.col("_hot"), "left_semi")
        if how == "left_semi":
            theirs = theirs.select(on).distinct()
        theirs = as_measured(theirs.select(F.col(on).alias("_key"), *[F.col(f"`{c}`").alias(f"_hot_{c}") for c in added]))
        if theirs.fits:
            keys = hot.withColumn("_met", F.lit(True))
            rows = fact.join(F.broadcast(keys), F.col(on) == F.col("_hot"), "left")
            rows = rows.withColumn("_met", F.coalesce("_met", F.lit(False))).drop("_hot")
            rows = rows.join(F.broadcast(theirs.frame), F.col(on) == F.col("_key"), "left")
    held = "_key" in rows.columns
    dealt = F.concat(F.lit(NOBODY), F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in fact.columns]).cast("string"))
    rows = rows.withColumn("_place", F.when(F.col("_met") | F.col(on).isNull(), dealt).otherwise(F.col(on)))
    table = side.table.select(F.col(on).alias("_place"), *[F.col(f"`{c}`").alias(f"_of_{c}") for c in added])
    columns = [F.col(f"`{c}`") for c in fact.columns]
    if how == "left":
        joined = rows.join(table.hint("merge"), "_place", "left")
        found = [
            (F.when(F.col("_met"), F.col(f"`_hot_{c}`")).otherwise(F.col(f"`_of_{c}`")) if held else F.col(f"`_of_{c}`")).alias(c) for c in added
        ]
        return joined.select(*columns, *found)
    table = table.withColumn("_there", F.lit(True)).dropDuplicates(["_place"]) if held else table
    if not held:
        return rows.join(table.hint("merge"), "_place", "left_semi").select(*columns)
    joined = rows.join(table.hint("merge"), "_place", "left")
    return joined.where(F.when(F.col("_met"), F.col("_key").isNotNull()).otherwise(F.col("_there").isNotNull())).select(*columns)
