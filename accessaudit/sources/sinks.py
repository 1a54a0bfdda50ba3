"""Sinks for results, map entries and alarms."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice
from math import ceil
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

ROWS_PER_FILE = 1_000_000


def write_batch(df: DataFrame, folder: str, batch_id: int, rows: int | None = None) -> None:
    """Write one micro-batch as the partition `batch_id=<n>` of the table at `folder`.

    A replay of the batch overwrites the same partition, so the table ends up the same.
    With the number of rows known, tasks are merged (no shuffle) into files of a good size.
    """
    if rows is not None:
        df = df.coalesce(max(1, ceil(rows / ROWS_PER_FILE)))
    df.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def append_missing(rows: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows not yet in `existing`: what a replayed batch still has to append to a sink that
    cannot overwrite. Filter `existing` to the batch at hand first."""
    return rows.join(existing.select(*key).distinct(), key, "left_anti")


def append_once(
    rows: DataFrame,
    existing: Callable[[int, int], DataFrame],
    key: str,
    append: Callable[[DataFrame], None],
) -> None:
    """Append the rows that the sink does not hold yet, told by all their columns.

    `existing(low, high)` reads the sink within the range of the rows' keys. A row whose key
    the sink holds with other contents was written by somebody else: that is an error, not
    a row delivered before.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    if low is None:
        return
    known = existing(low, high).where(F.col(key).between(low, high)).select(rows.columns)
    held = known.withColumnsRenamed({c: f"held_{c}" for c in rows.columns})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"held_{c}")) for c in rows.columns])
    taken = rows.join(held, F.col(key) == F.col(f"held_{key}")).where(~same)
    if not taken.isEmpty():
        raise ValueError(f"the sink holds other rows under ids from {low} to {high}: take the first id from the sink")
    append(append_missing(rows, known, [key]))


def jdbc_write_options(
    table: str, connection: dict[str, str], batch_size: int = 10_000, connections: int = 16
) -> dict[str, str]:
    """Options of a batched JDBC append: one connection and one transaction per task, at most
    `connections` tasks. A failed task rolls back and fails the batch."""
    return {
        **connection,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        "isolationLevel": "READ_COMMITTED",
    }


def append_jdbc(df: DataFrame, table: str, connection: dict[str, str], **tuning: int) -> None:
    """Append `df` to a database table."""
    df.write.format("jdbc").options(**jdbc_write_options(table, connection, **tuning)).mode("append").save()


def kafka_messages(alarms: DataFrame) -> DataFrame:
    """Alarms as Kafka rows: `key` the result id, `value` the JSON text."""
    return alarms.select(F.col("pid").cast("string").alias("key"), F.col("message").alias("value"))


def publish_kafka(alarms: DataFrame, brokers: str, topic: str) -> None:
    """Publish alarms (needs the connector on the classpath)."""
    options = {"kafka.bootstrap.servers": brokers, "topic": topic}
    kafka_messages(alarms).write.format("kafka").options(**options).save()


def send_partitions(
    df: DataFrame,
    connect: Callable[[], Any],
    send: Callable[[Any, list[Row]], None],
    batch_size: int = 500,
) -> None:
    """Hand the rows to an external client, task by task.

    `connect` opens one client per task, `send` gets up to `batch_size` rows at a time, and
    the client is closed whatever happens. An error fails the task and so the batch. Use it
    for a key-value store (`set` of key and user) or a channel (`publish` of the message);
    delivery is at least once, so `send` should tolerate repeats.
    """

    def run(rows: Iterator[Row]) -> None:
        client = connect()
        try:
            while chunk := list(islice(rows, batch_size)):
                send(client, chunk)
        finally:
            client.close()

    df.foreachPartition(run)
