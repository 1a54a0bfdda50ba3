"""Hooks for `AuditJob.on_batch` that hand a written batch to outside systems.

They run after the batch's own tables are written and before its ledger entry, so a failure
fails the batch, and the batch is delivered again when it is re-run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accessaudit.operators.identity import short_user_pairs, user_ip_rows
from accessaudit.schemas import LOGIN_SUCCEEDED, RESULT_COLUMNS
from accessaudit.sources import sinks, tables
from accessaudit.sources.two_phase import write_committed

Hook = Callable[[dict[str, DataFrame], int], None]


def all_of(*hooks: Hook) -> Hook:
    """Run several hooks in turn."""

    def deliver(batch: dict[str, DataFrame], batch_id: int) -> None:
        for hook in hooks:
            hook(batch, batch_id)

    return deliver


def greatest_pid(table: str, connection: dict[str, str]) -> Callable[[SparkSession], int]:
    """The last id a database table holds, for `AuditJob.base_pid`; 0 if it is empty. The
    maximum is left to the database."""

    def ask(spark: SparkSession) -> int:
        source = tables.TableSource("jdbc", options={"pushDownAggregate": "true", **connection})
        return tables.read_table(spark, source, table).agg(F.max("pid")).first()[0] or 0

    return ask


def jdbc_results(table: str, connection: dict[str, str], readers: int = 8, **tuning: int) -> Hook:
    """Append the results of each batch to a database table, every row once.

    Rows and ids are the same when a batch is re-run, so rows an earlier try managed to
    commit are recognised, by all their columns. Only the batch's own range of ids is read back, by
    up to `readers` connections. Ids that hold other rows fail the batch.
    """

    def deliver(batch: dict[str, DataFrame], batch_id: int) -> None:
        rows = batch["results"].select(*RESULT_COLUMNS)
        source = tables.TableSource("jdbc", options=connection)

        def existing(low: int, high: int) -> DataFrame:
            split = {"split_on": "pid", "bounds": (low, high + 1), "partitions": readers}
            return tables.read_table(rows.sparkSession, source, table, **split)

        sinks.append_once(rows, existing, "pid", lambda new: sinks.append_jdbc(new, table, connection, **tuning))

    return deliver


def jdbc_user_ips(table: str, connection: dict[str, str], below: int = 8, **tuning: int) -> Hook:
    """Append the users seen in each batch to the user-ip history: `ip, username, update_time`.

    A re-run appends its rows again; readers of the history take the latest row of an ip.
    """

    def deliver(batch: dict[str, DataFrame], batch_id: int) -> None:
        seen = batch["results"].where(F.col("type") == LOGIN_SUCCEEDED)
        sinks.append_jdbc(user_ip_rows(short_user_pairs(seen, below)), table, connection, **tuning)

    return deliver


def kafka_alarms(brokers: str, topic: str) -> Hook:
    """Publish the alarms of each batch; a re-run publishes them again with the same ids."""

    def deliver(batch: dict[str, DataFrame], batch_id: int) -> None:
        sinks.publish_kafka(batch["alarms"], brokers, topic)

    return deliver


def client_alarms(connect: Callable, publish_many: Callable, clients: int = 16) -> Hook:
    """Publish the alarm texts through a client of the caller: `publish_many(client, texts)`, a
    chunk at a time, by at most `clients` clients at once."""

    def deliver(batch: dict[str, DataFrame], batch_id: int) -> None:
        def send(client, chunk):
            publish_many(client, [row["message"] for row in chunk])

        sinks.send_partitions(batch["alarms"].select("message").coalesce(clients), connect, send)

    return deliver


def client_user_map(connect: Callable, put_many: Callable, clients: int = 16) -> Hook:
    """Set the map entries of each batch in a key-value store: `put_many(client, entries)`, a
    chunk of (key, user) pairs at a time, by at most `clients` clients at once.

    A batch holds one entry per key, so the order of tasks does not matter.
    """

    def deliver(batch: dict[str, DataFrame], batch_id: int) -> None:
        def send(client, chunk):
            put_many(client, [(row["key"], row["user"]) for row in chunk])

        sinks.send_partitions(batch["user_map"].select("key", "user").coalesce(clients), connect, send)

    return deliver


def committed_results(path: str) -> Callable[[dict[str, DataFrame], int], None]:
    """An `on_batch` hook that adds each batch's results to a two-phase table, whole and once."""
    return lambda tables, batch_id: write_committed(tables["results"], path, batch_id)
