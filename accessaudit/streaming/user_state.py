"""The ip-to-user map as keyed state of a stream.

Each ip is a key whose state is the last login seen there, kept in the RocksDB state store and
updated in place, with a time to live if asked for. A micro-batch costs what it brings, whatever the
size of the map, and gives out only the entries it changed; the whole map is read from the
checkpoint's state. `job.current_user_map` is the same map folded from stored batches.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from accessaudit.functions import map_key
from accessaudit.sources.sinks import write_batch

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package

STATE = "latest"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
AT_ONCE = {"availableNow": True}


def login_entries(logins: DataFrame, order: list[str]) -> DataFrame:
    """`key, *order, user` of logins with a user and an ip: what the map is made of."""
    known = logins.where(F.col("user").isNotNull() & F.col("ip").isNotNull())
    return known.select(map_key("ip").alias("key"), *order, "user")


def _later(a: tuple, b: tuple) -> bool:
    """Whether `a` comes after `b`, column by column; NULL comes before all else."""
    rank = lambda row: tuple((x is not None, x) if x is not None else (False,) for x in row)
    return rank(a) > rank(b)


class LatestUser(StatefulProcessor):
    """Keeps the greatest `(*order, user)` of a key and gives it out when it changes."""

    def __init__(self, names: list[str], state: str, ttl_ms: int | None):
        self.names, self.state, self.ttl_ms = names, state, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState(STATE, self.state, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        best = None
        for row in rows:
            entry = tuple(row)[1:]
            if best is None or _later(entry, best):
                best = entry
        if best is not None and (not self.latest.exists() or _later(best, tuple(self.latest.get()))):
            self.latest.update(best)
            yield Row(**dict(zip(self.names, (*key, *best), strict=True)))

    def close(self) -> None:
        pass


def newest_of_batches(entries: DataFrame) -> DataFrame:
    """One entry for each key and Arrow batch, so that an ip with a third of all logins is no hot key of the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names = batch.schema.names[1:]
                order = pc.sort_indices(batch, sort_keys=[(n, "ascending") for n in names], null_placement="at_start")
                rows = batch.take(order)
                keys = rows.column(0).dictionary_encode().indices.to_numpy()
                _, last = np.unique(keys[::-1], return_index=True)
                yield rows.take(pa.array(len(keys) - 1 - np.sort(last)))

    return entries.mapInArrow(run, entries.schema)


def keyed_user_map(entries: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """The entries of a stream of `login_entries` that change the map, as they change it.

    With `ttl_ms` an entry is forgotten when it has not changed for so long; the stream then
    also runs batches without data, to clean up.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entries.schema.fields[1:])
    whole = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entries.schema.fields)
    return newest_of_batches(entries).groupBy("key").transformWithState(
        LatestUser(entries.columns, schema, ttl_ms), outputStructType=whole, outputMode="Update", timeMode="None" if ttl_ms is None else "ProcessingTime"
    )


@contextmanager
def _rocksdb(spark: SparkSession):
    """The state store of queries started meanwhile; their checkpoint remembers it."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def start_user_map(
    entries: DataFrame, checkpoint: str, changes: str | None = None, ttl_ms: int | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the map of a stream of `login_entries` in the state of `checkpoint`.

    Changed entries are written below `changes`, a partition for each batch, for a
    key-value store that follows the map.
    """

    def give_out(batch: DataFrame, batch_id: int) -> None:
        if changes is None:
            batch.write.format("noop").mode("overwrite").save()
        else:
            write_batch(batch, changes, batch_id)

    stream = keyed_user_map(entries, ttl_ms).writeStream.outputMode("update").foreachBatch(give_out)
    with _rocksdb(entries.sparkSession):
        return stream.option("checkpointLocation", checkpoint).trigger(**(trigger or AT_ONCE)).start()


def run_out(query: StreamingQuery, poll: float = 0.1) -> None:
    """Wait until the query has taken what its source had when it started.

    State with a time to live makes batches without data for ever. The second of these ends it: the
    first may be one that an earlier run left unfinished, planned before the data now there.
    """
    while query.isActive:
        if sum(p["numInputRows"] == 0 for p in query.recentProgress) > 1:
            query.stop()
        time.sleep(poll)
    if query.exception() is not None:
        raise query.exception()


def state_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The map as the last finished batch left it: `key, *order, user`, read from the state."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", STATE).load()
    value = "value.value" if "value" in state.schema["value"].dataType.fieldNames() else "value"
    return state.select("key.key", f"{value}.*")


def state_sizes(query: StreamingQuery) -> list[dict[str, int]]:
    """Keys held, keys changed and memory used after each batch."""
    sizes = []
    for progress in query.recentProgress:
        for state in progress["stateOperators"]:
            sizes.append(
                {"batch": progress["batchId"], "keys": state["numRowsTotal"], "changed": state["numRowsUpdated"], "bytes": state["memoryUsedBytes"]}
            )
    return sizes
