"""The audit as a Structured Streaming job.

Each micro-batch runs the batch plan once, into a stage of its own. Once the stage is complete
its rows, ids and clock are fixed: a batch that is run again, after a failure and perhaps with
other rules, goes on from the stage. All outputs are written from it, as the partition
`batch_id=<n>` of a few tables, and the stage is removed. A batch with a ledger entry is done
and not run again. Failures fail the batch.

    results     result rows with dense ids
    alarms      failed logins
    user_map    last user per ip seen in the batch (see `current_user_map`)
    corrupt     records that could not be parsed
    ledger      how many ids have been given out
    stage, staged   rows of a batch in work, and the first id of each of its tasks
    owner       which checkpoint the folder belongs to
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accessaudit.functions import iso_timestamp
from accessaudit.operators.identity import dedup_replay, ip_user_map, latest_entries
from accessaudit.operators.packets import corrupt_packets, parse_packets, project_flow
from accessaudit.operators.results import LOCAL_BITS, alarm_messages, result_rows
from accessaudit.plans.audit import References, audit_records
from accessaudit.schemas import LOGIN_SUCCEEDED, RESULT_COLUMNS
from accessaudit.session import remove_folder, rows_at, written
from accessaudit.sources.sinks import write_batch

EVERY_THREE_SECONDS = {"processingTime": "3 seconds"}
LEDGER = "first_pid bigint, rows bigint"
STAGED = "task int, first_pid bigint, rows bigint"
OWNER = "owner string"
MOST_LITERALS = 4096  # first ids in an expression; more are joined


@dataclass
class AuditJob:
    """What one micro-batch does. `output` belongs to one checkpoint: `start` refuses a folder
    that another checkpoint has written.

    `load` reads the reference tables; it is called again every `refresh_every` batches.
    `identity` names the columns that identify a record (Kafka: topic, partition, offset).
    `base_pid` is the last id that is taken, or a function that asks the sink for it (see
    `delivery.greatest_pid`); it is read once, for the first batch of a checkpoint.
    `dead_letters` writes the `corrupt` table, for which the batch is read twice and so kept
    meanwhile; bound its size with `maxOffsetsPerTrigger` or `maxFilesPerTrigger`.
    """

    load: Callable[[SparkSession], References]
    output: str
    identity: tuple[str, ...]
    refresh_every: int = 20
    null_policy: str = "sql"
    now_ms: int | None = None
    base_pid: int | Callable[[SparkSession], int] = 0
    dead_letters: bool = True
    on_batch: Callable[[dict[str, DataFrame], int], None] | None = None
    _refs: References | None = field(default=None, repr=False)
    _loaded_at: int = field(default=-1, repr=False)

    def folder(self, table: str) -> str:
        return f"{self.output.rstrip('/')}/{table}"

    def references(self, spark: SparkSession, batch_id: int) -> References:
        """The current reference tables, re-read when due."""
        if self._refs is None or batch_id - self._loaded_at >= self.refresh_every:
            if self._refs is not None:
                self._refs.unpersist()
            self._refs, self._loaded_at = self.load(spark), batch_id
        return self._refs

    def next_pid(self, spark: SparkSession, batch_id: int) -> int:
        """Ids given out before this batch. Batches are numbered without gaps, so the entry of
        the one before says it."""
        if batch_id == 0:
            return self.base_pid(spark) if callable(self.base_pid) else self.base_pid
        last = rows_at(spark, f"{self.folder('ledger')}/batch_id={batch_id - 1}", LEDGER)
        if not last:
            raise ValueError(f"{self.output} holds no batch {batch_id - 1}: the checkpoint belongs to another folder")
        return last[0]["first_pid"] + last[0]["rows"]

    def write_verdicts(self, batch: DataFrame, batch_id: int) -> None:
        """The body of `foreachBatch`."""
        spark = batch.sparkSession
        if rows_at(spark, f"{self.folder('ledger')}/batch_id={batch_id}", LEDGER):
            return
        stage = f"{self.folder('stage')}/batch_id={batch_id}"
        starts = rows_at(spark, f"{self.folder('staged')}/batch_id={batch_id}", STAGED)
        if not starts:
            starts = self._stage(batch, batch_id, stage)
        identity = [*self.identity, "packet_no"]
        results = _with_pid(spark.read.parquet(stage), starts)
        tables = {
            "results": results.select(*identity, *RESULT_COLUMNS),
            "alarms": alarm_messages(results),
            "user_map": ip_user_map(
                results.where(F.col("type") == LOGIN_SUCCEEDED), ["requestTime", *identity]
            ),
        }
        for name, table in tables.items():
            write_batch(table, self.folder(name), batch_id)
        if self.on_batch is not None:
            self.on_batch(
                {n: spark.read.parquet(f"{self.folder(n)}/batch_id={batch_id}") for n in tables}, batch_id
            )
        base, total = min(s["first_pid"] for s in starts), sum(s["rows"] for s in starts)
        write_batch(spark.createDataFrame([(base, total)], LEDGER), self.folder("ledger"), batch_id, 1)
        for done in (stage, f"{self.folder('staged')}/batch_id={batch_id}"):
            remove_folder(spark, done)

    def _stage(self, batch: DataFrame, batch_id: int, stage: str) -> list:
        """Audit the batch into its stage, and record the first id of each task's rows.

        The record is written last: without it the stage is made anew.
        """
        spark = batch.sparkSession
        if self.dead_letters:
            batch = batch.persist()
        try:
            verdicts = audit_records(batch, self.references(spark, batch_id), self.null_policy)
            rows = result_rows(verdicts, *self.identity, "packet_no", now=self.now_ms)
            placed = written(rows.withColumn("_place", F.monotonically_increasing_id()), stage)
            if self.dead_letters:
                write_batch(corrupt_packets(batch), self.folder("corrupt"), batch_id)
        finally:
            if self.dead_letters:
                batch.unpersist()
        task = F.shiftright("_place", LOCAL_BITS).cast("int")
        counts = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("rows")).collect()
        starts, first = [], self.next_pid(spark, batch_id)
        for row in sorted(counts, key=lambda r: r["task"]):
            starts.append(Row(task=row["task"], first_pid=first, rows=row["rows"]))
            first += row["rows"]
        starts = starts or [Row(task=0, first_pid=first, rows=0)]
        write_batch(spark.createDataFrame(starts, STAGED), self.folder("staged"), batch_id, 1)
        return starts

    def claim(self, spark: SparkSession, checkpoint: str) -> None:
        """Tie `output` and the checkpoint to each other, or fail if either belongs elsewhere."""
        mark = f"{checkpoint.rstrip('/')}/audit_owner"
        mine, theirs = rows_at(spark, mark, OWNER), rows_at(spark, self.folder("owner"), OWNER)
        if theirs and mine != theirs:
            raise ValueError(f"{self.output} belongs to another checkpoint; its batches would be overwritten")
        if not mine:
            mine = [Row(owner=uuid.uuid4().hex)]
            spark.createDataFrame(mine, OWNER).coalesce(1).write.parquet(mark)
        if not theirs:
            spark.createDataFrame(mine, OWNER).coalesce(1).write.parquet(self.folder("owner"))

    def start(
        self, records: DataFrame, checkpoint: str, trigger: dict | None = None
    ) -> StreamingQuery:
        """Start the job; `awaitTermination()` on the result runs it until stopped."""
        self.claim(records.sparkSession, checkpoint)
        return (
            records.writeStream.foreachBatch(self.write_verdicts)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY_THREE_SECONDS))
            .start()
        )


def _with_pid(placed: DataFrame, starts: list) -> DataFrame:
    """Add `pid`: the first id of the row's task plus its place there."""
    task, place = F.shiftright("_place", LOCAL_BITS).cast("int"), F.col("_place").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    last = max(s["task"] for s in starts)
    if last < MOST_LITERALS:
        known = {s["task"]: s["first_pid"] for s in starts}
        first = F.element_at(F.array(*[F.lit(known.get(t)).cast("bigint") for t in range(last + 1)]), task + 1)
        return placed.withColumn("pid", first + place + 1).drop("_place")
    first = placed.sparkSession.createDataFrame(starts, STAGED).select(F.col("task").alias("_task"), "first_pid")
    joined = placed.withColumn("_task", task).join(F.broadcast(first), "_task")
    return joined.withColumn("pid", F.col("first_pid") + place + 1).drop("_place", "_task", "first_pid")


def flow_stream(records: DataFrame) -> DataFrame:
    """The flow of a record stream, with `event_ts` as event time."""
    return project_flow(parse_packets(records)).withColumn("event_ts", iso_timestamp("requestTime"))


def distinct_flow_stream(records: DataFrame, identity: list[str], within: str = "10 minutes") -> DataFrame:
    """`flow_stream` without records that came before, less than `within` ago.

    What counts is when a record arrives, not its own time: late records are kept.
    """
    return dedup_replay(flow_stream(records), [*identity, "packet_no"], within)


def current_user_map(spark: SparkSession, folder: str, order: list[str]) -> DataFrame:
    """`key, user` and `order` over all batches of the `user_map` table.

    Batches only add what they saw, so a batch costs its own size and not the size of the
    map; `compact_user_map` folds old batches together.
    """
    return latest_entries(spark.read.parquet(folder), order)


def compact_user_map(spark: SparkSession, folder: str, into: str, order: list[str]) -> None:
    """Write the current map as the single partition of a new `user_map` table at `into`."""
    write_batch(current_user_map(spark, folder, order), into, -1)
