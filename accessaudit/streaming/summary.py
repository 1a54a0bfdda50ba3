"""Verdict counts per day over a stream, given out once the day is over.

Two steps, because a windowed aggregate drops late rows without a trace. `VerdictLog` audits each
micro-batch once and marks every verdict: on time, late (its day was over, by the greatest request time of earlier
batches less `delay`) or untimed. `summary_stream` counts the rows on time in event-time windows with
a watermark of the same delay and appends each day when it is over; none of its rows can be late,
since its own watermark never runs ahead of the log's. The late ones stay in the log and are counted there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accessaudit.functions import iso_timestamp
from accessaudit.plans.audit import References, audit_records
from accessaudit.session import folder_done, rows_at
from accessaudit.sources.sinks import write_batch

DAY = 86_400
MARKS = "seconds bigint, on_time bigint, late bigint, untimed bigint"
ON_TIME, LATE, UNTIMED = "on time", "late", "untimed"


def day_of(seconds: Column) -> Column:
    """The UTC day of epoch seconds as text, in any session time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / DAY).cast("int")).cast("string")


@dataclass
class VerdictLog:
    """Verdicts of a record stream below `folder`, a partition for each batch, with `arrival`.

    `marks` has for each batch the greatest event time so far less `delay_seconds`, and how many
    rows came on time, late and untimed. A batch that is run again finds what it has written.
    """

    load: Callable[[SparkSession], References]
    folder: str
    identity: tuple[str, ...]
    delay_seconds: int = DAY

    @property
    def rows(self) -> str:
        return f"{self.folder.rstrip('/')}/rows"

    @property
    def marks(self) -> str:
        return f"{self.folder.rstrip('/')}/marks"

    def mark(self, spark: SparkSession, batch_id: int) -> int | None:
        """The watermark a batch meets: None before the first event."""
        if batch_id == 0:
            return None
        before = rows_at(spark, f"{self.marks}/batch_id={batch_id - 1}", MARKS)
        if not before:
            raise ValueError(f"{self.folder} holds no batch {batch_id - 1}: the checkpoint belongs to another folder")
        return before[0]["seconds"]

    def verdicts(self, batch: DataFrame, mark: int | None) -> DataFrame:
        seconds = F.unix_seconds(F.col("event_ts"))
        over = F.lit(False) if mark is None else (F.floor(seconds / DAY) + 1) * DAY <= mark
        arrival = F.when(F.col("event_ts").isNull(), UNTIMED).when(over, LATE).otherwise(ON_TIME)
        found = audit_records(batch, self.load(batch.sparkSession)).withColumn("event_ts", iso_timestamp("requestTime"))
        return found.select(*self.identity, "packet_no", "event_ts", "type", "sysid", arrival.alias("arrival"))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The body of `foreachBatch`: one pass over the batch, which also counts it."""
        spark = batch.sparkSession
        if rows_at(spark, f"{self.marks}/batch_id={batch_id}", MARKS):
            return
        mark, path = self.mark(spark, batch_id), f"{self.rows}/batch_id={batch_id}"
        counts = [F.max(F.unix_seconds("event_ts")).alias("greatest")]
        counts += [F.count_if(F.col("arrival") == a).alias(a.replace(" ", "_")) for a in (ON_TIME, LATE, UNTIMED)]
        if folder_done(spark, path):  # a reader may have taken these files already
            seen = spark.read.parquet(path).agg(*counts).first().asDict()
        else:
            metrics = Observation()
            write_batch(self.verdicts(batch, mark).observe(metrics, *counts), self.rows, batch_id)
            seen = metrics.get
        known = [x for x in (mark, None if seen["greatest"] is None else seen["greatest"] - self.delay_seconds) if x is not None]
        row = (max(known, default=None), seen["on_time"], seen["late"], seen["untimed"])
        write_batch(spark.createDataFrame([row], MARKS), self.marks, batch_id, 1)

    def start(self, records: DataFrame, checkpoint: str, trigger: dict) -> StreamingQuery:
        stream = records.writeStream.foreachBatch(self.write).option("checkpointLocation", checkpoint)
        return stream.trigger(**trigger).start()

    def stream(self, spark: SparkSession) -> DataFrame:
        """The rows as a stream, batch after batch as they are written."""
        schema = spark.read.parquet(self.rows).schema
        return spark.readStream.schema(schema).parquet(self.rows)

    def late_counts(self, spark: SparkSession) -> DataFrame:
        """How many verdicts came too late, or had no time: `arrival, type, request_day, subsystem, visits`."""
        missed = spark.read.parquet(self.rows).where(F.col("arrival") != ON_TIME)
        keys = ("arrival", "type", day_of(F.unix_seconds("event_ts")).alias("request_day"), F.col("sysid").alias("subsystem"))
        return missed.groupBy(*keys).agg(F.count(F.lit(1)).alias("visits"))


def summary_stream(rows: DataFrame, delay_seconds: int = DAY) -> DataFrame:
    """`type, request_day, subsystem, visits` of a stream of verdicts with `event_ts`: each day once, when it is over."""
    timed = rows.withWatermark("event_ts", f"{delay_seconds} seconds")
    counted = timed.groupBy(F.window("event_ts", "1 day").alias("day"), "type", "sysid").agg(F.count(F.lit(1)).alias("visits"))
    return counted.select("type", day_of(F.unix_seconds("day.start")).alias("request_day"), F.col("sysid").alias("subsystem"), "visits")


def start_summary(log: VerdictLog, spark: SparkSession, into: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Append finished days of the log's rows on time to the table at `into`, each exactly once."""
    rows = log.stream(spark).where(F.col("arrival") == ON_TIME)
    stream = summary_stream(rows, log.delay_seconds).writeStream.format("parquet").outputMode("append")
    return stream.option("checkpointLocation", checkpoint).trigger(**trigger).start(into)
