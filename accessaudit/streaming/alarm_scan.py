"""Alarms taken from the result table again and again, each exactly once.

`results.alarms_since` asks for everything after a moment. Here the moment is kept: every scan
reads the result batches written since the scan before as a stream with a checkpoint, so it opens
only files it has not seen, and a stored high-water mark bounds by `update_time` what counts as new.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accessaudit.operators.results import alarms_since
from accessaudit.session import folder_done, rows_at
from accessaudit.sources.sinks import write_batch

MARK = "since_ms bigint, alarms bigint"


@dataclass
class AlarmScan:
    """Scans of the result table at `results` (a partition for each batch), kept below `folder`.

    `since_ms` is where the first scan starts: results not updated later are never alarms. Rows that come
    later with an older clock are alarms all the same, since the files decide what is new; the mark tells how far the
    table had got, and bounds nothing but the first scan.
    """

    results: str
    schema: StructType
    folder: str
    since_ms: int = -1

    @property
    def alarms(self) -> str:
        return f"{self.folder.rstrip('/')}/alarms"

    @property
    def marks(self) -> str:
        return f"{self.folder.rstrip('/')}/marks"

    def mark(self, spark: SparkSession, batch_id: int) -> int:
        """The greatest update time before a batch, `since_ms` at first."""
        if batch_id == 0:
            return self.since_ms
        before = rows_at(spark, f"{self.marks}/batch_id={batch_id - 1}", MARK)
        if not before:
            raise ValueError(f"{self.folder} holds no scan {batch_id - 1}: the checkpoint belongs to another folder")
        return before[0]["since_ms"]

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """The body of `foreachBatch`. A scan that is run again finds what it has written."""
        spark = batch.sparkSession
        if rows_at(spark, f"{self.marks}/batch_id={batch_id}", MARK):
            return
        path = f"{self.alarms}/batch_id={batch_id}"
        known = batch.where("update_time IS NOT NULL")
        if not folder_done(spark, path):
            write_batch(alarms_since(known, self.since_ms), self.alarms, batch_id)
        count = spark.read.parquet(path).count()
        seen = known.agg(F.max("update_time")).first()[0]
        greatest = max(x for x in (self.mark(spark, batch_id), seen) if x is not None)
        write_batch(spark.createDataFrame([(greatest, count)], MARK), self.marks, batch_id, 1)

    def scan(self, spark: SparkSession) -> None:
        """Take what the result table got since the last scan."""
        stream = spark.readStream.schema(self.schema).parquet(self.results).writeStream.foreachBatch(self.take)
        query = stream.option("checkpointLocation", f"{self.folder.rstrip('/')}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()

    def all_alarms(self, spark: SparkSession) -> DataFrame:
        """`pid, username, level, message` of all scans together. The table at `alarms` also tells the scan, as `batch_id`."""
        schema = "pid bigint, username string, level int, message string"
        return spark.read.schema(schema).parquet(self.alarms).drop("batch_id")
