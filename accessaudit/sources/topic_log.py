"""A topic kept as files, so that a read can start at given offsets and open only what it needs.

Records (`part`, `off` and others) are laid out in places, folders for a batch, a slot (the topic partitions' number modulo
SLOTS) and a span of offsets; inside one they are sorted by partition and offset. An
index tells which offsets of which partition a place holds. Reading from offsets asks the index for the
places that hold something at or after them; their names, one key for all three, prune the scan while the query runs (dynamic partition
pruning), and the least start offset skips row groups by their minima and maxima.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accessaudit.operators.lookup import as_measured, join_measured
from accessaudit.session import folder_done
from accessaudit.sources.sinks import write_batch

SLOTS = 256
SPAN = 1 << 20
INDEX = "batch_id int, place string, part int, first bigint, last bigint, rows bigint"


@dataclass(frozen=True)
class TopicLog:
    """Records at `folder`; `schema` is that of what is appended: `part int, off bigint` and any others.

    Columns named like the layout's (`batch_id`, `place`) are refused. A log keeps the `span` and `slots` it was begun with.
    """

    folder: str
    schema: StructType
    span: int = SPAN
    slots: int = SLOTS

    @property
    def records(self) -> str:
        return f"{self.folder.rstrip('/')}/records"

    @property
    def index(self) -> str:
        return f"{self.folder.rstrip('/')}/index"

    def append(self, records: DataFrame, batch_id: int) -> None:
        """Add a batch; one that is appended again takes its own place. Records without a partition or offset are refused.

        A task gets what one folder takes, at most `span` offsets of each of its partitions, whatever share one partition has.
        The index is written last, and a batch that the index does not know is not read.
        """
        taken = {"batch_id", "place"} & {c.lower() for c in records.columns}
        if taken:
            raise ValueError(f"columns of the layout: {sorted(taken)}")
        spark = records.sparkSession
        for name in ("part", "off"):
            told = F.raise_error(F.lit(f"a record without {name}"))
            records = records.withColumn(name, F.when(F.col(name).isNull(), told.cast(self.schema[name].dataType)).otherwise(F.col(name)))
        slot, span = F.pmod("part", F.lit(self.slots)), F.floor(F.col("off") / self.span)
        place = F.concat_ws(".", F.lit(batch_id), slot.cast("string"), span.cast("string"))
        placed = records.select(*self.schema.names, place.alias("place"))
        placed = placed.repartition("place").sortWithinPartitions("place", "part", "off")
        placed.write.mode("overwrite").partitionBy("place").parquet(f"{self.records}/batch_id={batch_id}")
        held = spark.read.schema(self._laid_out()).parquet(f"{self.records}/batch_id={batch_id}")
        held = held.groupBy("place", "part").agg(F.min("off").alias("first"), F.max("off").alias("last"), F.count("*").alias("rows"))
        write_batch(held, self.index, batch_id)

    def _laid_out(self) -> StructType:
        return StructType(list(self.schema)).add("place", "string")

    def _known(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(INDEX).parquet(self.index)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], INDEX)

    def holds(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether a batch has been appended whole."""
        return folder_done(spark, f"{self.index}/batch_id={batch_id}")

    def needed(self, spark: SparkSession, starts: DataFrame) -> DataFrame:
        """The places with records at or after `starts` (`part, off`, one row per partition)."""
        begin = starts.select("part", F.col("off").alias("_start"))
        known = join_measured(self._known(spark), begin, "part", "left")
        return known.where("last >= _start").select("place").distinct()

    def read_from(self, spark: SparkSession, starts: DataFrame) -> DataFrame:
        """The records at or after the `off` of their `part` in `starts`; partitions not listed there are not read.

        An empty log or no starts give no rows. The places are few (one for `span` offsets of a slot) and
        measured: beyond a broadcast the read is not pruned by them, and gives the same rows.
        """
        columns = list(self.schema.names)
        least = starts.agg(F.min("off")).first()[0]
        needed = as_measured(self.needed(spark, starts))
        if least is None or needed.rows == 0:
            return spark.createDataFrame([], self.schema)
        log = spark.read.schema(self._laid_out().add("batch_id", "integer")).parquet(self.records).where(F.col("off") >= least)
        # the filter, true for all, tells Spark that the list of places is worth pruning by
        places = needed.frame.where(F.length("place") > 0)
        log = log.join(F.broadcast(places) if needed.fits else places, "place", "left_semi")
        found = join_measured(log.select(*columns), starts.select("part", F.col("off").alias("_start")), "part", "left")
        return found.where(F.col("off") >= F.col("_start")).select(*columns)
