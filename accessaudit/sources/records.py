"""Record streams and the offsets they resume from."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    brokers: str,
    topics: list[str],
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    group: str | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of the Kafka source: repeated topics count once, no auto-commit (progress
    lives in the checkpoint). Records that age out of the topic unread fail the query; pass
    failOnDataLoss="false" to go on without them."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(sorted(set(topics))),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group is not None:
        options["kafka.group.id"] = group
    return {**options, **extra}


def packet_stream(
    spark: SparkSession, fmt: str, path: str | None = None, schema=None, **options: str
) -> DataFrame:
    """A stream of records with the text in `value`.

    `kafka` (needs the connector on the classpath) also gives `topic, partition, offset`,
    the identity of a record. Any file format works the same; `text` has only `value`.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    records = reader.load(path) if path else reader.load()
    return kafka_records(records) if fmt == "kafka" else records


def kafka_records(records: DataFrame) -> DataFrame:
    """The columns the audit uses of Kafka records."""
    return records.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def resume_offsets(earliest: DataFrame, stored: DataFrame) -> DataFrame:
    """Per partition the greater of the stored and the earliest offset; the earliest where
    nothing is stored. Both inputs are `part, off`, one row per partition."""
    known = stored.select("part", F.col("off").alias("_stored"))
    return earliest.join(known, "part", "left").select(
        "part", F.greatest("off", F.coalesce("_stored", "off")).alias("off")
    )


def starting_offsets(topic: str, offsets: DataFrame) -> str:
    """`startingOffsets` text for the Kafka source. One row per topic partition reaches the
    driver, as many as the broker lists to it anyway."""
    by_partition = {str(r["part"]): r["off"] for r in offsets.orderBy("part").collect()}
    return json.dumps({topic: by_partition})
