"""Verdict counts per day over a stream, late verdicts beside them."""

from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from accessaudit.operators.results import verdict_summary
from accessaudit.plans import catalog, testbed
from accessaudit.plans.audit import audit_records
from accessaudit.sources.sinks import write_batch
from accessaudit.streaming import summary
from tests.helpers import rows

ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def refs(spark, data):
    return testbed.references(spark, data)


@pytest.fixture
def log(refs, tmp_path):
    return summary.VerdictLog(lambda _: refs, str(tmp_path / "log"), ("event_id",))


def visit(spark, *times):
    """One monitored visit from outside the whitelist at each time."""
    text = '{{"@timestamp":"{}","source":{{"ip":"1.1.1.1"}},"destination":{{"ip":"192.168.0.0","port":8082}},"query":"GET /","http":{{"response":{{"status_code":200}}}}}}'
    return spark.createDataFrame([(i, text.format(t)) for i, t in enumerate(times)], "event_id long, value string")


def marks(spark, log):
    table = spark.read.parquet(log.marks).orderBy("batch_id")
    return [tuple(r)[:4] for r in table.select("seconds", "on_time", "late", "untimed").collect()]


def second(day, hour=0):
    return (19_723 + day - 1) * 86_400 + hour * 3600  # of January 2024


def test_late_and_untimed_rows_are_kept_and_counted(spark, log):
    log.write(visit(spark, "2024-01-01T10:00:00Z", "2024-01-03T06:00:00Z", "no time"), 0)
    log.write(visit(spark, "2024-01-01T11:00:00Z", "2024-01-02T11:00:00Z", "2024-01-02T12:00:00Z"), 1)
    log.write(visit(spark), 2)
    assert marks(spark, log) == [(second(2, 6), 2, 0, 1), (second(2, 6), 2, 1, 0), (second(2, 6), 0, 0, 0)]
    found = {(r["arrival"], r["request_day"], r["visits"]) for r in log.late_counts(spark).collect()}
    assert found == {("late", "2024-01-01", 1), ("untimed", None, 1)}


def test_a_batch_that_is_run_again_keeps_its_files(spark, log):
    batch = visit(spark, "2024-01-01T10:00:00Z")
    log.write(batch, 0)
    files = spark.read.parquet(log.rows).inputFiles()
    log.write(visit(spark, "2024-01-05T10:00:00Z"), 0)
    assert spark.read.parquet(log.rows).inputFiles() == files
    # the mark was lost: it is found again from the rows that are there
    other = summary.VerdictLog(log.load, log.folder + "2", log.identity)
    write_batch(log.verdicts(batch, None), other.rows, 0)
    files = spark.read.parquet(other.rows).inputFiles()
    other.write(visit(spark, "2024-01-05T10:00:00Z"), 0)
    assert spark.read.parquet(other.rows).inputFiles() == files
    assert marks(spark, other) == marks(spark, log)


def test_a_gap_in_the_batches_is_an_error(spark, log):
    with pytest.raises(ValueError):
        log.write(visit(spark, "2024-01-01T10:00:00Z"), 3)


def test_days_come_once_when_they_are_over(spark, data, refs, log, tmp_path):
    records = testbed.records(spark, data)
    into, checkpoint = str(tmp_path / "days"), str(tmp_path / "checkpoint")
    whole = verdict_summary(audit_records(records, refs))
    halves = [records.where("event_id % 2 = 0"), records.where("event_id % 2 = 1")]
    for n, half in enumerate(halves):
        write_batch(half, str(tmp_path / "topic"), n)
        topic = spark.readStream.schema(half.schema).parquet(str(tmp_path / "topic"))
        log.start(topic, str(tmp_path / "taken"), ONCE).awaitTermination()
        query = summary.start_summary(log, spark, into, checkpoint, ONCE)
        query.awaitTermination()
        dropped = [s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]]
        assert sum(dropped) == 0
    days = spark.read.parquet(into)
    assert days.groupBy("type", "request_day", "subsystem").count().where("count > 1").isEmpty()
    late = log.late_counts(spark).drop("arrival")
    last = days.agg(F.max("request_day")).first()[0]
    both = days.unionByName(late).groupBy("type", "request_day", "subsystem").agg(F.sum("visits").alias("visits"))
    assert late.count() > 0
    assert rows(both.where(F.col("request_day") <= last)) == rows(whole.where(F.col("request_day") <= last))


def test_the_aggregate_is_windowed_and_appends(spark, log):
    log.write(visit(spark, "2024-01-01T10:00:00Z"), 0)
    counted = summary.summary_stream(log.stream(spark))
    assert counted.isStreaming
    text = counted._jdf.queryExecution().logical().toString()
    assert "EventTimeWatermark" in text and "window" in text.lower()


def test_deliveries_read_the_events_once(spark, tmp_path):
    days = [(1, 1), (2, 7), (7, 2), (9, 1), (10, 14), (30, 1), (31, 7)]  # of the month, with `k`
    events = pa.table(
        {
            "event_id": list(range(len(days))),
            "ts": pa.array([datetime(2024, 1, d, 5) for d, _ in days], pa.timestamp("us")),
            "user_id": [7] * len(days),
            "event_type": ["view"] * len(days),
            "value": [1.0] * len(days),
            "props": [f'{{"k":{k}}}' for _, k in days],
        }
    )
    path, into = tmp_path / "events.parquet", str(tmp_path / "into")
    pq.write_table(events, path)
    want, counts = rows(testbed.records(spark, str(tmp_path))), []

    def take(topic):
        pq.write_table(events.slice(0, 0), path)  # nothing is left to be read again
        stream = topic.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint"))
        stream.trigger(**ONCE).start(into).awaitTermination()
        counts.append(spark.read.parquet(into).count())

    catalog._delivered(spark, str(tmp_path), take)
    assert counts == [2, 4, 5, 6, 7]
    assert rows(spark.read.parquet(into)) == want
