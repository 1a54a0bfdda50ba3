"""The micro-batch job: equal to the batch, restartable, replayable."""

import dataclasses
import json
import time

import pytest
from pyspark.sql import functions as F

from accessaudit.operators.identity import dedup_replay, ip_user_map
from accessaudit.operators.results import result_rows
from accessaudit.plans import testbed
from accessaudit.plans.audit import audit_records
from accessaudit.schemas import RESULT_COLUMNS, RESULT_DDL
from accessaudit.sources.records import packet_stream
from accessaudit.streaming import delivery
from accessaudit.streaming import job as streaming_job
from accessaudit.streaming.job import (
    AuditJob,
    compact_user_map,
    current_user_map,
    distinct_flow_stream,
)
from tests.helpers import rows

ONCE = {"availableNow": True}
KEEP = ("ip", "user", "subsystem", "requestTime", "area", "type", "level", "status", "abnormal")
ORDER = ["requestTime", "event_id", "packet_no"]


@pytest.fixture(scope="module")
def records(spark, data):
    return testbed.records(spark, data).persist()


@pytest.fixture(scope="module")
def refs(spark, data):
    return testbed.references(spark, data)


@pytest.fixture(scope="module")
def expected(records, refs):
    return rows(result_rows(audit_records(records, refs), now=1), *KEEP)


@pytest.fixture
def topic(records, tmp_path):
    """The records in three files, one line each: `event_id` and the text."""
    records.repartition(3).write.json(str(tmp_path / "topic"))
    return str(tmp_path / "topic")


def stream(spark, topic):
    return packet_stream(spark, "json", topic, "event_id long, value string", maxFilesPerTrigger="1")


def job(refs, tmp_path, **kw):
    return AuditJob(load=lambda _: refs, output=str(tmp_path / "out"), identity=("event_id",), now_ms=1, **kw)


def run(audit, source, tmp_path):
    audit.start(source, str(tmp_path / "checkpoint"), ONCE).awaitTermination()


def test_job_equals_batch(spark, records, refs, expected, topic, tmp_path):
    audit = job(refs, tmp_path)
    run(audit, stream(spark, topic), tmp_path)
    out = spark.read.parquet(audit.folder("results"))
    assert out.select("batch_id").distinct().count() == 3
    assert rows(out, *KEEP) == expected
    total = sum(expected.values())
    assert sorted(r["pid"] for r in out.collect()) == list(range(1, total + 1))

    alarms = spark.read.parquet(audit.folder("alarms"))
    failed = {r["pid"]: r["user"] for r in out.where("type = '3'").collect()}
    assert {r["pid"]: r["username"] for r in alarms.collect()} == failed
    assert all(json.loads(r["message"])["pid"] == r["pid"] for r in alarms.collect())

    verdicts = result_rows(audit_records(records, refs), "event_id", "packet_no")
    want = ip_user_map(verdicts.where("type = '0'"), ORDER)
    assert rows(current_user_map(spark, audit.folder("user_map"), ORDER)) == rows(want)
    compact_user_map(spark, audit.folder("user_map"), str(tmp_path / "compact"), ORDER)
    assert rows(current_user_map(spark, str(tmp_path / "compact"), ORDER)) == rows(want)


def test_restart_continues_without_repeats(spark, records, refs, expected, tmp_path):
    topic = tmp_path / "topic"
    half = F.col("event_id") % 2
    records.where(half == 0).coalesce(1).write.json(str(topic / "a"))
    pattern = str(topic / "*")
    first = job(refs, tmp_path)
    run(first, stream(spark, pattern), tmp_path)
    before = rows(spark.read.parquet(first.folder("results")))
    run(first, stream(spark, pattern), tmp_path)  # nothing new: no batch, no change
    assert rows(spark.read.parquet(first.folder("results"))) == before
    records.where(half == 1).coalesce(1).write.json(str(topic / "b"))
    again = job(refs, tmp_path)
    run(again, stream(spark, pattern), tmp_path)
    out = spark.read.parquet(again.folder("results"))
    assert rows(out, *KEEP) == expected
    assert sorted(r["pid"] for r in out.collect()) == list(range(1, sum(expected.values()) + 1))


TABLES = ("results", "alarms", "user_map", "corrupt", "ledger")


def down(tables, batch_id):
    raise RuntimeError("sink down")


def test_batch_run_again_keeps_rows_ids_and_clock(spark, records, refs, expected, tmp_path):
    """The second try has other rules, the default clock and its rows in other tasks."""
    even, odd = records.where("event_id % 2 = 0"), records.where("event_id % 2 = 1")
    audit = AuditJob(lambda _: refs, str(tmp_path / "out"), ("event_id",), base_pid=100)
    audit.write_verdicts(even, 0)
    audit.on_batch = down
    with pytest.raises(RuntimeError):
        audit.write_verdicts(odd, 1)
    before = [rows(spark.read.parquet(audit.folder(t))) for t in TABLES[:4]]
    fewer = dataclasses.replace(refs, whitelist=refs.whitelist.__class__(refs.whitelist.values[:1], False))
    again = AuditJob(lambda _: fewer, str(tmp_path / "out"), ("event_id",), base_pid=7)
    again.write_verdicts(odd.repartition(5), 1)
    assert [rows(spark.read.parquet(audit.folder(t))) for t in TABLES[:4]] == before
    out = spark.read.parquet(audit.folder("results"))
    assert rows(out, *KEEP) == expected
    assert sorted(r["pid"] for r in out.collect()) == list(range(101, 101 + sum(expected.values())))
    again.on_batch = down  # a batch with a ledger entry is done
    again.write_verdicts(odd, 1)
    assert not [p for t in ("stage", "staged") if (tmp_path / "out" / t).exists() for p in (tmp_path / "out" / t).iterdir()]


def test_unfinished_stage_is_made_anew(spark, records, refs, expected, tmp_path):
    audit = job(refs, tmp_path)
    records.limit(3).write.parquet(f"{audit.folder('stage')}/batch_id=0")
    audit.write_verdicts(records, 0)
    assert rows(spark.read.parquet(audit.folder("results")), *KEEP) == expected


def test_output_belongs_to_one_checkpoint(spark, refs, topic, tmp_path):
    audit = job(refs, tmp_path)
    run(audit, stream(spark, topic), tmp_path)
    before = rows(spark.read.parquet(audit.folder("results")))
    with pytest.raises(ValueError, match="another checkpoint"):
        audit.start(stream(spark, topic), str(tmp_path / "other"), ONCE)
    with pytest.raises(ValueError, match="belongs to another folder"):
        AuditJob(lambda _: refs, str(tmp_path / "new"), ("event_id",)).next_pid(spark, 3)
    run(audit, stream(spark, topic), tmp_path)  # its own checkpoint goes on
    assert rows(spark.read.parquet(audit.folder("results"))) == before


def test_ids_of_many_tasks(spark, refs, records, monkeypatch, tmp_path):
    monkeypatch.setattr(streaming_job, "MOST_LITERALS", 1)
    audit = job(refs, tmp_path)
    audit.write_verdicts(records.repartition(6), 0)
    pids = [r["pid"] for r in spark.read.parquet(audit.folder("results")).collect()]
    assert sorted(pids) == list(range(1, len(pids) + 1))


def test_batch_without_verdicts_and_dead_letters(spark, refs, tmp_path):
    audit = job(refs, tmp_path)
    audit.write_verdicts(spark.createDataFrame([(1, "{bad"), (2, "{}")], "event_id long, value string"), 0)
    assert spark.read.parquet(audit.folder("results")).count() == 0
    assert rows(spark.read.parquet(audit.folder("corrupt")), "event_id", "value") == {(1, "{bad"): 1}
    assert audit.next_pid(spark, 1) == 0


def test_job_without_dead_letters(spark, records, refs, expected, tmp_path):
    audit = job(refs, tmp_path, dead_letters=False)
    audit.write_verdicts(records, 0)
    assert rows(spark.read.parquet(audit.folder("results")), *KEEP) == expected
    assert not (tmp_path / "out" / "corrupt").exists()


def test_failures_fail_the_batch(spark, refs, tmp_path):
    audit = job(refs, tmp_path, on_batch=down)
    with pytest.raises(RuntimeError):
        audit.write_verdicts(spark.createDataFrame([(1, "{}")], "event_id long, value string"), 0)
    assert not (tmp_path / "out" / "ledger").exists()


def test_hook_sees_the_written_batch(spark, records, refs, tmp_path):
    seen = {}
    audit = job(refs, tmp_path, on_batch=lambda tables, n: seen.update({n: tables["alarms"].count()}))
    audit.write_verdicts(records, 0)
    assert seen == {0: spark.read.parquet(audit.folder("alarms")).count()}


def test_references_are_reloaded_when_due(spark, refs, tmp_path):
    loads = []
    audit = AuditJob(
        load=lambda _: loads.append(1) or refs, output=str(tmp_path), identity=("event_id",), refresh_every=2
    )
    for batch_id in range(5):
        audit.references(spark, batch_id)
    assert len(loads) == 3


def test_cached_references_are_released(spark, data):
    cached = testbed.references(spark, data, cache=True)
    assert all(f.storageLevel.useMemory for f in cached.cached)
    assert len(cached.cached) == 4
    large = testbed.references(spark, data, cache=True, max_rows=100)
    assert 0 < len(large.cached) < 4  # what cannot be broadcast is not kept either
    large.unpersist()
    cached.unpersist()
    assert not any(f.storageLevel.useMemory for f in cached.cached)


def test_same_plan_on_a_stream(spark, records, refs, expected, topic, tmp_path):
    """The operators themselves accept a streaming frame; no foreachBatch needed."""
    verdicts = result_rows(audit_records(stream(spark, topic), refs), now=1)
    query = (
        verdicts.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(**ONCE)
        .start(str(tmp_path / "o"))
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "o")), *KEEP) == expected


def test_large_references_on_a_stream(spark, data, expected, topic, tmp_path):
    """Tables too large to broadcast are joined by shuffle on a stream as well."""
    large = testbed.references(spark, data, max_rows=-1)
    verdicts = result_rows(audit_records(stream(spark, topic), large), now=1)
    query = (
        verdicts.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(**ONCE)
        .start(str(tmp_path / "o"))
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "o")), *KEEP) == expected


def test_replayed_records_on_a_stream(spark, records, topic, tmp_path):
    twice = spark.read.schema("event_id long, value string").json(topic)
    twice.unionAll(twice).write.json(str(tmp_path / "twice"))
    source = packet_stream(spark, "json", str(tmp_path / "twice"), "event_id long, value string")
    query = (
        distinct_flow_stream(source, ["event_id"])
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(**ONCE)
        .start(str(tmp_path / "o"))
    )
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "o"))
    assert out.count() == records.count() == out.select("event_id").distinct().count()


def test_late_records_are_kept(spark, records, tmp_path):
    """Records three hours behind the newest come in a batch of their own."""
    text = records.orderBy("event_id").limit(3).collect()
    times = ("2024-01-01T12:00:00Z", "2024-01-01T12:01:00Z", "2024-01-01T09:00:00Z")
    for n, (row, stamp) in enumerate(zip(text, times, strict=True)):
        packet = {**json.loads(row["value"]), "@timestamp": stamp}
        line = spark.createDataFrame([(n, json.dumps(packet))], "event_id long, value string")
        line.coalesce(1).write.json(str(tmp_path / "late" / str(n)))
        source = packet_stream(spark, "json", str(tmp_path / "late" / "*"), "event_id long, value string")
        flow = distinct_flow_stream(source, ["event_id"])
        query = flow.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE)
        query.start(str(tmp_path / "o")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "o"))
    assert sorted(r["requestTime"] for r in out.collect()) == sorted(times)


def test_stream_dedup_needs_a_bound(spark, topic):
    with pytest.raises(ValueError):
        dedup_replay(stream(spark, topic), ["event_id"])


def test_default_trigger_runs_until_stopped(spark, refs, expected, topic, tmp_path):
    audit = job(refs, tmp_path)
    query = audit.start(stream(spark, topic), str(tmp_path / "checkpoint"))
    try:
        until = time.time() + 120
        while time.time() < until and (query.lastProgress is None or query.lastProgress["batchId"] < 2):
            assert query.isActive
            time.sleep(0.5)
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark.read.parquet(audit.folder("results")), *KEEP) == expected


@pytest.fixture
def database(spark, tmp_path, monkeypatch):
    """A folder plays the database: reading and appending are the only things done to it. The first append breaks off."""
    table = str(tmp_path / "t_result")
    spark.createDataFrame([], RESULT_DDL).write.parquet(table)
    asked, appends = [], []

    def read(session, source, name, **split):
        asked.append((source.options, split))
        return session.read.parquet(name)

    def append(new, name, connection, **tuning):
        new = new.collect()
        appends.append(len(new))
        part = new[: len(new) // 2] if len(appends) == 1 else new
        spark.createDataFrame(part, RESULT_DDL).write.mode("append").parquet(name)
        if len(appends) == 1:
            raise RuntimeError("connection lost half way")

    monkeypatch.setattr(delivery.tables, "read_table", read)
    monkeypatch.setattr(delivery.sinks, "append_jdbc", append)
    return table, asked, appends


def test_results_reach_a_database_once(spark, records, refs, tmp_path, database):
    table, asked, appends = database
    seen = []
    hook = delivery.all_of(delivery.jdbc_results(table, {"url": "u"}), lambda tables, n: seen.append(n))
    audit = AuditJob(lambda _: refs, str(tmp_path / "out"), ("event_id",), on_batch=hook)
    with pytest.raises(RuntimeError):
        audit.write_verdicts(records, 0)
    audit.write_verdicts(records, 0)
    audit.write_verdicts(records, 0)
    assert rows(spark.read.parquet(table)) == rows(spark.read.parquet(audit.folder("results")).select(*RESULT_COLUMNS))
    assert appends[0] > appends[1] > 0 and len(appends) == 2
    assert seen == [0]
    assert asked[0][1] == {"split_on": "pid", "bounds": (1, appends[0] + 1), "partitions": 8}


def test_new_checkpoint_on_a_filled_database(spark, records, refs, tmp_path, database):
    table, _, appends = database
    old = spark.createDataFrame([(p, "i", "u", "s", "t", "a", "1", 1, 1, 5, 1) for p in range(1, 30)], RESULT_DDL)
    old.write.mode("append").parquet(table)
    appends.append(0)  # no break
    hook = delivery.jdbc_results(table, {"url": "u"})
    careless = AuditJob(lambda _: refs, str(tmp_path / "a"), ("event_id",), on_batch=hook)
    with pytest.raises(ValueError, match="other rows"):
        careless.write_verdicts(records, 0)
    audit = AuditJob(
        lambda _: refs, str(tmp_path / "b"), ("event_id",), on_batch=hook, base_pid=delivery.greatest_pid(table, {"url": "u"})
    )
    audit.write_verdicts(records, 0)
    new = spark.read.parquet(audit.folder("results")).select(*RESULT_COLUMNS)
    assert rows(spark.read.parquet(table)) == rows(old.unionByName(new))
    assert new.agg(F.min("pid")).first()[0] == 30


def test_user_ips_reach_the_history(spark, records, refs, tmp_path, monkeypatch):
    kept = {}
    monkeypatch.setattr(delivery.sinks, "append_jdbc", lambda df, name, *a, **k: kept.update({name: df.collect()}))
    audit = job(refs, tmp_path, on_batch=delivery.jdbc_user_ips("t_usernameIp", {}))
    audit.write_verdicts(records, 0)
    users = spark.read.parquet(audit.folder("results")).where("type = '0' and length(user) < 8")
    assert {(r["ip"], r["username"]) for r in kept["t_usernameIp"]} == {(r["ip"], r["user"]) for r in users.collect()}


def test_alarms_and_map_reach_clients(spark, records, refs, tmp_path):
    said, kept = tmp_path / "said", tmp_path / "kept"
    said.mkdir()
    kept.mkdir()
    said_to, kept_in = str(said), str(kept)

    def opened(folder):
        import tempfile

        return open(tempfile.mkstemp(dir=folder)[1], "w")

    hook = delivery.all_of(
        delivery.client_alarms(lambda: opened(said_to), lambda out, texts: out.write("".join(t + "\n" for t in texts))),
        delivery.client_user_map(lambda: opened(kept_in), lambda out, pairs: out.write("".join(f"{k} {u}\n" for k, u in pairs))),
    )
    audit = job(refs, tmp_path, on_batch=hook)
    audit.write_verdicts(records, 0)
    lines = lambda folder: sorted(line for f in folder.iterdir() for line in f.read_text().splitlines())
    alarms = spark.read.parquet(audit.folder("alarms"))
    assert lines(said) == sorted(r["message"] for r in alarms.collect())
    entries = spark.read.parquet(audit.folder("user_map"))
    assert lines(kept) == sorted(f"{r['key']} {r['user']}" for r in entries.collect())


def test_kafka_alarms_need_the_connector(spark, tmp_path):
    alarms = spark.createDataFrame([(1, "{}")], "pid long, message string")
    with pytest.raises(Exception, match="(?i)kafka"):
        delivery.kafka_alarms("b:9092", "t")({"alarms": alarms}, 0)
