"""Registered queries: one per operator, each a function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accessaudit.functions import after_last_equals
from accessaudit.operators import identity, inference, membership, packets, results, rules, verdicts, visits
from accessaudit.operators.laid_out import join_laid_out, lay_out
from accessaudit.operators.lookup import measure, value_lists
from accessaudit.plans import testbed as tb
from accessaudit.plans.audit import References, audit_flow, audit_records, references_from_documents
from accessaudit.schemas import LOGIN_SUCCEEDED, OUTSIDE_WHITELIST
from accessaudit.session import fresh_folder, written
from accessaudit.sources import records as record_sources
from accessaudit.sources import two_phase
from accessaudit.sources.sinks import write_batch
from accessaudit.sources.tables import TableSource, read_table
from accessaudit.sources.topic_log import TopicLog
from accessaudit.streaming import summary, user_state
from accessaudit.streaming.alarm_scan import AlarmScan
from accessaudit.streaming.job import AuditJob, current_user_map, flow_stream
from accessaudit.streaming.levels import Levels, greatest, latest_by

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER = ["event_id", "sysid", "c_area"]
RESULT_ORDER = ["event_id", "subsystem", "area"]
ONCE = {"availableNow": True}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# Inputs shared by several queries --------------------------------------------------------


def _service_lists(spark: SparkSession, *attributes: str) -> list:
    lists = value_lists(tb.service_rules(spark).select(*attributes))
    return [lists[a] for a in attributes]


def _visits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, References]:
    refs = tb.references(spark, sf_dir)
    return visits.visit_flow(tb.flow(spark, sf_dir), refs.ports, refs.servers), refs


def _enriched(rows: DataFrame, refs: References) -> DataFrame:
    """Area and system of the visits that are left: they take no part in any filter."""
    return visits.enrich_system(visits.enrich_area(rows, refs.area), refs.systems)


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_flow(tb.flow(spark, sf_dir), tb.references(spark, sf_dir))


def _logins(spark: SparkSession, sf_dir: str, succeeded: bool) -> DataFrame:
    seen, refs = _visits(spark, sf_dir)
    inside = verdicts.inside_whitelist(seen, refs.whitelist)
    pick = verdicts.auth_success if succeeded else verdicts.auth_failure
    return _enriched(pick(inside, refs.errors, refs.urls), refs)


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.login_users(_logins(spark, sf_dir, True), "event_id")


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.explode_rules(rules.model_rules(tb.models(spark, sf_dir), tb.documents(spark, sf_dir)))


def _numbered_results(spark: SparkSession, sf_dir: str, now: int | Column = tb.CLOCK_MS) -> DataFrame:
    rows = results.result_rows(_verdicts(spark, sf_dir), "event_id", now=now)
    return results.dense_ids(rows, RESULT_ORDER)


# Sources ---------------------------------------------------------------------------------


@query
def packet_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read as a stream and projected; the stream runs to its end."""
    out = fresh_folder(spark, "packet-stream")
    stream = flow_stream(tb.record_stream(spark, sf_dir)).drop("event_ts", "packet_no")
    started = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**ONCE)
        .start(f"{out}/flow")
    )
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/flow")


@query
def resume_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_sources.resume_offsets(*tb.offsets(spark, sf_dir))


@query
def resumed_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow from the resume offsets on, out of a topic kept as files; partitions are users, offsets event ids."""
    topic = tb.topic(spark, sf_dir)
    log = TopicLog(fresh_folder(spark, "topic-log"), topic.schema)
    log.append(topic, 0)
    found = log.read_from(spark, record_sources.resume_offsets(*tb.offsets(spark, sf_dir)))
    return packets.project_flow(packets.parse_packets(found)).drop("packet_no", "part").withColumnRenamed("off", "event_id")


@query
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, TableSource(folder=sf_dir), "customer")


@query
def parse_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = packets.parse_packets(tb.records(spark, sf_dir))
    return p.select(
        "event_id",
        "packet_no",
        F.col("`@timestamp`").alias("stamp"),
        F.col("source.ip").alias("source_ip"),
        F.col("destination.ip").alias("destination_ip"),
        F.col("destination.port").alias("destination_port"),
        F.col("query").alias("request"),
        F.col("url.query").alias("url_query"),
        F.col("http.response.status_code").alias("response_code"),
    )


@query
def corrupt_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets.corrupt_packets(tb.mixed_topic(spark, sf_dir))


# Projections and filters -----------------------------------------------------------------


@query
def project_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets.project_flow(packets.parse_packets(tb.records(spark, sf_dir))).drop("packet_no")


@query
def column_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches are the minutes of the records; a minute without any answer is dropped."""
    parsed = packets.parse_packets(tb.records(spark, sf_dir))
    by_minute = parsed.withColumn("minute", F.substring("`@timestamp`", 1, 16))
    return packets.project_flow(packets.column_gate(by_minute, "minute")).drop("packet_no")


def _by_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = tb.records(spark, sf_dir)
    return records.withColumn("minute", F.substring(F.get_json_object("value", "$.@timestamp"), 1, 16))


@query
def inferred_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the records of each day hold, by inference; chat lines among them give nothing."""
    topic = tb.mixed_topic(spark, sf_dir)
    records = inference.variant_records(topic.select(F.substring(F.get_json_object("value", "$.@timestamp"), 1, 10).alias("day"), "value"))
    return inference.fields(records, "day")


@query
def inferred_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate on inferred columns: minutes without an answer have no column for one."""
    return inference.inferred_gate(_by_minute(spark, sf_dir), "minute").select("event_id", "minute")


@query
def inferred_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the columns found in them, as the audit needs them."""
    p = inference.inferred_packets(tb.records(spark, sf_dir))
    return p.select(
        "event_id",
        F.col("source.ip").alias("ip"),
        F.col("destination.ip").alias("serviceIp"),
        F.col("destination.port").alias("port"),
        F.col("@timestamp").alias("requestTime"),
        F.col("query").alias("url"),
        F.col("url.query").alias("query"),
        F.col("http.response.status_code").alias("status_code"),
    )


@query
def monitored_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.monitored_service(tb.flow(spark, sf_dir), *_service_lists(spark, "port", "ip"))


@query
def visit_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.visit_flow(tb.flow(spark, sf_dir), *_service_lists(spark, "port", "ip"))


@query
def outside_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, refs = _visits(spark, sf_dir)
    return _enriched(verdicts.outside_whitelist(seen, refs.whitelist), refs)


@query
def inside_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, refs = _visits(spark, sf_dir)
    return _enriched(verdicts.inside_whitelist(seen, refs.whitelist), refs)


@query
def inside_long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits from the addresses of customers who wait for an order, a list taken to be beyond a broadcast."""
    known = tb.buyers(spark, sf_dir)
    return membership.keep_members(tb.flow(spark, sf_dir), "ip", measure(known, max_rows=0)[0])


@query
def auth_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logins(spark, sf_dir, False)


@query
def auth_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logins(spark, sf_dir, True)


@query
def auth_failure_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.login_users(_logins(spark, sf_dir, False))


@query
def auth_success_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.login_users(_logins(spark, sf_dir, True))


@query
def success_not_401(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, refs = _visits(spark, sf_dir)
    return _enriched(verdicts.success_by_code(verdicts.inside_whitelist(seen, refs.whitelist), ("401",)), refs)


@query
def classify_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From record text to verdicts."""
    return audit_records(tb.records(spark, sf_dir), tb.references(spark, sf_dir)).drop("packet_no")


# Joins -----------------------------------------------------------------------------------


@query
def enrich_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.enrich_area(tb.flow(spark, sf_dir), tb.area(spark, sf_dir))


@query
def enrich_area_laid_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas from a table laid out in buckets by ip, taken to be beyond a broadcast."""
    known = tb.area(spark, sf_dir).select(F.col("c_ip").alias("ip"), "c_area")
    return join_laid_out(tb.flow(spark, sf_dir), lay_out(known, "ip"), "left")


@query
def enrich_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.enrich_system(tb.flow(spark, sf_dir), tb.systems(spark, sf_dir))


@query
def model_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.model_rules(tb.models(spark, sf_dir), tb.documents(spark, sf_dir))


@query
def latest_user_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.latest_user(tb.user_ip(spark, sf_dir))


@query
def attach_known_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.attach_known_user(_users(spark, sf_dir), identity.latest_user(tb.user_ip(spark, sf_dir)))


# Aggregates and rules --------------------------------------------------------------------


@query
def max_pid_per_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.max_pid_per_ip(tb.user_ip(spark, sf_dir))


@query
def max_pid_in_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest row number per ip, kept current over a history that comes in weeks."""
    weeks = tb.user_ip_weeks(spark, sf_dir)
    kept = Levels(fresh_folder(spark, "levels"), weeks.select("ip", "pid").schema, greatest("ip", "pid"), fanout=2)
    for week in range(5):  # of a month
        kept.add(weeks.where(F.col("week") == week), week)
    return kept.current(spark)


@query
def explode_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir)


@query
def missing_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.missing_rules(rules.model_rules(tb.models(spark, sf_dir), tb.documents(spark, sf_dir)))


@query
def rule_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_values(_rules(spark, sf_dir))


@query
def model_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = tb.documents(spark, sf_dir).select(F.col("modeId").alias("id"))
    return rules.model_level(tb.models(spark, sf_dir), wanted)


# Scalar functions ------------------------------------------------------------------------


@query
def extract_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.flow(spark, sf_dir).select("event_id", after_last_equals("query").alias("user"))


@query
def extract_user_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value of each page address's query string."""
    has_query = F.col("url").contains("?")
    text = F.when(has_query, F.substring_index("url", "?", -1))
    pages = tb.table(spark, sf_dir, "pages")
    return pages.select("page_id", after_last_equals(text).alias("user"))


@query
def request_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets.with_request_date(tb.flow(spark, sf_dir)).select("event_id", "request_date")


@query
def request_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets.with_request_day(tb.flow(spark, sf_dir)).select("event_id", "request_day")


# Results, map and alarms -----------------------------------------------------------------


@query
def dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.dense_ids(_verdicts(spark, sf_dir).select(*ORDER, "type"), ORDER)


@query
def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered_results(spark, sf_dir)


@query
def result_rows_null_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.result_rows(_verdicts(spark, sf_dir), "event_id", now=tb.CLOCK_MS, null_as_text=True)


@query
def labelled_result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed logins under a label of the caller's choice instead of the model's level."""
    users = identity.login_users(_logins(spark, sf_dir, False), "event_id")
    return results.result_rows(verdicts.with_verdict(users, "3", 2, 1), "event_id", now=tb.CLOCK_MS)


@query
def violation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.violation_rows(_verdicts(spark, sf_dir), "event_id", now=tb.CLOCK_MS)


@query
def alarm_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.alarm_messages(_numbered_results(spark, sf_dir))


@query
def alarms_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clock of a row is the time of its request, so the bound cuts the rows in two."""
    clock = F.unix_millis(F.to_timestamp(F.concat(F.substring("requestTime", 1, 19), F.lit("+00:00"))))
    return results.alarms_since(_numbered_results(spark, sf_dir, now=clock), tb.SINCE_MS)


@query
def two_phase_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results written as two batches that are seen whole; the second one is written twice."""
    out = fresh_folder(spark, "two-phase")
    rows = results.result_rows(_verdicts(spark, sf_dir), "event_id", now=tb.CLOCK_MS)
    violation = F.col("type") == OUTSIDE_WHITELIST
    for batch, part in ((0, violation), (1, ~violation), (1, ~violation)):
        two_phase.write_committed(rows.where(part), out, batch)
    return two_phase.read_committed(spark, out, rows.schema)


@query
def alarm_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarms of a result table that grows: a scan after each part, all of their alarms together."""
    out = fresh_folder(spark, "alarm-scans")
    clock = F.unix_millis(F.to_timestamp(F.concat(F.substring("requestTime", 1, 19), F.lit("+00:00"))))
    numbered = written(_numbered_results(spark, sf_dir, now=clock), f"{out}/numbered")
    scan = AlarmScan(f"{out}/results", numbered.schema, f"{out}/scans", tb.SINCE_MS)
    for batch, part in enumerate(("level = 2", "level <> 2")):
        write_batch(numbered.where(part), scan.results, batch)
        scan.scan(spark)
    return scan.all_alarms(spark)


@query
def ip_user_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.ip_user_map(_users(spark, sf_dir), ["requestTime", "event_id"])


@query
def user_map_in_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map kept current batch by batch: one of each day of the week, merged in levels."""
    order = ["requestTime", "event_id"]
    users = written(_users(spark, sf_dir), fresh_folder(spark, "logins"))
    kept = Levels(fresh_folder(spark, "levels"), identity.ip_user_map(users, order).schema, latest_by(*order), fanout=3)
    for day in range(7):
        some = users.where(F.weekday(F.to_date(F.substring("requestTime", 1, 10))) == day)
        kept.add(identity.ip_user_map(some, order), day)
    return kept.current(spark)


@query
def short_user_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.short_user_pairs(_users(spark, sf_dir))


@query
def user_ip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.user_ip_rows(identity.short_user_pairs(_users(spark, sf_dir)), tb.CLOCK_MS)


@query
def verdict_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: records to verdict counts per type, day and system."""
    return results.verdict_summary(
        audit_records(tb.records(spark, sf_dir), tb.references(spark, sf_dir))
    )


# Streaming -------------------------------------------------------------------------------


@query
def dedup_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic replayed once: every record twice."""
    flow = tb.flow(spark, sf_dir)
    return identity.dedup_replay(flow.unionAll(flow), ["event_id"])


def _job(spark: SparkSession, sf_dir: str) -> AuditJob:
    """The micro-batch job run to the end of its stream, here one batch; the topic holds chat lines too."""
    out = fresh_folder(spark, "stream")
    job = AuditJob(load=lambda s: tb.references(s, sf_dir), output=out, identity=("event_id",), now_ms=tb.CLOCK_MS)
    job.start(tb.record_stream(spark, sf_dir), f"{out}/checkpoint", ONCE).awaitTermination()
    return job


@query
def stream_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_job(spark, sf_dir).folder("results")).drop("pid", "batch_id", "packet_no")


@query
def stream_pids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids the job gives out: how many, from which, to which, and how often each."""
    out = spark.read.parquet(_job(spark, sf_dir).folder("results"))
    return out.agg(
        F.count("pid").alias("rows"), F.min("pid").alias("first"), F.max("pid").alias("last"), F.count_distinct("pid").alias("ids")
    )


@query
def stream_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's alarms with the visits they are about; both hold the same ids."""
    job = _job(spark, sf_dir)
    alarms = spark.read.parquet(job.folder("alarms")).select("pid", "username", "level")
    about = spark.read.parquet(job.folder("results")).select("pid", "event_id", "subsystem", "area")
    return about.join(alarms, "pid").drop("pid")


@query
def stream_user_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _job(spark, sf_dir)
    return current_user_map(spark, job.folder("user_map"), ["requestTime", "event_id"])


def _delivered(spark: SparkSession, sf_dir: str, take: Callable[[DataFrame], None], weeks: int = 1) -> None:
    """A topic that grows by so many weeks at a time; after each delivery `take` runs over what is new, as a query started again.

    The events are dealt to their deliveries in one pass; each delivery then reads its own alone.
    """
    out, dealt = fresh_folder(spark, "topic"), fresh_folder(spark, "deliveries")
    whole = tb.deliveries(spark, sf_dir)
    whole = whole.withColumn("delivery", F.floor(F.col("delivery") / weeks))
    whole.write.partitionBy("delivery").parquet(dealt)
    whole = spark.read.schema(whole.schema).parquet(dealt)
    for week in sorted(r["delivery"] for r in whole.select("delivery").distinct().collect()):  # at most six
        tb.records_of(whole.where(F.col("delivery") == week)).write.mode("append").parquet(out)
        take(spark.readStream.schema("event_id bigint, value string").parquet(out))


@query
def keyed_user_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map as keyed state, kept over queries that end and start again, read from the state."""
    checkpoint, refs = fresh_folder(spark, "user-state"), tb.references(spark, sf_dir)
    order = ["requestTime", "event_id"]

    def take(topic: DataFrame) -> None:
        found = audit_records(topic, refs).where(F.col("type") == LOGIN_SUCCEEDED)
        entries = user_state.login_entries(identity.login_users(found, "event_id"), order)
        user_state.run_out(user_state.start_user_map(entries, checkpoint, trigger=ONCE))

    _delivered(spark, sf_dir, take, weeks=3)
    return user_state.state_of(spark, checkpoint)


@query
def stream_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the days that are over, and of verdicts that came too late for them."""
    out, refs = fresh_folder(spark, "summary"), tb.references(spark, sf_dir)
    log = summary.VerdictLog(lambda _: refs, f"{out}/log", ("event_id",))
    _delivered(spark, sf_dir, lambda topic: log.start(topic, f"{out}/taken", ONCE).awaitTermination())
    summary.start_summary(log, spark, f"{out}/days", f"{out}/counted", ONCE).awaitTermination()
    days = spark.read.schema("type string, request_day string, subsystem string, visits bigint").parquet(f"{out}/days")
    return days.withColumn("arrival", F.lit(summary.ON_TIME)).unionByName(log.late_counts(spark))


@query
def classify_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules taken from their newest documents, then the audit."""
    refs = references_from_documents(
        tb.area(spark, sf_dir), tb.systems(spark, sf_dir), tb.model_levels(spark), tb.rule_documents(spark, sf_dir)
    )
    return audit_flow(tb.flow(spark, sf_dir), refs)
