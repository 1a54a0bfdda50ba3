"""Users, the map, result rows, ids and alarms."""

import json

import pytest
from pyspark.sql import functions as F

from accessaudit.operators.identity import (
    attach_known_user,
    dedup_replay,
    ip_user_map,
    latest_user,
    login_users,
    max_pid_per_ip,
    short_user_pairs,
    user_ip_rows,
)
from accessaudit.operators.results import (
    alarm_messages,
    alarms_since,
    dense_ids,
    numbered,
    result_rows,
    verdict_summary,
    violation_rows,
)
from accessaudit.operators.verdicts import with_verdict
from accessaudit.schemas import RESULT_COLUMNS, RESULT_DDL
from tests.helpers import listed, rows

VERDICT_DDL = (
    "event_id long, ip string, query string, sysid string, requestTime string, c_area string, "
    "type string, level int, status int"
)
VERDICTS = [
    (1, "a", "u=bob", "s", "2024-01-01T00:00:00Z", "N", "1", 2, 1),
    (2, "a", "u=bob", None, "2024-01-01T00:00:01Z", None, "3", 3, 1),
    (3, "b", None, "s", "2024-01-02T00:00:02Z", "N", "3", 3, 1),
    (4, "b", "u=eve", "s", "2024-01-02T00:00:03Z", "N", "0", 0, 0),
]


@pytest.fixture(scope="module")
def verdicts(spark):
    return spark.createDataFrame(VERDICTS, VERDICT_DDL)


def test_result_rows(verdicts):
    out = result_rows(verdicts, "event_id", now=9)
    assert listed(out, "event_id", "user", "subsystem", "area", "type", "level", "status", "abnormal", "update_time") == [
        (1, " ", "s", "N", "1", 2, 1, 1, 9),
        (2, "bob", None, None, "3", 3, 1, 1, 9),
        (3, None, "s", "N", "3", 3, 1, 1, 9),
        (4, "eve", "s", "N", "0", 0, 0, 0, 9),
    ]
    assert rows(violation_rows(verdicts, "event_id", now=9)) == rows(out.where("type = '1'"))


def test_null_as_text(verdicts):
    out = result_rows(verdicts, "event_id", now=9, null_as_text=True)
    assert listed(out, "event_id", "user", "subsystem", "area") == [
        (1, " ", "s", "N"), (2, "bob", "null", "null"), (3, "null", "s", "N"), (4, "eve", "s", "N"),
    ]


def test_result_schema(spark, verdicts):
    out = dense_ids(result_rows(verdicts, now=9), ["requestTime"]).select(*RESULT_COLUMNS)
    want = [(f.name, f.dataType) for f in spark.createDataFrame([], RESULT_DDL).schema]
    assert [(f.name, f.dataType) for f in out.schema] == want


def test_alarms(verdicts):
    results = dense_ids(result_rows(verdicts, "event_id", now=9), ["event_id"], base=10)
    alarms = alarm_messages(results)
    assert listed(alarms, "pid", "username", "level") == [(12, "bob", 3), (13, None, 3)]
    texts = [json.loads(t) for (t,) in listed(alarms.where("pid = 12"), "message")]
    assert texts == [{"pid": 12, "username": "bob", "level": 3}]


def test_alarm_level_can_be_replaced(verdicts):
    results = dense_ids(result_rows(verdicts, "event_id", now=9), ["event_id"])
    assert listed(alarm_messages(results, level=1), "pid", "level") == [(2, 1), (3, 1)]


def test_rows_under_a_label_of_choice(verdicts):
    users = with_verdict(login_users(verdicts, "event_id").where("event_id > 2"), "3", 7, 1)
    assert listed(result_rows(users, "event_id", now=9), "event_id", "user", "type", "level", "status") == [
        (3, None, "3", 7, 1), (4, "eve", "3", 7, 1),
    ]


def test_alarms_since(verdicts):
    clock = F.col("event_id") * 100
    results = dense_ids(result_rows(verdicts, "event_id", now=clock), ["event_id"])
    assert listed(alarms_since(results, 100), "pid") == [(2,)]  # unknown user and success do not count
    as_text = dense_ids(result_rows(verdicts, "event_id", now=clock, null_as_text=True), ["event_id"])
    assert listed(alarms_since(as_text, 100), "pid") == [(2,)]
    assert listed(alarms_since(as_text, 99), "pid") == [(1,), (2,)]


@pytest.mark.parametrize("base", [0, 500])
@pytest.mark.parametrize("order", [["bucket", "id"], []])
def test_dense_ids(spark, base, order):
    n = F.col("id")
    df = spark.range(5000).repartition(7).select(n, F.when(n % 3 == 0, "hot").otherwise((n % 11).cast("string")).alias("bucket"))
    out = dense_ids(df, order, base).select("pid", "id", "bucket").collect()
    assert sorted(r["pid"] for r in out) == list(range(base + 1, base + 5001))
    assert sorted(r["id"] for r in out) == list(range(5000))
    if order:
        by_pid = sorted(out, key=lambda r: r["pid"])
        assert [(r["bucket"], r["id"]) for r in by_pid] == sorted((r["bucket"], r["id"]) for r in out)


def test_ties_and_copies_are_cut_over_tasks(spark, tmp_path):
    """A third of the rows alike in every column, and an order that ties everywhere."""
    n = F.col("id")
    df = spark.range(0, 6000, 1, 12).select(F.lit("t").alias("at"), F.when(n % 3 == 0, -1).otherwise(n).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would merge such small tasks
    try:
        out, total = numbered(df, ["at"], str(tmp_path / "n"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert total == 6000 and sorted(r["pid"] for r in out.collect()) == list(range(1, 6001))
    assert rows(out, "at", "v") == rows(df)
    placed = spark.read.parquet(str(tmp_path / "n" / "placed"))
    per_task = [r["count"] for r in placed.groupBy(F.shiftright("_place", 33)).count().collect()]
    assert len(per_task) == 8 and max(per_task) < 2000


def test_ids_repeat_when_the_rows_arrive_otherwise(spark):
    n = F.col("id")
    df = spark.range(0, 500, 1, 4).select((n % 7).alias("bucket"), n.alias("v"))
    assert rows(dense_ids(df, ["bucket"])) == rows(dense_ids(df.repartition(9), ["bucket"]))


def test_dense_ids_of_nothing(spark):
    assert dense_ids(spark.range(0).toDF("id"), ["id"]).count() == 0


def test_login_users(verdicts):
    out = login_users(verdicts, "event_id")
    assert out.columns == ["event_id", "ip", "requestTime", "c_area", "sysid", "user"]
    assert listed(out, "event_id", "user") == [(1, "bob"), (2, "bob"), (3, None), (4, "eve")]


def test_map_keeps_the_last_known_user(spark):
    users = spark.createDataFrame(
        [(1, "a", "t1", "old"), (2, "a", "t2", "new"), (3, "a", "t3", None), (4, "b", "t1", "x"), (5, "b", "t1", "y"), (6, None, "t1", "z")],
        "event_id int, ip string, requestTime string, user string",
    )
    order = ["requestTime", "event_id"]
    first = ip_user_map(users, order)
    assert listed(first, "key", "user") == [("ip_a", "new"), ("ip_b", "y")]
    later = spark.createDataFrame([(9, "b", "t0", "late"), (9, "c", "t0", "w")], "event_id int, ip string, requestTime string, user string")
    assert listed(ip_user_map(later, order, prior=first), "key", "user") == [
        ("ip_a", "new"), ("ip_b", "y"), ("ip_c", "w"),
    ]
    assert rows(ip_user_map(users.unionAll(later), order)) == rows(ip_user_map(later, order, prior=first))


def test_user_history(spark):
    history = spark.createDataFrame(
        [(1, "a", "x"), (5, "a", "y"), (3, "b", "z"), (7, None, "n")], "pid int, ip string, username string"
    )
    assert listed(max_pid_per_ip(history), "ip", "pid") == [(None, 7), ("a", 5), ("b", 3)]
    assert listed(latest_user(history), "pid", "username") == [(3, "z"), (5, "y"), (7, "n")]
    users = spark.createDataFrame([("a", "q"), ("c", "q"), (None, "q")], "ip string, user string")
    assert listed(attach_known_user(users, latest_user(history)), "ip", "username") == [(None, None), ("a", "y"), ("c", None)]


def test_short_users(spark):
    users = spark.createDataFrame([("a", "1234567"), ("a", "1234567"), ("a", "12345678"), ("b", None)], "ip string, user string")
    pairs = short_user_pairs(users)
    assert listed(pairs, "ip", "user") == [("a", "1234567")]
    assert listed(user_ip_rows(pairs, 5), "ip", "username", "update_time") == [("a", "1234567", 5)]


def test_replayed_records_count_once(spark):
    records = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (1, 1, "c")], "partition int, offset int, v string")
    assert rows(dedup_replay(records.unionAll(records), ["partition", "offset"])) == rows(records)


def test_summary(verdicts):
    assert listed(verdict_summary(verdicts), "type", "request_day", "subsystem", "visits") == [
        ("0", "2024-01-02", "s", 1), ("1", "2024-01-01", "s", 1), ("3", "2024-01-01", None, 1), ("3", "2024-01-02", "s", 1),
    ]
