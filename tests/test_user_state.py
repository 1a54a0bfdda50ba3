"""The user map as keyed state: equal to the batch, kept over restarts, forgotten in time."""

import time

import pytest

from accessaudit.operators.identity import ip_user_map
from accessaudit.streaming import user_state
from tests.helpers import rows

LOGINS = "ip string, requestTime string, event_id long, user string"
ORDER = ["requestTime", "event_id"]
FIRST = [("a", "2024-01-01", 1, "u1"), ("a", "2024-01-03", 2, "u2"), ("b", "2024-01-01", 3, "u3"), (None, "2024-01-09", 4, "x"), ("c", "2024-01-09", 5, None)]
SECOND = [("a", "2024-01-02", 6, "late"), ("b", "2024-01-01", 7, "u7"), ("b", "2024-01-01", 7, "u8"), ("d", None, 8, "u9"), ("d", None, None, "u0")]


@pytest.fixture
def run(spark, tmp_path):
    topic, checkpoint, changes = (str(tmp_path / n) for n in ("topic", "checkpoint", "changes"))

    def deliver(logins, ttl_ms=None):
        if logins:
            spark.createDataFrame(logins, LOGINS).coalesce(1).write.mode("append").json(topic)
        stream = spark.readStream.schema(LOGINS).json(topic)
        query = user_state.start_user_map(user_state.login_entries(stream, ORDER), checkpoint, changes, ttl_ms)
        user_state.run_out(query)
        return query

    deliver.checkpoint, deliver.changes = checkpoint, changes
    return deliver


def test_state_over_a_restart_equals_the_batch(spark, run):
    run(FIRST)
    query = run(SECOND)
    state = user_state.state_of(spark, run.checkpoint)
    batch = ip_user_map(spark.createDataFrame(FIRST + SECOND, LOGINS), ORDER)
    assert rows(state) == rows(batch) and state.count() == 3
    # only what changed was given out: a's late login changes nothing
    assert {r["key"] for r in spark.read.parquet(f"{run.changes}/batch_id=1").collect()} == {"ip_b", "ip_d"}
    size = user_state.state_sizes(query)[-1]
    assert (size["keys"], size["changed"]) == (3, 2) and size["bytes"] > 0


def test_entries_are_forgotten_in_time(spark, run):
    run(FIRST, ttl_ms=1500)
    assert spark.read.parquet(f"{run.changes}/batch_id=0").count() == 2
    time.sleep(2)
    run([("a", "2024-01-01", 0, "again")], ttl_ms=1500)  # older than what was forgotten
    last = spark.read.parquet(run.changes).where("user = 'again'").collect()
    assert len(last) == 1


def test_an_ip_with_all_logins_is_reduced_before_the_shuffle(spark):
    many = spark.range(0, 50_000, 1, 4).selectExpr("'hot' AS ip", "cast(id % 97 AS string) AS requestTime", "id AS event_id", "concat('u', id) AS user")
    entries = user_state.login_entries(many, ORDER)
    fewer = user_state.newest_of_batches(entries)
    assert fewer.count() <= 4 * 2
    assert rows(ip_user_map(many, ORDER)) == rows(ip_user_map(fewer.selectExpr("substring(key, 4) AS ip", *ORDER, "user"), ORDER))


def test_the_plan_keeps_its_state_in_rocksdb(spark, run):
    before = spark.conf.get(user_state.PROVIDER)
    query = run(FIRST)
    assert spark.conf.get(user_state.PROVIDER) == before
    assert any(m.startswith("rocksdb") for m in query.recentProgress[-1]["stateOperators"][0]["customMetrics"])
