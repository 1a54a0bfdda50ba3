"""Plans: what must not appear at scale."""

import re

import pytest

from accessaudit.operators.lookup import measure, value_lists
from accessaudit.operators.visits import visit_flow
from accessaudit.plans import testbed
from accessaudit.plans.audit import audit_records
from accessaudit.plans.catalog import QUERIES
from tests.helpers import plan_of, values

STREAMS = {name for name in QUERIES if name.startswith("stream_")} | {"packet_stream"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "Window")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_cross_join_no_python_no_global_window(spark, data, name):
    plan = plan_of(QUERIES[name](spark, data))
    assert not [word for word in FORBIDDEN if word in plan]
    assert "SinglePartition" not in plan


def test_traffic_is_not_shuffled_before_its_verdict(spark, data):
    """With small references the only exchanges are on the reference side."""
    verdicts = audit_records(testbed.records(spark, data), testbed.references(spark, data))
    plan = plan_of(verdicts)
    spine = [line for line in plan.splitlines() if re.match(r"^[ :]*[:+]- .*Exchange hashpartitioning", line)]
    assert all("event_id" not in line for line in spine)
    top = plan.split("FileScan parquet")[0]  # from the root down the traffic side to its scan
    assert "Exchange hashpartitioning" not in top and "BroadcastHashJoin" in top


def test_short_lists_reach_the_scan(spark, data, tmp_path):
    testbed.flow(spark, data).write.parquet(str(tmp_path / "flow"))
    flow = spark.read.parquet(str(tmp_path / "flow"))
    kept = visit_flow(flow, values(spark, "v", "8080", "8081"), values(spark, "v", "192.168.0.0"))
    plan = plan_of(kept.select("event_id"))
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "IsNotNull(status_code)" in pushed and "In(port, [8080,8081])" in pushed
    assert re.search(r"ReadSchema: struct<event_id:bigint,serviceIp:string,port:string,status_code:string>", plan)


def test_broadcasts_are_bounded(spark, data):
    """No broadcast hint without a measured size: beyond the bound the hint is gone."""
    large = measure(testbed.area(spark, data), max_bytes=10)[0]
    assert not large.fits
    small = testbed.references(spark, data)
    assert small.area.fits and small.area.bytes <= small.area.max_bytes


def test_short_lists_reach_the_scan_beside_a_long_one(spark, tmp_path):
    """1,200 urls do not keep the ports and servers of the same table from the scan."""
    flow = spark.range(9).selectExpr("cast(id as string) as port", "'s' as serviceIp", "'200' as status_code")
    flow.write.parquet(str(tmp_path / "flow"))
    rules = spark.range(1200).selectExpr("cast(id % 3 as string) as port", "'s' as ip", "concat('u', id) as url")
    lists = value_lists(rules)
    plan = plan_of(visit_flow(spark.read.parquet(str(tmp_path / "flow")), lists["port"], lists["ip"]))
    pushed = re.search(r"PushedFilters: \[([^]]*)", plan)[1]
    assert "port" in pushed and "serviceIp" in pushed
    assert "Join" not in plan
