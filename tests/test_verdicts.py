"""Visits, enrichment and routing against a row-by-row restatement."""

import random
from dataclasses import replace

import pytest

from accessaudit.operators.lookup import measure
from accessaudit.operators.verdicts import (
    auth_failure,
    auth_success,
    classify_flow,
    inside_whitelist,
    outside_whitelist,
    success_by_code,
)
from accessaudit.operators.visits import enrich_area, enrich_system, monitored_service, visit_flow
from accessaudit.plans.audit import audit_flow, enriched_visits, gather_references
from tests.helpers import FLOW_DDL, listed, rows, values

WHITE = ["10.0.0.1", "10.0.0.2", "10.0.0.3"]
ERRORS = ["401", "403"]
URLS = ["/in"]
AREA = [("10.0.0.1", "N"), ("10.0.0.1", "S"), ("10.0.0.9", "E")]
SYSTEMS = [("a", "80"), ("b", "080"), ("c", "81"), ("d", "x")]
RULES = [("80", "s1", "401", "/in"), ("81", "s2", "403", "/in")]
MODELS = [(1, 2), (4, 3)]


@pytest.fixture(scope="module")
def flow(spark):
    pick = random.Random(7)
    ips = [*WHITE, "10.0.0.9", None]
    made = [
        (
            n,
            "10.0.0.1" if n % 3 == 0 else pick.choice(ips),
            pick.choice(["s1", "s2", "s3", None]),
            pick.choice(["80", "81", "82", "x", None]),
            "2024-01-01T00:00:00Z",
            pick.choice(["/in", "/out", None]),
            pick.choice(["u=bob", None]),
            pick.choice(["200", "401", "403", None]),
        )
        for n in range(1500)
    ]
    return spark.createDataFrame(made, FLOW_DDL)


def make_refs(spark, white=WHITE, rules=RULES, **options):
    return gather_references(
        spark.createDataFrame(AREA, "c_ip string, c_area string"),
        spark.createDataFrame(SYSTEMS, "id string, port string"),
        values(spark, "ip", *white),
        spark.createDataFrame(rules, "port string, ip string, error string, url string"),
        spark.createDataFrame(MODELS, "id int, mleve int"),
        **options,
    )


@pytest.fixture(scope="module")
def refs(spark):
    return make_refs(spark)


def sql_in(value, items):
    if value is None:
        return None if items else (None if value is None else False)
    if value in [i for i in items if i is not None]:
        return True
    return None if None in items else False


def expected(flow, white, rules):
    """Verdicts row by row, with SQL's three values spelled out."""
    ports, servers, errors, urls = ([r[i] for r in rules] for i in range(4))
    out = []
    for r in flow.collect():
        if not (sql_in(r["port"], ports) and sql_in(r["serviceIp"], servers) and r["status_code"] is not None):
            continue
        inside, error, login = sql_in(r["ip"], white), sql_in(r["status_code"], errors), sql_in(r["url"], urls)
        if inside is False:
            verdict = ("1", 2, 1)
        elif inside and error and login:
            verdict = ("3", 3, 1)
        elif inside and error is False and login:
            verdict = ("0", 0, 0)
        else:
            continue
        for area in [a for ip, a in AREA if ip == r["ip"]] or [None]:
            for system in [i for i, p in SYSTEMS if r["port"] is not None and p.lstrip("0") == r["port"]] or [None]:
                out.append((r["event_id"], area, system, *verdict))
    return sorted(out, key=str)


OUT = ("event_id", "c_area", "sysid", "type", "level", "status")


@pytest.mark.parametrize(
    "white, rules",
    [
        (WHITE, RULES),
        ([*WHITE, None], RULES),
        (WHITE, [*RULES, (None, None, None, None)]),
        ([], RULES),
        (WHITE, []),
    ],
    ids=["plain", "null in whitelist", "null in rules", "empty whitelist", "no rules"],
)
@pytest.mark.parametrize("bounds", [{}, {"max_rows": -1}], ids=["small", "large"])
def test_audit_row_by_row(spark, flow, white, rules, bounds):
    out = audit_flow(flow, make_refs(spark, white, rules, **bounds))
    assert sorted(rows(out, *OUT).elements(), key=str) == expected(flow, white, rules)
    assert set(out.columns) == {*flow.columns, "c_area", "sysid", "type", "level", "status"}


def test_branches_split_the_visits(flow, refs):
    enriched = enriched_visits(flow, refs)
    outside = outside_whitelist(enriched, refs.whitelist)
    inside = inside_whitelist(enriched, refs.whitelist)
    failed = auth_failure(inside, refs.errors, refs.urls)
    passed = auth_success(inside, refs.errors, refs.urls)
    whole = classify_flow(enriched, refs.whitelist, refs.errors, refs.urls, 2, 3)
    parts = {"1": outside, "3": failed, "0": passed}
    for code, part in parts.items():
        assert rows(part) == rows(whole.where(f"type = '{code}'").select(*part.columns))
        assert part.count() > 0
    assert outside.count() + inside.count() == enriched.where("ip IS NOT NULL").count()
    assert rows(whole) == rows(audit_flow(flow, refs).select(*whole.columns))


def test_null_ip_is_in_neither_branch(spark, flow, refs):
    nobody = flow.where("ip IS NULL")
    assert nobody.count() > 0
    for white in (refs.whitelist, values(spark, "ip"), values(spark, "ip", "z")):
        assert outside_whitelist(nobody, white).isEmpty() and inside_whitelist(nobody, white).isEmpty()


def test_null_policy(spark, flow):
    white = values(spark, "ip", *WHITE, None)
    assert outside_whitelist(flow, white).isEmpty()
    assert not outside_whitelist(flow, white, "ignore").isEmpty()


def test_ports_and_servers_are_independent_lists(spark):
    flow = spark.createDataFrame([(1, "s2", "80", "200"), (2, "s3", "80", "200"), (3, "s2", "80", None)],
                                 "event_id int, serviceIp string, port string, status_code string")
    ports, servers = values(spark, "v", "80", "81"), values(spark, "v", "s1", "s2")
    assert listed(monitored_service(flow, ports, servers), "event_id") == [(1,), (3,)]
    assert listed(visit_flow(flow, ports, servers), "event_id") == [(1,)]


def test_fan_out_and_null_extension(spark):
    flow = spark.createDataFrame([(1, "10.0.0.1", "80"), (2, "10.0.0.7", "82"), (3, None, None)],
                                 "event_id int, ip string, port string")
    area = spark.createDataFrame(AREA, "c_ip string, c_area string")
    systems = spark.createDataFrame(SYSTEMS, "id string, port string")
    assert listed(enrich_area(flow, area), "event_id", "c_area") == [(1, "N"), (1, "S"), (2, None), (3, None)]
    assert listed(enrich_system(flow, systems), "event_id", "sysid") == [(1, "a"), (1, "b"), (2, None), (3, None)]


def test_success_by_code(flow):
    assert set(r["status_code"] for r in success_by_code(flow).select("status_code").distinct().collect()) == {"200", "403"}


def test_large_reference_tables_give_the_same_verdicts(spark, flow, refs):
    large = make_refs(spark, max_rows=-1)
    assert not large.area.fits
    assert rows(audit_flow(flow, large)) == rows(audit_flow(flow, refs))
    mixed = replace(refs, area=measure(refs.area.frame, max_rows=0)[0])
    assert rows(audit_flow(flow, mixed)) == rows(audit_flow(flow, refs))
