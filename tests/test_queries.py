"""Every registered query against its SQL in DuckDB."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from accessaudit.operators import lookup
from accessaudit.plans.catalog import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(QUERIES) <= set(entry_point.oracle_sql())


def compare(spark, data, duck, name):
    df = entry_point.queries()[name](spark, data)
    columns = sorted(df.columns)
    got = Counter(tuple(r[c] for c in columns) for r in df.collect())
    cursor = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = Counter(tuple(r[p] for p in places) for r in cursor.fetchall())
    assert sum(want.values()) > 0
    assert got == want
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, data, duck, name):
    compare(spark, data, duck, name)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["type", "request_day", "subsystem", "visits"]
    assert df.count() > 0


def test_offset_cases_all_occur(spark, data):
    from accessaudit.plans import testbed

    earliest, stored = testbed.offsets(spark, data)
    first = {r["part"]: r["off"] for r in earliest.collect()}
    kept = {r["part"]: r["off"] for r in stored.collect()}
    assert first.keys() - kept.keys()
    assert any(kept[p] < first[p] for p in first if p in kept)
    assert any(kept[p] > first[p] for p in first if p in kept)


LARGE_PATH = ["classify_flow", "outside_whitelist", "auth_success", "attach_known_user", "column_gate", "dense_ids", "verdict_summary"]


@pytest.mark.parametrize("name", LARGE_PATH)
def test_query_matches_sql_when_nothing_may_be_broadcast(spark, data, duck, monkeypatch, name):
    """The same queries with every reference table taken as too large."""
    monkeypatch.setattr(lookup.Measured, "fits", property(lambda side: False))
    monkeypatch.setattr(lookup.Measured, "is_short", property(lambda side: False))
    compare(spark, data, duck, name)
