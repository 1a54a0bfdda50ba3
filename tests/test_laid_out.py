"""Joins with bucketed reference tables against plain ones."""

import pytest

from accessaudit.operators import lookup
from accessaudit.operators.laid_out import join_laid_out, lay_out
from tests.helpers import plan_of, rows


@pytest.fixture
def fact(spark):
    made = [(i, f"10.0.0.{i % 40}") for i in range(400)] + [(1000 + i, "10.0.0.3") for i in range(300)]
    made += [(5000 + i, None) for i in range(50)] + [(6000, "elsewhere"), (6000, "elsewhere")]
    return spark.createDataFrame(made, "id long, ip string")


@pytest.fixture
def side(spark):
    known = [(f"10.0.0.{i}", f"area{i}") for i in range(30)] + [("10.0.0.3", "second"), ("10.0.0.5", None), (None, "x")]
    return spark.createDataFrame(known, "ip string, c_area string")


@pytest.mark.parametrize("how", ["left", "left_semi"])
@pytest.mark.parametrize("hot_rows", [10_000, 20])
def test_same_rows_and_no_shuffle_of_the_reference(spark, fact, side, how, hot_rows, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_ROWS", hot_rows)
    laid = lay_out(side, "ip", 6)
    try:
        got = join_laid_out(fact, laid, how)
        assert got.columns == (["id", "ip", "c_area"] if how == "left" else ["id", "ip"])
        assert rows(got) == rows(fact.join(side, "ip", how).select(*got.columns))
        plan = plan_of(got)
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        final = plan.split("Initial Plan")[0]
        assert final.count("Exchange hashpartitioning") == 1
    finally:
        laid.drop()


def test_hot_rows_are_dealt(spark, side, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_ROWS", 20)
    fact = spark.range(4000).selectExpr("id", "'10.0.0.3' as ip")
    laid = lay_out(side, "ip", 8)
    got = join_laid_out(fact, laid, "left").selectExpr("id", "c_area", "spark_partition_id() as task")
    sizes = [r["count"] for r in got.groupBy("task").count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 2000
    laid.drop()


def test_empty_sides_and_keys_that_are_no_text(spark, fact, side):
    laid = lay_out(side.limit(0), "ip", 4)
    assert join_laid_out(fact, laid, "left").where("c_area is null").count() == fact.count()
    assert join_laid_out(fact, laid, "left_semi").count() == 0
    assert join_laid_out(fact.limit(0), laid, "left").count() == 0
    laid.drop()
    with pytest.raises(ValueError):
        lay_out(spark.range(3), "id")
