"""Three-valued membership, for literal, broadcast and shuffled lists."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from accessaudit.operators.lookup import measure
from accessaudit.operators.membership import keep_members, with_membership
from tests.helpers import listed, values


def forms(frame):
    """The same list as literals, as a broadcast table and as a shuffled one."""
    column = frame.columns[0]
    unique = frame.distinct().withColumnRenamed(column, "value")
    broadcast = measure(unique)[0]
    return {"literal": frame, "broadcast": broadcast, "shuffled": replace(broadcast, max_rows=-1)}


FORMS = ["literal", "broadcast", "shuffled"]


@pytest.fixture(scope="module")
def visits(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "n int, ip string")


def flags(df):
    return {r["n"]: r["f"] for r in df.collect()}


@pytest.mark.parametrize("form", FORMS)
class TestFlag:
    def flag(self, spark, visits, form, *items, **kw):
        return flags(with_membership(visits, "ip", forms(values(spark, "v", *items))[form], "f", **kw))

    def test_plain_list(self, spark, visits, form):
        assert self.flag(spark, visits, form, "a", "a", "z") == {1: True, 2: False, 3: None, 4: True}

    def test_null_in_list_hides_the_unlisted(self, spark, visits, form):
        assert self.flag(spark, visits, form, "a", None) == {1: True, 2: None, 3: None, 4: True}

    def test_null_in_list_ignored(self, spark, visits, form):
        got = self.flag(spark, visits, form, "a", None, null_policy="ignore")
        assert got == {1: True, 2: False, 3: None, 4: True}

    def test_empty_list(self, spark, visits, form):
        assert self.flag(spark, visits, form) == {1: False, 2: False, 3: None, 4: False}

    def test_list_of_null_only(self, spark, visits, form):
        assert self.flag(spark, visits, form, None) == {1: None, 2: None, 3: None, 4: None}


@pytest.mark.parametrize("form", FORMS)
def test_keep_members(spark, visits, form):
    pick = lambda *items: listed(keep_members(visits, "ip", forms(values(spark, "v", *items))[form]), "n")
    assert pick("a", None, "a") == [(1,), (4,)]
    assert pick() == []


def test_agrees_with_sql(spark, visits):
    for items in (("a", "z"), ("a", None)):
        values(spark, "v", *items).createOrReplaceTempView("known")
        visits.createOrReplaceTempView("visits")
        want = spark.sql("SELECT n FROM visits WHERE ip NOT IN (SELECT v FROM known)")
        got = with_membership(visits, "ip", spark.table("known"), "f").where(~F.col("f"))
        assert listed(got, "n") == listed(want, "n")


def test_unknown_policy(spark, visits):
    with pytest.raises(ValueError):
        with_membership(visits, "ip", values(spark, "v", "a"), "f", null_policy="maybe")


def test_existing_flag_is_replaced_and_columns_kept(spark, visits):
    marked = visits.withColumn("f", F.lit("old"))
    out = with_membership(marked, "ip", values(spark, "v", "a"), "f")
    assert out.columns == ["n", "ip", "f"] and out.schema["f"].dataType.simpleString() == "boolean"
