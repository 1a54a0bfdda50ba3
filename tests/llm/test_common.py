"""Handing memory back changes no result."""

import pyarrow as pa

from accessaudit.llm.common import hand_back, lean


def test_lean_keeps_results_and_arguments():
    def doubled(batches):
        for x in batches:
            yield 2 * x

    one = pa.table({"a": list(range(1 << 18))})
    assert list(lean(doubled)(iter([1, 2, 3]))) == [2, 4, 6]
    assert list(lean(doubled)(iter([]))) == []
    assert lean(lambda key, t: t.slice(0, key))(3, one).num_rows == 3
    assert lean(lambda key, a, b: pa.concat_tables([a, b]))(0, one, one).num_rows == 1 << 19
    hand_back()


def test_lean_in_spark(spark):
    df = spark.range(1000).selectExpr("id % 7 as k", "id")
    got = df.groupBy("k").applyInArrow(lean(lambda key, t: t.slice(0, 1)), "k long, id long")
    assert got.count() == 7
    both = df.groupBy("k").cogroup(df.groupBy("k")).applyInArrow(lean(lambda key, a, b: a.slice(0, 2)), "k long, id long")
    assert both.count() == 14
