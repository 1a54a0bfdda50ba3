"""Rule documents."""

import json

import pytest
from pyspark.sql import functions as F

from accessaudit.operators.lookup import ShortList, value_lists
from accessaudit.operators.rules import (
    explode_rules,
    missing_rules,
    model_level,
    model_rules,
    newest_documents,
    rule_list,
    rule_values,
)
from accessaudit.plans.audit import references_from_documents
from tests.helpers import listed, rows, values

MODELS = [(1, 2), (2, 1), (4, 3)]
DOCS = [
    (10, 1, '[{"ip":"10.0.0.999"}]'),
    (11, 1, '[{"ip":"10.0.0.1"},{"ip":"10.0.0.2"}]'),
    (12, 4, json.dumps([{"port": 80, "ip": "s1", "error": "401", "url": "/in"}, {"port": "080"}])),
]


@pytest.fixture(scope="module")
def models(spark):
    return spark.createDataFrame(MODELS, "id int, mleve int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, modeId int, jsonstr string")


def test_newest_document_of_one_model(models, docs):
    assert listed(model_rules(models, docs, 1), "id", "level", "jsonstr") == [(1, 2, DOCS[1][2])]


def test_model_without_document_and_model_that_does_not_exist(models, docs):
    assert listed(model_rules(models, docs, 2), "id", "level", "jsonstr") == [(2, 1, None)]
    assert model_rules(models, docs, 3).count() == 0


def test_all_models_equal_each_model(models, docs):
    one_by_one = model_rules(models, docs, 1).unionAll(model_rules(models, docs, 2)).unionAll(model_rules(models, docs, 4))
    assert rows(model_rules(models, docs)) == rows(one_by_one)


def test_same_as_the_sql_text(spark, models, docs):
    models.createOrReplaceTempView("m")
    docs.createOrReplaceTempView("d")
    for n, _ in MODELS:
        want = spark.sql(
            f"SELECT m.mleve AS level, d.jsonstr FROM m LEFT JOIN d ON m.id = d.modeId "
            f"WHERE m.id = {n} ORDER BY d.id DESC LIMIT 1"
        )
        assert rows(model_rules(models, docs, n), "level", "jsonstr") == rows(want, "level", "jsonstr")


def test_newest_documents_with_a_hot_model(spark):
    n = F.col("id")
    docs = spark.range(3000).select(
        n, F.when(n % 3 == 0, 0).otherwise(n % 50).alias("modeId"), F.when(n % 7 != 0, n.cast("string")).alias("jsonstr")
    )
    last = {}
    for row in docs.orderBy("id").collect():
        last[row["modeId"]] = row["jsonstr"]
    assert {r["modeId"]: r["jsonstr"] for r in newest_documents(docs).collect()} == last


def test_rules_of_every_kind_of_document(spark):
    texts = ["bad", "", "[]", None, '{"ip":"a"}', '[{"ip":"b"},{"port":80}]', '[{"port":"x"}]']
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, jsonstr string")
    assert listed(explode_rules(docs), "id", "port", "ip") == [
        (4, None, "a"), (5, None, "b"), (5, "80", None), (6, "x", None),
    ]
    assert listed(missing_rules(docs), "id") == [(0,), (1,), (3,)]


def test_values_keep_null_and_level(models, docs):
    found = rule_values(explode_rules(model_rules(models, docs, 4)))
    assert listed(found.where("attribute IN ('port', 'error')"), "attribute", "value", "level") == [
        ("error", None, 3), ("error", "401", 3), ("port", "080", 3), ("port", "80", 3),
    ]
    assert listed(rule_list(explode_rules(model_rules(models, docs, 4)), "url"), "value") == [(None,), ("/in",)]


def test_levels_default_to_zero(spark, models):
    wanted = values(spark, "id", 1, 3, 4, 4, kind="int")
    assert listed(model_level(models, wanted), "id", "level") == [(1, 2), (3, 0), (4, 3)]


def test_references_from_documents(spark, models, docs):
    area = spark.createDataFrame([("10.0.0.1", "N")], "c_ip string, c_area string")
    systems = spark.createDataFrame([("7", "80")], "id string, port string")
    refs = references_from_documents(area, systems, models, docs)
    assert refs.whitelist == ShortList(("10.0.0.1", "10.0.0.2"), False)
    assert refs.ports == ShortList(("080", "80"), False)
    assert refs.errors == ShortList(("401",), True)  # the second rule names no error
    assert (refs.violation_level, refs.failure_level) == (2, 3)
    bare = references_from_documents(area, systems, models.where("id = 2"), docs)
    assert bare.whitelist == ShortList((), False) and (bare.violation_level, bare.failure_level) == (0, 0)


def test_large_rule_lists_stay_tables(spark):
    table = spark.range(2000).select(F.col("id").cast("string").alias("ip"))
    assert value_lists(table)["ip"].frame.count() == 2000
