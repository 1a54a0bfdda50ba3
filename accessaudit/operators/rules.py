"""Rules stored as JSON documents per model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessaudit.schemas import RULE_ATTRIBUTES, RULES


def newest_documents(docs: DataFrame) -> DataFrame:
    """`modeId, jsonstr` of the document with the greatest `id` of each model.

    One pass with a map-side combine: each task hands on one document per model, so a model
    holding most documents is no hot spot.
    """
    newest = F.max(F.struct("id", "jsonstr")).alias("newest")
    return docs.where(F.col("modeId").isNotNull()).groupBy("modeId").agg(newest).select("modeId", "newest.jsonstr")


def model_rules(models: DataFrame, docs: DataFrame, model_id: int | None = None) -> DataFrame:
    """`id, level, jsonstr` of every model with its newest document, NULL when it has none.

    With `model_id` only that model: its predicate reaches both scans, and each task hands
    on one document.
    """
    if model_id is not None:
        models = models.where(F.col("id") == F.lit(model_id))
        newest = docs.where(F.col("modeId") == F.lit(model_id)).orderBy(F.desc("id")).limit(1)
    else:
        newest = newest_documents(docs)
    newest = newest.select(F.col("modeId").alias("id"), "jsonstr")
    return models.select("id", F.col("mleve").alias("level")).join(newest, "id", "left")


def explode_rules(rules: DataFrame) -> DataFrame:
    """One row per rule object in `jsonstr`: its `port, ip, error, url`, NULL when absent.

    NULL, malformed and empty documents have no rules; a single object counts as one.
    """
    keep = [f"`{c}`" for c in rules.columns if c != "jsonstr"]
    return rules.select(*keep, F.inline(F.from_json("jsonstr", RULES)))


def missing_rules(rules: DataFrame) -> DataFrame:
    """Models whose document is absent or cannot be read."""
    return rules.where(F.from_json("jsonstr", RULES).isNull())


def rule_values(rules: DataFrame) -> DataFrame:
    """Distinct `attribute, value` over all rules with the `level` that applies.

    NULL values stay: under SQL's rules for `NOT IN` they matter.
    """
    long = rules.unpivot("level", list(RULE_ATTRIBUTES), "attribute", "value")
    return long.groupBy("attribute", "value").agg(F.max("level").alias("level"))


def rule_list(rules: DataFrame, attribute: str) -> DataFrame:
    """Distinct values of one attribute, as the one-column list the filters take."""
    return rules.select(F.col(attribute).alias("value")).distinct()


def model_level(models: DataFrame, wanted: DataFrame) -> DataFrame:
    """`id, level` for every id in `wanted`; 0 for a model that does not exist."""
    levels = models.groupBy("id").agg(F.max("mleve").alias("level"))
    return (
        wanted.select("id").distinct().join(levels, "id", "left")
        .select("id", F.coalesce("level", F.lit(0)).alias("level"))
    )
