"""The audit's inputs, derived by Spark from whole TPC-H-like tables.

Every input reads all rows of its tables; conditions are on attributes (balance, segment,
event type), never on ids, so the work grows with the tables.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accessaudit.operators.rules import explode_rules, model_rules
from accessaudit.plans.audit import References, gather_references
from accessaudit.schemas import SERVICE_MODEL, WHITELIST_MODEL

CLOCK_MS = 1_700_000_000_000  # fixed clock of result rows
SINCE_MS = 1_705_000_000_000  # mid-January 2024: inside the events' time range

# The levels of the models and the rules of the service model.
MODEL_LEVELS = ((WHITELIST_MODEL, 2), (2, 1), (SERVICE_MODEL, 3))
SERVICE_RULES = tuple(
    {
        "port": str(8080 + i),
        "ip": f"192.168.0.{i % 3}",
        "error": "401" if i % 2 == 0 else "403",
        "url": "POST /cas/login",
    }
    for i in range(8)
)


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set; its footer is read for the schema once per application."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = (spark.sparkContext.applicationId, path)
    if known not in _SCHEMAS:
        _SCHEMAS[known] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[known]).parquet(path)


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _client_ip(key: str) -> Column:
    return F.concat(F.lit("10.0.0."), _text(key))


def _event_columns() -> dict[str, Column]:
    kind = F.col("event_type")
    ts = _text("ts")  # text of a timestamp without zone: independent of the session zone
    return {
        "ip": _client_ip("user_id"),
        "serviceIp": F.concat(F.lit("192.168.0."), (F.col("event_id") % 5).cast("string")),
        "port": (F.get_json_object("props", "$.k").cast("int") % 10 + 8080).cast("string"),
        "requestTime": F.concat(F.substring(ts, 1, 10), F.lit("T"), F.substring(ts, 12, 8), F.lit("Z")),
        "url": F.when(kind.isin("signup", "error"), "POST /cas/login")
        .when(kind == "purchase", "POST /pay")
        .when(kind == "view", "GET /view")
        .otherwise("GET /"),
        "query": F.when(F.col("event_id") % 50 == 0, F.lit(None))
        .when(F.col("event_id") % 50 == 1, "noequals")
        .otherwise(F.concat(F.lit("service=app&username=u"), _text("user_id"))),
        "status_code": F.when(kind == "error", "401")
        .when(kind == "signup", "302")
        .when(kind == "purchase", F.lit(None))
        .otherwise("200"),
    }


def flow_of(events: DataFrame) -> DataFrame:
    return events.select("event_id", *[c.alias(n) for n, c in _event_columns().items()])


def records_of(events: DataFrame, *keep: str) -> DataFrame:
    """The same visits as record text: `event_id, value`. Ports and codes are JSON numbers;
    a request without an answer has no `http`."""
    c = _event_columns()
    status = c["status_code"].cast("int")
    packet = F.struct(
        c["requestTime"].alias("@timestamp"),
        F.struct(c["ip"].alias("ip")).alias("source"),
        F.struct(c["serviceIp"].alias("ip"), c["port"].cast("int").alias("port")).alias("destination"),
        c["url"].alias("query"),
        F.struct(c["query"].alias("query")).alias("url"),
        F.when(status.isNotNull(), F.struct(F.struct(status.alias("status_code")).alias("response"))).alias("http"),
    )
    return events.select("event_id", *keep, F.to_json(packet).alias("value"))


def flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_of(table(spark, sf_dir, "events"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(table(spark, sf_dir, "events"))


def record_stream(spark: SparkSession, sf_dir: str, files_per_batch: int = 1000) -> DataFrame:
    """The records as a stream over the events table, whose files are the topic."""
    # The pattern in the last letter makes Spark list the path, be it a file or a folder.
    path = f"{sf_dir.rstrip('/')}/events.parque[t]"
    reader = spark.readStream.schema(table(spark, sf_dir, "events").schema)
    return records_of(reader.option("maxFilesPerTrigger", files_per_batch).parquet(path))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with `delivery`, the week they arrive in: that of the event, or the next one for
    those whose connection was slow (`k` a multiple of seven)."""
    events = table(spark, sf_dir, "events")
    week = F.floor((F.dayofmonth("ts") - 1) / 7).cast("int")
    slow = F.get_json_object("props", "$.k").cast("int") % 7 == 0
    return events.withColumn("delivery", week + F.when(slow, 1).otherwise(0))


def mixed_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records among chat lines that are no JSON: `origin, id, part, value`."""
    good = records(spark, sf_dir).select(
        F.lit("events").alias("origin"), F.col("event_id").alias("id"), F.lit(0).cast("bigint").alias("part"), "value"
    )
    chat = table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("origin"),
        F.col("conv_id").alias("id"),
        F.col("turn").alias("part"),
        F.col("text").alias("value"),
    )
    return good.unionByName(chat)


def area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices of customers in good standing and of all suppliers; an ip may have two."""
    nation = table(spark, sf_dir, "nation")
    customers = (
        table(spark, sf_dir, "customer").where("c_acctbal >= 0")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(_client_ip("c_custkey").alias("c_ip"), F.col("n_name").alias("c_area"))
    )
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(_client_ip("s_suppkey").alias("c_ip"), F.col("n_name").alias("c_area"))
    )
    return customers.unionAll(suppliers)


def systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One system per region and per nation; some ports have two systems, some none."""
    regions = table(spark, sf_dir, "region").select(
        _text("r_regionkey").alias("id"), (F.col("r_regionkey") * 2 + 8080).cast("string").alias("port")
    )
    nations = table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 100).cast("string").alias("id"),
        (F.col("n_nationkey") * 3 + 8080).cast("string").alias("port"),
    )
    return regions.unionAll(nations)


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known addresses: customers of every segment but one."""
    known = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    return known.select(_client_ip("c_custkey").alias("ip"))


def buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of customers with an order that is partly shipped, as often as they have one."""
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(_client_ip("o_custkey").alias("ip"))


def model_levels(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({i}, {level})" for i, level in MODEL_LEVELS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(id, mleve)")


def service_documents(spark: SparkSession) -> DataFrame:
    """Rule documents of the service model: an older one that must lose, and the current."""
    old = json.dumps([{"port": "9", "ip": "none", "error": "500", "url": "none"}])
    new = json.dumps(SERVICE_RULES)
    return spark.sql(
        f"SELECT * FROM VALUES (10, {SERVICE_MODEL}, '{old}'), (12, {SERVICE_MODEL}, '{new}') AS t(id, modeId, jsonstr)"
    )


def rule_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of both models; the whitelist's lists one address for each nation."""
    listed = F.sort_array(F.collect_list(F.struct(_client_ip("n_nationkey").alias("ip"))))
    nations = table(spark, sf_dir, "nation").agg(F.to_json(listed).alias("jsonstr"))
    return nations.select(F.lit(11).alias("id"), F.lit(WHITELIST_MODEL).alias("modeId"), "jsonstr").unionAll(
        service_documents(spark)
    )


def service_rules(spark: SparkSession) -> DataFrame:
    return explode_rules(model_rules(model_levels(spark), service_documents(spark), SERVICE_MODEL))


def references(spark: SparkSession, sf_dir: str, **options) -> References:
    return gather_references(
        area(spark, sf_dir),
        systems(spark, sf_dir),
        whitelist(spark, sf_dir),
        service_rules(spark),
        model_levels(spark),
        **options,
    )


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model per customer in good standing."""
    known = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return known.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("mleve"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule document per order, for the model of its customer: arrays, single objects,
    and documents that are absent, empty or broken."""
    key, low = F.col("o_orderkey"), F.col("o_orderpriority")
    ip = _client_ip("o_custkey")
    two = F.concat(
        F.lit('[{"ip":"'), ip, F.lit('"},{"port":"'), (key % 10 + 8080).cast("string"),
        F.lit('","ip":"192.168.0.'), (key % 3).cast("string"), F.lit('","error":"401","url":"POST /cas/login"}]'),
    )
    other = (
        F.when(low.startswith("1"), F.lit("bad"))
        .when(low.startswith("2"), F.lit("[]"))
        .when(low.startswith("3"), F.lit(""))
        .when(low.startswith("4"), F.concat(F.lit('[{"port":'), (key % 10 + 8080).cast("string"), F.lit("}]")))
    )
    text = (
        F.when(F.col("o_orderstatus") == "F", two)
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit('{"ip":"'), ip, F.lit('"}')))
        .otherwise(other)
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("id"), F.col("o_custkey").alias("modeId"), text.alias("jsonstr")
    )


def user_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of user names seen per ip: `pid, ip, username`."""
    signups = table(spark, sf_dir, "events").where("event_type = 'signup'")
    name = F.concat(F.lit("u"), (F.col("user_id") + F.col("event_id") % 3).cast("string"))
    return signups.select(F.col("event_id").alias("pid"), _client_ip("user_id").alias("ip"), name.alias("username"))


def user_ip_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of `user_ip` with the week of the month each row is from: `ip, pid, week`."""
    signups = table(spark, sf_dir, "events").where("event_type = 'signup'")
    week = F.floor((F.dayofmonth("ts") - 1) / 7).cast("int")
    return signups.select(_client_ip("user_id").alias("ip"), F.col("event_id").alias("pid"), week.alias("week"))


def topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as a topic with a partition per user: `part, off, value`."""
    events = table(spark, sf_dir, "events").withColumn("part", F.col("user_id").cast("int"))
    return records_of(events, "part").select("part", F.col("event_id").alias("off"), "value")


def offsets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Earliest and stored offsets, one topic partition per user: the first larger click and
    the first large purchase, which may come earlier, later, or not at all."""
    events = table(spark, sf_dir, "events")
    part = F.col("user_id").cast("int").alias("part")
    first = F.min("event_id").alias("off")
    earliest = events.where("event_type = 'click' AND value > 30").groupBy(part).agg(first)
    stored = events.where("event_type = 'purchase' AND value > 100").groupBy(part).agg(first)
    return earliest, stored
