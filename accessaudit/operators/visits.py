"""Visits to monitored services, and the reference columns attached to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessaudit.functions import canonical_port
from accessaudit.operators.lookup import Measured, Spread, as_measured, join_measured
from accessaudit.operators.membership import Values, keep_members


def monitored_service(flow: DataFrame, ports: Values, servers: Values) -> DataFrame:
    """Port in `ports` and server in `servers`: two independent lists, not pairs."""
    return keep_members(keep_members(flow, "port", ports), "serviceIp", servers)


def visit_flow(flow: DataFrame, ports: Values, servers: Values) -> DataFrame:
    """Monitored traffic that got an answer."""
    return monitored_service(flow.where(F.col("status_code").isNotNull()), ports, servers)


def enrich_area(flow: DataFrame, area: DataFrame | Measured, spread: Spread | None = None) -> DataFrame:
    """Left join of `c_area` on `ip = c_ip`. An ip listed twice gives two rows."""
    known = as_measured(area).map(lambda a: a.select(F.col("c_ip").alias("ip"), "c_area"))
    return join_measured(flow, known, "ip", "left", spread)


def enrich_system(flow: DataFrame, systems: DataFrame | Measured) -> DataFrame:
    """Left join of the system id as `sysid` on `port`. A port of two systems gives two rows."""
    known = as_measured(systems).map(
        lambda s: s.select(canonical_port("port").alias("port"), F.col("id").alias("sysid"))
    )
    return join_measured(flow, known, "port", "left")
