"""The audit as one plan: records -> flow -> visits -> verdicts.

The same functions serve a batch and a stream; nothing here runs a job on the traffic,
except the search for hot ips when a reference table is too large to broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessaudit.operators.lookup import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    Measured,
    ShortList,
    Spread,
    find_spread,
    measure,
    value_lists,
)
from accessaudit.operators.packets import parse_packets, project_flow
from accessaudit.operators.rules import explode_rules, model_rules
from accessaudit.operators.verdicts import classify_flow
from accessaudit.operators.visits import enrich_area, enrich_system, visit_flow
from accessaudit.schemas import RULE_ATTRIBUTES, SERVICE_MODEL, WHITELIST_MODEL

ListSide = ShortList | Measured
HOT_IP_SAMPLE = 0.02  # share of the traffic looked at to find hot ips; all of it is audited


@dataclass(frozen=True)
class References:
    """Measured reference tables, rule lists, and the levels of the two models."""

    area: Measured
    systems: Measured
    whitelist: ListSide
    ports: ListSide
    servers: ListSide
    errors: ListSide
    urls: ListSide
    violation_level: int
    failure_level: int
    cached: tuple[DataFrame, ...] = ()

    def unpersist(self) -> None:
        for frame in self.cached:
            frame.unpersist()


def gather_references(
    area: DataFrame,
    systems: DataFrame,
    whitelist: DataFrame,
    service_rules: DataFrame,
    models: DataFrame,
    cache: bool = False,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> References:
    """Measure everything the audit looks up.

    `whitelist` has an `ip` column, `service_rules` has `port, ip, error, url`. `cache`
    keeps the tables that fit a broadcast for the batches that follow.
    """
    frames = (
        area.select("c_ip", "c_area"),
        systems.select("port", "id"),
        whitelist.select("ip"),
        service_rules.select(*RULE_ATTRIBUTES),
    )
    sides = measure(*frames, max_rows=max_rows, max_bytes=max_bytes)
    cached = tuple(side.frame.persist() for side in sides if cache and side.fits)
    areas, monitored, known, rules = sides
    lists = value_lists(rules)
    levels = models.agg(_level_of(WHITELIST_MODEL), _level_of(SERVICE_MODEL)).first()
    return References(
        area=areas,
        systems=monitored,
        whitelist=value_lists(known)["ip"],
        ports=lists["port"],
        servers=lists["ip"],
        errors=lists["error"],
        urls=lists["url"],
        violation_level=levels[0],
        failure_level=levels[1],
        cached=cached,
    )


def _level_of(model_id: int) -> Column:
    return F.coalesce(F.max(F.when(F.col("id") == model_id, F.col("mleve"))), F.lit(0))


def references_from_documents(
    area: DataFrame, systems: DataFrame, models: DataFrame, docs: DataFrame, **options
) -> References:
    """References whose rules come from the newest rule document of each model."""
    return gather_references(
        area,
        systems,
        explode_rules(model_rules(models, docs, WHITELIST_MODEL)),
        explode_rules(model_rules(models, docs, SERVICE_MODEL)),
        models,
        **options,
    )


def enriched_visits(flow: DataFrame, refs: References) -> DataFrame:
    """Monitored visits with `c_area` and `sysid`."""
    return enrich_system(enrich_area(visit_flow(flow, refs.ports, refs.servers), refs.area), refs.systems)


def hot_ips(traffic: DataFrame, refs: References, of_records: bool = False) -> Spread | None:
    """The ips whose rows need spreading, or None when both ip tables fit a broadcast.

    Found on a sample of the traffic, taken before the costly parse. It only decides how rows
    are dealt over tasks: every row is audited, whichever ips are found.
    """
    if (refs.area.fits and refs.whitelist.fits) or traffic.isStreaming:
        return None
    some = traffic.sample(HOT_IP_SAMPLE, seed=0)
    flow = project_flow(parse_packets(some)) if of_records else some
    return find_spread(visit_flow(flow, refs.ports, refs.servers), "ip", 1 / HOT_IP_SAMPLE)


def audit_flow(
    flow: DataFrame, refs: References, null_policy: str = "sql", spread: Spread | None = None
) -> DataFrame:
    """Verdicts of a flow: its columns plus `c_area, sysid, type, level, status`.

    Verdicts need neither area nor system, so visits without one are dropped before those
    joins widen the rest. Whitelist and area are both looked up by ip: when one of them is
    too large to broadcast, the hot ips are found once and both joins share one spread. A
    caller who knows them from an earlier run passes `spread`.
    """
    spread = spread or hot_ips(flow, refs)
    verdicts = classify_flow(
        visit_flow(flow, refs.ports, refs.servers),
        refs.whitelist,
        refs.errors,
        refs.urls,
        refs.violation_level,
        refs.failure_level,
        null_policy,
        spread,
    )
    verdicts = enrich_system(enrich_area(verdicts, refs.area, spread), refs.systems)
    return verdicts.drop(spread.column) if spread else verdicts


def audit_records(
    raw: DataFrame, refs: References, null_policy: str = "sql", spread: Spread | None = None
) -> DataFrame:
    """Verdicts of raw records."""
    spread = spread or hot_ips(raw, refs, of_records=True)
    return audit_flow(project_flow(parse_packets(raw)), refs, null_policy, spread)
