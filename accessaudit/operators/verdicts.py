"""Routing of visits: outside the whitelist, failed login, successful login."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessaudit.operators.lookup import Spread
from accessaudit.operators.membership import Values, keep_members, with_membership
from accessaudit.schemas import LOGIN_FAILED, LOGIN_SUCCEEDED, OUTSIDE_WHITELIST


def _not_in(df: DataFrame, column: str, values: Values, null_policy: str) -> DataFrame:
    flagged = with_membership(df, column, values, "_member", null_policy)
    return flagged.where(~F.col("_member")).drop("_member")


def outside_whitelist(visits: DataFrame, whitelist: Values, null_policy: str = "sql") -> DataFrame:
    """`ip NOT IN whitelist`; a NULL ip is neither outside nor inside."""
    return _not_in(visits, "ip", whitelist, null_policy)


def inside_whitelist(visits: DataFrame, whitelist: Values) -> DataFrame:
    """`ip IN whitelist`."""
    return keep_members(visits, "ip", whitelist)


def auth_failure(inside: DataFrame, errors: Values, urls: Values) -> DataFrame:
    """Login requests answered with an error code."""
    return keep_members(keep_members(inside, "url", urls), "status_code", errors)


def auth_success(inside: DataFrame, errors: Values, urls: Values, null_policy: str = "sql") -> DataFrame:
    """Login requests answered with anything but an error code."""
    return _not_in(keep_members(inside, "url", urls), "status_code", errors, null_policy)


def success_by_code(inside: DataFrame, codes: tuple[str, ...] = ("401",)) -> DataFrame:
    """The older notion of success: any answer whose code is not one of `codes`."""
    return inside.where(~F.col("status_code").isin(*codes))


def classify_flow(
    visits: DataFrame,
    whitelist: Values,
    errors: Values,
    urls: Values,
    violation_level: int = 0,
    failure_level: int = 0,
    null_policy: str = "sql",
    spread: Spread | None = None,
) -> DataFrame:
    """Add `type, level, status` and keep the visits that got a verdict.

    One pass over the visits: three membership flags, one `when`. The branches exclude
    each other, and a flag that is NULL satisfies none of them.
    """
    flagged = with_membership(visits, "ip", whitelist, "_inside", null_policy, spread)
    flagged = with_membership(flagged, "status_code", errors, "_error", null_policy)
    flagged = with_membership(flagged, "url", urls, "_login", null_policy)
    inside, error, login = F.col("_inside"), F.col("_error"), F.col("_login")
    verdict = (
        F.when(~inside, F.lit(OUTSIDE_WHITELIST))
        .when(inside & error & login, F.lit(LOGIN_FAILED))
        .when(inside & ~error & login, F.lit(LOGIN_SUCCEEDED))
    )
    level = (
        F.when(F.col("type") == OUTSIDE_WHITELIST, F.lit(violation_level))
        .when(F.col("type") == LOGIN_FAILED, F.lit(failure_level))
        .otherwise(F.lit(0))
    )
    return (
        flagged.withColumn("type", verdict)
        .where(F.col("type").isNotNull())
        .withColumn("level", level)
        .withColumn("status", F.when(F.col("type") == LOGIN_SUCCEEDED, 0).otherwise(1))
        .drop("_inside", "_error", "_login")
    )


def with_verdict(df: DataFrame, code: str, level: int, status: int) -> DataFrame:
    """Label every row with one verdict."""
    return df.withColumns({"type": F.lit(code), "level": F.lit(level), "status": F.lit(status)})
