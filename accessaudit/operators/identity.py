"""Who was it: user names from login requests and the ip-to-user map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessaudit.functions import after_last_equals, clock_ms, map_key
from accessaudit.operators.lookup import join_measured


def login_users(logins: DataFrame, *keep: str) -> DataFrame:
    """`ip, requestTime, c_area, sysid, user` of login requests, failed or successful.

    `keep` names identity columns to carry along.
    """
    return logins.select(
        *keep, "ip", "requestTime", "c_area", "sysid", after_last_equals("query").alias("user")
    )


def max_pid_per_ip(user_ip: DataFrame) -> DataFrame:
    """Latest history row number per ip."""
    return user_ip.groupBy("ip").agg(F.max("pid").alias("pid"))


def latest_user(user_ip: DataFrame) -> DataFrame:
    """History rows whose `pid` is the greatest of some ip: the current user of each ip.

    The maximum combines map-side, so a hot ip is no hot spot, and `pid` is unique, so
    neither is the semi join; Spark broadcasts its keys when they turn out small.
    """
    return user_ip.join(max_pid_per_ip(user_ip).select("pid"), "pid", "left_semi")


def attach_known_user(users: DataFrame, latest: DataFrame) -> DataFrame:
    """Left join of the `username` known for the ip."""
    return join_measured(users, latest.select("ip", "username"), "ip", "left")


def ip_user_map(users: DataFrame, order: list[str], prior: DataFrame | None = None) -> DataFrame:
    """`key, user` plus the winning `order` columns: the last user seen per ip.

    Last means the greatest `order` (say request time, then record identity), so the
    outcome does not depend on how tasks ran. Rows without a user or ip do not count.
    `prior` is an earlier map of the same shape. One row per key and task is shuffled,
    whatever share of the logins one ip has.
    """
    seen = users.where(F.col("user").isNotNull() & F.col("ip").isNotNull()).select(
        map_key("ip").alias("key"), "user", *order
    )
    if prior is not None:
        seen = seen.unionByName(prior.select("key", "user", *order))
    return latest_entries(seen, order)


def latest_entries(entries: DataFrame, order: list[str]) -> DataFrame:
    """The entry with the greatest `order` of each `key`."""
    last = F.max(F.struct(*order, "user")).alias("last")
    return entries.groupBy("key").agg(last).select("key", "last.user", *[f"last.{c}" for c in order])


def short_user_pairs(users: DataFrame, below: int = 8) -> DataFrame:
    """Distinct `ip, user` with a user name shorter than `below` characters."""
    return users.where(F.length("user") < below).select("ip", "user").distinct()


def user_ip_rows(pairs: DataFrame, now: int | None = None) -> DataFrame:
    """Rows for the user-ip history: `ip, username, update_time`."""
    return pairs.select("ip", F.col("user").alias("username"), clock_ms(now).alias("update_time"))


def dedup_replay(df: DataFrame, identity: list[str], within: str | None = None) -> DataFrame:
    """Drop replayed records by their identity.

    On a stream, `within` (for example "10 minutes") bounds the remembered state: a record is
    dropped if its identity came less than that ago. The clock is the arrival of the
    micro-batch, which the checkpoint keeps for re-runs, so a record is never late, whatever its own
    time. In a batch, copies of one record are alike in every column, so grouping keeps one
    of them with a map-side combine.
    """
    if df.isStreaming:
        if within is None:
            raise ValueError("a stream needs `within` to bound its state")
        arrived = df.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
        return arrived.dropDuplicatesWithinWatermark(identity).drop("_arrived")
    return df.dropDuplicates(identity)
