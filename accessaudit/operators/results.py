"""Result rows, dense ids and alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessaudit.functions import after_last_equals, clock_ms, null_as_word
from accessaudit.schemas import LOGIN_FAILED, OUTSIDE_WHITELIST
from accessaudit.session import fresh_folder, written

TEXT_COLUMNS = ("ip", "user", "subsystem", "requestTime", "area")
LOCAL_BITS = 33  # fixed value: row-number bits below the partition in monotonically_increasing_id


def result_rows(
    verdicts: DataFrame,
    *keep: str,
    now: int | Column | None = None,
    null_as_text: bool = False,
) -> DataFrame:
    """Result columns (all but `pid`) of labelled visits; `keep` names identity columns.

    The user is the `user` column, or else taken from `query`. A whitelist violation has no
    user; its user column holds a single space. With `null_as_text` missing text is written
    as the word `null`.
    """
    known = F.col("user") if "user" in verdicts.columns else after_last_equals("query")
    user = F.when(F.col("type") == OUTSIDE_WHITELIST, F.lit(" ")).otherwise(known)
    rows = verdicts.select(
        *keep,
        "ip",
        user.alias("user"),
        F.col("sysid").alias("subsystem"),
        "requestTime",
        F.col("c_area").alias("area"),
        "type",
        "level",
        "status",
        clock_ms(now).alias("update_time"),
        F.col("status").alias("abnormal"),
    )
    if null_as_text:
        rows = rows.withColumns({c: null_as_word(c) for c in TEXT_COLUMNS})
    return rows


def violation_rows(verdicts: DataFrame, *keep: str, now: int | Column | None = None) -> DataFrame:
    """Result rows of visits from outside the whitelist."""
    return result_rows(verdicts.where(F.col("type") == OUTSIDE_WHITELIST), *keep, now=now)


def numbered(df: DataFrame, order: list[str], path: str, base: int = 0) -> tuple[DataFrame, int]:
    """`df` with a dense `pid` = base+1 .. base+n, and n.

    With an `order` the rows are sorted over range partitions, and a re-run gives every row
    the same id; rows that tie are ordered by a hash of the whole row. Without an order the
    ids follow the rows as they come, with no shuffle at all. Each row keeps its task and its
    place in it and is written once below `path`, because a second evaluation could cut the
    tasks elsewhere. Counting rows per task then reads one column, and the starts, one per
    task, are broadcast. No single task sees all rows.
    """
    spark = df.sparkSession
    position = F.monotonically_increasing_id()
    placed = df
    if order:
        # The sort samples its input before it reads it, so the input is written first. There
        # every row also gets a number: ranges can then cut through ties and through copies
        # of one row, which would otherwise all fall to one task.
        row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        rows = df.select("*", row_hash.alias("_hash"), position.alias("_copy"))
        placed = written(rows, f"{path}/rows").orderBy(*order, "_hash", "_copy").drop("_hash", "_copy")
    placed = written(placed.select("*", position.alias("_place")), f"{path}/placed")
    task = F.shiftright("_place", LOCAL_BITS).cast("int")
    counts = placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("n")).collect()
    starts, total = [], 0
    for row in sorted(counts, key=lambda r: r["_task"]):
        starts.append((row["_task"], base + total))
        total += row["n"]
    first = spark.createDataFrame(starts, "_task int, _start bigint")
    place = F.col("_place").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    result = (
        placed.withColumn("_task", task)
        .join(F.broadcast(first), "_task")
        .withColumn("pid", F.col("_start") + place + 1)
        .select("pid", *[f"`{c}`" for c in df.columns])
    )
    return result, total


def dense_ids(df: DataFrame, order: list[str], base: int = 0) -> DataFrame:
    """Add `pid` = base+1 .. base+n, see `numbered`; the rows go to the shared folder."""
    return numbered(df, order, fresh_folder(df.sparkSession, "dense-ids"), base)[0]


def alarm_messages(results: DataFrame, level: int | None = None) -> DataFrame:
    """One alarm per failed login: `pid, username, level` and the same as JSON `message`.
    `level` replaces the level of the results."""
    failed = results.where(F.col("type") == LOGIN_FAILED)
    return _alarms(failed if level is None else failed.withColumn("level", F.lit(level)))


def alarms_since(results: DataFrame, since_ms: int) -> DataFrame:
    """Alarms of abnormal results updated after `since_ms` whose user is known."""
    return _alarms(
        results.where(
            (F.col("status") == 1) & (F.col("update_time") > since_ms) & (F.col("user") != "null")
        )
    )


def _alarms(results: DataFrame) -> DataFrame:
    fields = results.select("pid", F.col("user").alias("username"), "level")
    return fields.withColumn("message", F.to_json(F.struct("pid", "username", "level")))


def verdict_summary(results: DataFrame) -> DataFrame:
    """Number of verdicts per type, day and system."""
    day = F.substring("requestTime", 1, 10)
    return results.groupBy("type", day.alias("request_day"), F.col("sysid").alias("subsystem")).agg(
        F.count(F.lit(1)).alias("visits")
    )
