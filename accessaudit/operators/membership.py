"""`IN` and `NOT IN` against rule values kept as a table, with SQL's three values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessaudit.operators.bloom import can_filter, list_filter
from accessaudit.operators.lookup import Measured, ShortList, Spread, as_list, join_measured

NULL_POLICIES = ("sql", "ignore")
Values = DataFrame | Measured | ShortList


def keep_members(df: DataFrame, column: str, values: Values, spread: Spread | None = None) -> DataFrame:
    """Rows with `column IN values`; `values` has one column, repeats and NULLs allowed.

    Beyond a broadcast, rows that a Bloom filter of the list rules out are not shuffled.
    """
    values = as_list(values)
    if isinstance(values, ShortList):
        return df.where(F.col(column).isin(*values.values))
    known = values.map(lambda v: v.toDF(column).where(F.col(column).isNotNull()))
    if not values.fits and not df.isStreaming and can_filter(df.schema[column].dataType, known.frame.schema[column].dataType):
        bits = list_filter(known.frame, known.rows)
        df = df if bits is None else df.where(bits.might_hold(column))
    return join_measured(df, known, column, "left_semi", spread)


def with_membership(
    df: DataFrame,
    column: str,
    values: Values,
    flag: str,
    null_policy: str = "sql",
    spread: Spread | None = None,
) -> DataFrame:
    """Add `flag`: the three-valued result of `column IN values`.

    true    the value is listed
    false   it is not
    NULL    the column is NULL; or, under `"sql"`, it is not listed but the list holds a
            NULL, which SQL cannot tell apart. `"ignore"` reads such a list without it.

    An empty list gives false for every non-NULL value. Works the same on a stream, where
    a null-aware anti join does not.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    values = as_list(values)
    kept = [f"`{c}`" for c in df.columns if c != flag]
    if isinstance(values, ShortList):
        listed = F.col(column).isin(*values.values)
    else:
        marked = values.map(
            lambda v: v.toDF(column).where(F.col(column).isNotNull()).withColumn("_listed", F.lit(True))
        )
        df = join_measured(df, marked, column, "left", spread)
        kept += [f"`{spread.column}`"] if spread and spread.column in df.columns and f"`{spread.column}`" not in kept else []
        listed = F.col("_listed")
    unlisted = F.lit(None) if null_policy == "sql" and values.has_null else F.lit(False)
    verdict = F.when(F.col(column).isNotNull(), F.when(listed, F.lit(True)).otherwise(unlisted))
    return df.select(*kept, verdict.cast("boolean").alias(flag))
