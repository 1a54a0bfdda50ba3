"""Comparing results as multisets of rows."""

from collections import Counter

FLOW_DDL = (
    "event_id long, ip string, serviceIp string, port string, requestTime string, "
    "url string, query string, status_code string"
)


def rows(df, *columns):
    columns = columns or sorted(df.columns)
    return Counter(tuple(r[c] for c in columns) for r in df.select(*[f"`{c}`" for c in columns]).collect())


def listed(df, *columns):
    return sorted(rows(df, *columns).elements(), key=lambda r: tuple((v is not None, str(v)) for v in r))


def values(spark, name, *items, kind="string"):
    return spark.createDataFrame([(i,) for i in items], f"{name} {kind}")


def plan_of(df):
    """The physical plan as text, the one that ran when the frame was executed."""
    return df._jdf.queryExecution().executedPlan().toString()
