"""Reference tables by name: over JDBC, or from any format Spark reads."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TableSource:
    """Where named tables live. For JDBC give the connection in `options` (url, driver,
    user, password); no host or password is part of this package."""

    fmt: str = "parquet"
    folder: str = ""
    suffix: str = ".parquet"
    options: dict[str, str] = field(default_factory=dict)


def jdbc_options(
    table: str,
    connection: dict[str, str],
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC scan. With `split_on` (a numeric column), `bounds` and `partitions`
    the table is read by that many tasks; without, by one."""
    options = {**connection, "dbtable": table, "fetchsize": str(fetch_size)}
    split = (split_on, bounds, partitions)
    if any(s is not None for s in split):
        if any(s is None for s in split):
            raise ValueError("a split scan needs split_on, bounds and partitions")
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, source: TableSource, name: str, **split) -> DataFrame:
    """Scan the table `name`. Filters and column choices made later reach the scan."""
    if source.fmt == "jdbc":
        return spark.read.format("jdbc").options(**jdbc_options(name, source.options, **split)).load()
    path = f"{source.folder.rstrip('/')}/{name}{source.suffix}"
    return spark.read.format(source.fmt).options(**source.options).load(path)


def area_table(spark: SparkSession, source: TableSource, name: str) -> DataFrame:
    """The device registry: `c_ip, c_area`."""
    return read_table(spark, source, name).select("c_ip", "c_area")


def system_table(spark: SparkSession, source: TableSource, name: str) -> DataFrame:
    """The monitored systems: `id, port`."""
    return read_table(spark, source, name).select("id", "port")


def status_table(spark: SparkSession, source: TableSource, name: str) -> DataFrame:
    """The status list, whole."""
    return read_table(spark, source, name)


def rule_tables(
    spark: SparkSession, source: TableSource, models: str, docs: str
) -> tuple[DataFrame, DataFrame]:
    """Models (`id, mleve`) and their rule documents (`id, modeId, jsonstr`), also registered
    as the SQL views `models` and `rule_documents`."""
    model_table = read_table(spark, source, models).select("id", "mleve")
    doc_table = read_table(spark, source, docs).select("id", "modeId", "jsonstr")
    model_table.createOrReplaceTempView("models")
    doc_table.createOrReplaceTempView("rule_documents")
    return model_table, doc_table
