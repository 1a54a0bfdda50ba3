"""From record text to the flat flow of visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessaudit.functions import day_text, iso_date
from accessaudit.operators.lookup import join_measured
from accessaudit.schemas import PACKET, PACKET_FIELDS, PACKET_OPTIONS, PACKETS
from accessaudit.session import fresh_folder, written


def _identity(df: DataFrame, *besides: str) -> list[str]:
    return [f"`{c}`" for c in df.columns if c not in besides]


# A record holds one packet object or an array of them. An array schema reads both, but
# objects, the usual case, parse about half again as fast with the struct schema. So records
# are read as an object first, and only what is no clean object is read as an array.


def _as_object() -> Column:
    text = F.col("value").cast("string")
    return F.when(~F.ltrim(text).startswith("["), F.from_json(text, PACKET, PACKET_OPTIONS))


def _as_array() -> Column:
    return F.from_json(F.col("value").cast("string"), PACKETS)


def _is_clean(packet: Column) -> Column:
    return packet.isNotNull() & packet["_malformed"].isNull()


def parse_packets(raw: DataFrame) -> DataFrame:
    """Parse `value` (one JSON object, or an array of them) into packet columns.

    Other columns of `raw` identify the record and are kept; `packet_no` numbers the
    packets of one record. Malformed records give no packet, see `corrupt_packets`.
    """
    keep = _identity(raw, "value")
    one = F.col("_one")
    packets = F.when(_is_clean(one), F.array(one)).otherwise(_as_array())
    return (
        raw.select(*keep, "value", _as_object().alias("_one"))
        .select(*keep, F.posexplode(packets).alias("packet_no", "packet"))
        .select(*keep, "packet_no", *[F.col(f"packet.`{f}`") for f in PACKET_FIELDS])
    )


def corrupt_packets(raw: DataFrame) -> DataFrame:
    """Records whose `value` is neither a packet nor an array of packets (dead letters)."""
    clean = F.filter(F.array(_as_object()), _is_clean)  # names the parse once, so it runs once
    return raw.where((F.size(clean) == 0) & _as_array().isNull())


def project_flow(packets: DataFrame) -> DataFrame:
    """The seven flow columns. Mind the names: the packet's `query` (method and path) is
    the flow's `url`, and the packet's `url.query` (query string) is the flow's `query`."""
    return packets.select(
        *_identity(packets, *PACKET_FIELDS),
        F.col("source.ip").alias("ip"),
        F.col("destination.ip").alias("serviceIp"),
        F.col("destination.port").alias("port"),
        F.col("`@timestamp`").alias("requestTime"),
        F.col("query").alias("url"),
        F.col("url.query").alias("query"),
        F.col("http.response.status_code").alias("status_code"),
    )


def column_gate(packets: DataFrame, batch: str | None = None) -> DataFrame:
    """Drop a whole batch unless some packet in it has `query`, some has `http` and some
    has `destination`. `batch` names the column telling batches apart; without it the
    frame is one batch. Off by default in the audit, whose verdicts must not depend on
    how records were batched.
    """
    required = [F.bool_or(F.col(c).isNotNull()) for c in ("query", "http", "destination")]
    complete = F.coalesce(required[0] & required[1] & required[2], F.lit(False))
    if batch is None:
        return packets.where(packets.agg(complete.alias("complete")).scalar())
    passed = packets.groupBy(batch).agg(complete.alias("complete")).where("complete").select(batch)
    # Written once: measuring and joining the batches found must not parse the packets again.
    passed = written(passed, fresh_folder(packets.sparkSession, "column-gate"))
    return join_measured(packets, passed, batch, "left_semi")


def with_request_date(flow: DataFrame) -> DataFrame:
    """Add `request_date`, the date of `requestTime`, NULL when it is not a date."""
    return flow.withColumn("request_date", iso_date("requestTime"))


def with_request_day(flow: DataFrame) -> DataFrame:
    """Add `request_day`, the first ten characters of `requestTime`."""
    return flow.withColumn("request_day", day_text("requestTime"))
