"""Small column expressions; all of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def after_last_equals(c: Column | str) -> Column:
    """Text after the last `=`; the whole text when there is none, NULL for NULL."""
    return F.substring_index(_col(c), "=", -1)


def iso_date(c: Column | str) -> Column:
    """ISO timestamp text to date; NULL when it is not one (also under ANSI)."""
    return _col(c).try_cast("date")


def iso_timestamp(c: Column | str) -> Column:
    """ISO timestamp text to an instant for event-time work; NULL when it is not one."""
    return F.try_to_timestamp(_col(c))


def day_text(c: Column | str) -> Column:
    """The `yyyy-MM-dd` part of an ISO timestamp text."""
    return F.substring(_col(c), 1, 10)


def canonical_port(c: Column | str) -> Column:
    """`"080"` to `"80"`: ports in the system table compare as numbers; other text stays."""
    return F.coalesce(_col(c).try_cast("bigint").cast("string"), _col(c))


def map_key(ip: Column | str) -> Column:
    """Key of the ip-to-user map."""
    return F.concat(F.lit("ip_"), _col(ip))


def null_as_word(c: Column | str) -> Column:
    """NULL written as the text `null`."""
    return F.coalesce(_col(c), F.lit("null"))


def clock_ms(now: int | Column | None = None) -> Column:
    """Epoch milliseconds: the given clock, or the query's own start time."""
    if now is None:
        return F.unix_millis(F.current_timestamp())
    return (F.lit(now) if isinstance(now, int) else now).cast("bigint")
