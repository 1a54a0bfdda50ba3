"""Column expressions used by the operators."""

from accessaudit.functions.fields import (
    after_last_equals,
    canonical_port,
    clock_ms,
    day_text,
    iso_date,
    iso_timestamp,
    map_key,
    null_as_word,
)

__all__ = [
    "after_last_equals",
    "canonical_port",
    "clock_ms",
    "day_text",
    "iso_date",
    "iso_timestamp",
    "map_key",
    "null_as_word",
]
