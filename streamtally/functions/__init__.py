"""Column functions: each takes and returns Columns and stays inside the JVM."""

from .numbers import decimal_or_null, guarded_ratio, is_number, price_lenient, price_strict
from .text import escaped_field, hash_salt, surrogate_key
from .times import (
    iso_instant,
    micros_or_epoch,
    millis_time,
    parse_clock_text,
    sql_time_text,
    to_millis_precision,
    utc_text,
)

__all__ = [
    "decimal_or_null",
    "escaped_field",
    "guarded_ratio",
    "hash_salt",
    "is_number",
    "iso_instant",
    "micros_or_epoch",
    "millis_time",
    "parse_clock_text",
    "price_lenient",
    "price_strict",
    "sql_time_text",
    "surrogate_key",
    "to_millis_precision",
    "utc_text",
]
