"""Time parsing and formatting; texts with a ``Z`` are UTC whatever the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


WEEKDAY = "^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun) ([^\\n]*)$"


def millis_time(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def to_millis_precision(time: Column) -> Column:
    """Cut a timestamp to the millisecond precision the streams carry."""
    return F.timestamp_millis(F.unix_millis(time.cast("timestamp")))


def micros_or_epoch(micros: Column) -> Column:
    """Epoch microseconds to a timestamp; a missing value is the epoch itself."""
    return F.timestamp_micros(F.coalesce(micros.cast("bigint"), F.lit(0)))


def _utc_wall(time: Column) -> Column:
    """``2024-01-01T00:00:05`` of the instant in UTC, by arithmetic from the epoch."""
    seconds = F.floor(F.unix_micros(time) / F.lit(1_000_000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    wall = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.replace(wall.cast("string"), F.lit(" "), F.lit("T"))


def utc_text(time: Column) -> Column:
    """Whole-second window text, for example ``2024-01-01T00:00:05Z``."""
    return F.concat(_utc_wall(time.cast("timestamp")), F.lit("Z"))


def _micros_of_second(time: Column) -> Column:
    return F.pmod(F.unix_micros(time), F.lit(1_000_000))


def iso_instant(time: Column) -> Column:
    """ISO-8601 with as many fraction digits as needed: none, three or six."""
    micros = _micros_of_second(time)
    return (
        F.when(micros == 0, utc_text(time))
        .when(
            micros % 1000 == 0,
            F.concat(_utc_wall(time), F.format_string(".%03dZ", (micros / 1000).cast("int"))),
        )
        .otherwise(F.concat(_utc_wall(time), F.format_string(".%06dZ", micros.cast("int"))))
    )


def sql_time_text(time: Column) -> Column:
    """JDBC escape text: fraction without trailing zeros, but at least one digit."""
    text = time.cast("string")
    return F.when(_micros_of_second(time) == 0, F.concat(text, F.lit(".0"))).otherwise(text)


def parse_clock_text(text: Column) -> Column:
    """``Mon Jan 01 00:00:07 UTC 2024`` to a timestamp, null where the text does not match.

    Spark formats weekday names but does not parse them, so the redundant weekday is cut off; a text
    that does not begin with one does not match.
    """
    rest = F.regexp_extract(text, WEEKDAY, 1)
    return F.when(text.rlike(WEEKDAY), F.try_to_timestamp(rest, F.lit("MMM dd HH:mm:ss zzz yyyy")))
