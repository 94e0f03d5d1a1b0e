"""Partitioned Parquet tables."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A partition written as days(column) is derived: the UTC day of a time column.
_DAYS = re.compile(r"days\((\w+)\)")
_DAY_MICROS = 86_400_000_000


def _spread(rows: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of one table partition together, but a big one split over several writers.

    A plain repartition on the partition columns would give a hot day to one task; the rebalance
    hint lets adaptive execution cut partitions at the advisory size instead.
    """
    return rows.hint("rebalance", *partitions) if partitions else rows


def day_column(time: str) -> str:
    return f"{time}_day"


def day_of(time: Column) -> Column:
    """The UTC day of a time, whatever the session's zone."""
    micros = F.unix_micros(time)
    return F.date_from_unix_date(((micros - F.pmod(micros, F.lit(_DAY_MICROS))) / _DAY_MICROS).cast("int"))


def _derived(rows: DataFrame, partitions: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The rows with the columns of derived partitions, and the names of all partition columns."""
    names = []
    for partition in partitions:
        match = _DAYS.fullmatch(partition)
        if match:
            rows = rows.withColumn(day_column(match[1]), day_of(F.col(match[1])))
        names.append(day_column(match[1]) if match else partition)
    return rows, names


def between(rows: DataFrame, time: str, low: dt.datetime | str, high: dt.datetime | str) -> DataFrame:
    """Rows of a table partitioned by ``days(time)`` with ``low <= time < high``. The condition is
    also put on the day, so the scan lists and opens only the days of that range. The day column is
    left out."""
    first, end = (F.lit(t).cast("timestamp") for t in (low, high))
    at, day = F.col(time), F.col(day_column(time))
    inside = (at >= first) & (at < end) & (day >= day_of(first)) & (day <= day_of(end))
    return rows.where(inside).drop(day_column(time))


def append(
    rows: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    records_per_file: int | None = None,
) -> None:
    rows, partitions = _derived(rows, partitions)
    writer = _spread(rows, partitions).write.mode("append").partitionBy(*partitions)
    if records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.parquet(path)


def overwrite_table(rows: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """Replace the whole table, also partitions the new rows do not touch."""
    rows, partitions = _derived(rows, partitions)
    (
        _spread(rows, partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partitions)
        .parquet(path)
    )


def overwrite_partitions(rows: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replace only the partitions the new rows touch."""
    rows, partitions = _derived(rows, partitions)
    (
        _spread(rows, partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partitions: Sequence[str] = (),
    location: str | None = None,
    properties: Mapping[str, str] | None = None,
    provider: str = "parquet",
) -> None:
    """Declare a table unless it exists. Required columns are declared NOT NULL; Parquet itself does
    not enforce that (see ``require_not_null``). A partition ``days(time)`` declares a date column
    that the writers here derive; read with :func:`between`, it prunes."""

    def text(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    days = [m[1] for m in map(_DAYS.fullmatch, partitions) if m]
    columns += "".join(f", `{day_column(time)}` date" for time in days)
    partitions = [day_column(m[1]) if (m := _DAYS.fullmatch(p)) else p for p in partitions]
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}"
    if partitions:
        statement += f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})"
    if location is not None:
        statement += f" LOCATION {text(location)}"
    if properties:
        pairs = ", ".join(f"{text(k)} = {text(v)}" for k, v in properties.items())
        statement += f" TBLPROPERTIES ({pairs})"
    spark.sql(statement)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
