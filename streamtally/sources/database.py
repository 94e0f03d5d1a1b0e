"""Relational sources over JDBC (optional driver jar)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    driver: str = "org.postgresql.Driver",
    fetch_size: int = 10_000,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Reader options; big tables are read in parallel ranges of a numeric column."""
    options = {"url": url, "dbtable": table, "driver": driver, "fetchsize": str(fetch_size)}
    split = (partition_column, lower, upper, partitions)
    if any(v is not None for v in split):
        if any(v is None for v in split):
            raise ValueError("a partitioned read needs column, lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def snapshot(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
