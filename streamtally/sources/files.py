"""File sources, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV with a header, every column as text; the declared columns avoid an inference pass."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def parse_json(rows: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Adds the declared fields of a JSON text column; unreadable text gives nulls."""
    parsed = F.from_json(column, schema, {"mode": "PERMISSIVE"})
    return rows.withColumn("_json", parsed).select(*rows.columns, "_json.*")


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A file stream with a declared schema; the rate limit takes the place of mini-batching."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_table(
    spark: SparkSession,
    folder: str,
    name: str,
    schema: T.StructType,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A Parquet table of a folder as a stream, be it one file or a folder of files.

    The path is written as a pattern because a file stream takes a plain path for a folder.
    """
    return stream_parquet(spark, f"{folder}/{name}[.]parquet", schema, files_per_trigger)
