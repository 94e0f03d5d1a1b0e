"""Message-log sinks (Kafka): key and value columns, writer options."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from .text import json_text


def key_value(rows: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The shape a log writer needs: the key field as text, the record as JSON."""
    return rows.select(
        F.col(key).cast("string").alias("key"), json_text(rows, columns).alias("value")
    )


def upsert_messages(changes: DataFrame, key: str = "rnk") -> DataFrame:
    """Board changes as compacted-log messages: a delete is a key with a null value."""
    columns = [c for c in changes.columns if c not in ("op", key)]
    return changes.select(
        F.col(key).cast("string").alias("key"),
        F.when(F.col("op") != "D", json_text(changes, columns)).alias("value"),
    )


def writer_options(servers: str, topic: str) -> dict[str, str]:
    """All replicas confirm and retries do not duplicate within a producer; the sink as a whole
    stays at-least-once."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }


def log_writer(rows: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """A streaming log writer; ``rows`` has ``key`` and ``value``."""
    return (
        rows.writeStream.format("kafka")
        .options(**writer_options(servers, topic))
        .option("checkpointLocation", checkpoint)
    )
