"""Message-log sources (Kafka): start positions, partitions, Avro values.

The connector and Avro jars are optional; without them the readers here raise a clear error, and
the batch functions still work on a log that was landed as a table with the connector's columns
(``partition``, ``offset``, ``key``, ``value``, ``timestamp``).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EARLIEST, LATEST = "earliest", "latest"
# Fixed sentinels of the connector's JSON offsets.
OFFSET_SENTINELS = {EARLIEST: -2, LATEST: -1}
# A registry-framed Avro value starts with one marker byte and a four-byte schema id.
FRAME_BYTES = 5


def reader_options(
    servers: str,
    topics: Sequence[str] | None = None,
    partitions: Mapping[str, Sequence[int]] | None = None,
    start: str | Mapping[str, Mapping[int, int | str]] = EARLIEST,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the log reader: subscribe to topics or take explicit partitions.

    ``start`` is a position for everything, or per topic and partition an offset or a position.
    After the first run the stream's checkpoint holds the committed offsets.
    """
    if (topics is None) == (partitions is None):
        raise ValueError("give either topics or partitions")
    options = {"kafka.bootstrap.servers": servers}
    if topics is not None:
        options["subscribe"] = ",".join(topics)
    else:
        options["assign"] = json.dumps({t: list(p) for t, p in partitions.items()})
    if isinstance(start, str):
        options["startingOffsets"] = start
    else:
        options["startingOffsets"] = json.dumps(
            {
                topic: {str(p): OFFSET_SENTINELS.get(o, o) for p, o in offsets.items()}
                for topic, offsets in start.items()
            }
        )
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def stream_log(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The raw log as a stream; needs the Kafka connector on the class path."""
    try:
        return spark.readStream.format("kafka").options(**options).load()
    except AnalysisException as error:
        raise RuntimeError(
            "the Kafka connector (spark-sql-kafka-0-10) is not on the class path"
        ) from error


def avro_value(value: Column, schema_json: str, framed: bool = True) -> Column:
    """An Avro value as a struct; ``framed`` strips the registry header first."""
    from pyspark.sql.avro.functions import from_avro

    body = F.substring(value, FRAME_BYTES + 1, 2_147_483_647) if framed else value
    return from_avro(body, schema_json, {"mode": "FAILFAST"})


def decoded(log: DataFrame, schema_json: str, framed: bool = True) -> DataFrame:
    """The records of an Avro log, with the log's own time for records that carry none."""
    record = avro_value(F.col("value"), schema_json, framed)
    return log.select(record.alias("_record"), F.col("timestamp").alias("log_time")).select(
        "_record.*", "log_time"
    )


def from_partitions(log: DataFrame, partitions: Sequence[int]) -> DataFrame:
    """Explicitly assigned partitions only."""
    return log.where(F.col("partition").isin([int(p) for p in partitions]))


def from_committed(log: DataFrame, committed: DataFrame, fallback: str = EARLIEST) -> DataFrame:
    """Records from the committed offset of their partition on.

    ``committed`` has one row (``partition``, ``next_offset``) per partition that has committed;
    other partitions start at the ``fallback`` end of the log.
    """
    positions = committed.select("partition", "next_offset")
    joined = log.join(positions, "partition", "left")
    begins = F.col("offset") >= F.col("next_offset")
    if fallback == EARLIEST:
        keep = F.col("next_offset").isNull() | begins
    else:
        keep = begins
    return joined.where(keep).drop("next_offset")
