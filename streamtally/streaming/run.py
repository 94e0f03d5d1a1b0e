"""Starting, draining and replaying streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql import types as T

from ..session import fresh_folder, state_session
from ..sources.files import stream_parquet

def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything available now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_batches(writer: DataStreamWriter, batches: int, seconds: float = 300) -> StreamingQuery:
    """Process at least ``batches`` batches, then stop, as a restart of the program would. What is
    left is for the next start from the same checkpoint."""
    query = writer.trigger(processingTime="0 seconds").start()
    deadline = time.monotonic() + seconds
    while query.isActive and time.monotonic() < deadline:
        last = query.lastProgress
        if last is not None and last["batchId"] + 1 >= batches:
            break
        time.sleep(0.1)
    query.stop()
    if query.exception() is not None:
        raise query.exception()
    return query


class BatchFolders:
    """Writes each batch to a Parquet folder of its own, which a repeated batch overwrites."""

    def __init__(self, path: str) -> None:
        self.path = path

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")


def console_writer(rows: DataFrame, output_mode: str = "append", rows_shown: int = 20):
    """Print the first rows of each batch."""
    return (
        rows.writeStream.outputMode(output_mode)
        .format("console")
        .option("numRows", rows_shown)
        .option("truncate", False)
    )


def drain_to_files(rows: DataFrame, path: str, checkpoint: str, partitions: list[str] | None = None):
    """Append-mode results to Parquet files, each exactly once."""
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    return drain(writer)


def drain_to_table(rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append to a declared table; the sink adopts its columns and partitioning."""
    query = (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )
    query.awaitTermination()
    return query


def stream_to_folder(
    spark: SparkSession, rows: DataFrame, label: str, partitions: list[str] | None = None
) -> DataFrame:
    """Drain an append-mode stream into a new folder and read the result back."""
    root = fresh_folder(spark, label)
    drain_to_files(rows, f"{root}/out", f"{root}/checkpoint", partitions)
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


def collect_for(
    spark: SparkSession, rows: DataFrame, seconds: float, label: str = "collected"
) -> DataFrame:
    """All results of the rows present, as a table, if they arrive within ``seconds``; else the
    stream is stopped and a ``TimeoutError`` says so."""
    root = fresh_folder(spark, label)
    query = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    if not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"{label}: not all results arrived within {seconds} s")
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


def replay(
    spark: SparkSession,
    phases: Iterable[DataFrame],
    schema: T.StructType,
    run: Callable[[DataFrame], DataStreamWriter],
    landing: str,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Let each phase's rows arrive, then drain; every drain resumes from the checkpoint.

    ``run`` builds the same query each time (with the same checkpoint folder) over the landing
    folder's stream. Returns the finished query of each phase. The stream has a session of its own
    with at most ``state_partitions`` shuffle partitions (:func:`~streamtally.session.state_session`).
    """
    finished = []
    own = state_session(spark, state_partitions)
    for rows in phases:
        rows.write.mode("append").parquet(landing)
        finished.append(drain(run(stream_parquet(own, landing, schema))))
    return finished
