"""Relational sink over JDBC (optional driver jar): stage, then upsert in the database."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def upsert_statement(
    table: str,
    staging: str,
    columns: Sequence[str],
    keys: Sequence[str],
    update_fields: Sequence[str] | None = None,
    only_if: str | None = None,
) -> str:
    """SQL that moves a staged batch into ``table``: insert, on conflict update ``update_fields``;
    nothing unless ``only_if`` holds."""
    fields = [c for c in columns if c not in keys] if update_fields is None else update_fields
    names = ", ".join(columns)
    action = (
        "DO UPDATE SET " + ", ".join(f"{f} = EXCLUDED.{f}" for f in fields)
        if fields
        else "DO NOTHING"
    )
    where = "" if only_if is None else f"WHERE {only_if} "
    return (
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} {where}"
        f"ON CONFLICT ({', '.join(keys)}) {action}"
    )


def stage_batch(
    rows: DataFrame, url: str, staging: str, driver: str = "org.postgresql.Driver",
    batch_size: int = 1000, writers: int = 8,
) -> None:
    """Write a batch to its staging table with a bounded number of connections."""
    (
        rows.repartition(writers)
        .write.format("jdbc")
        .mode("overwrite")
        .options(url=url, dbtable=staging, driver=driver, batchsize=str(batch_size), truncate="true")
        .save()
    )


def in_transaction(spark: SparkSession, url: str, driver: str = "org.postgresql.Driver") -> Callable[[Sequence[str]], None]:
    """Runs statements on one connection of the driver program: all of them, or none."""

    def run(statements: Sequence[str]) -> None:
        spark._jvm.java.lang.Class.forName(driver)
        connection = spark._jvm.java.sql.DriverManager.getConnection(url)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            try:
                for text in statements:
                    statement.executeUpdate(text)
                connection.commit()
            except BaseException:
                connection.rollback()
                raise
        finally:
            connection.close()

    return run


class DatabaseSink:
    """``foreachBatch`` sink: stages a batch, then upserts it and records its id in one transaction.

    The executors write the staging table; the database moves it into ``table``. The statements do
    nothing for a batch whose id is recorded already, so a batch that is delivered twice, or whose
    answer was lost, has one effect. A failed attempt is repeated from the staging on, at most
    ``attempts`` times in all, each after a pause twice as long; then the batch fails, and with it the
    stream, to be resumed from its checkpoint.

    ``newest`` names the column whose greatest value says which of several rows of one key counts (a
    database refuses to update a row twice in one statement). The batches table needs the columns
    ``sink`` (its key) and ``batch_id``.
    """

    def __init__(
        self,
        name: str,
        table: str,
        columns: Sequence[str],
        keys: Sequence[str],
        newest: str,
        stage: Callable[[DataFrame, str], None],
        transact: Callable[[Sequence[str]], None],
        update_fields: Sequence[str] | None = None,
        batches: str = "sink_batches",
        attempts: int = 4,
        pause: float = 1.0,
        sleep: Callable[[float], None] = time.sleep,
    ) -> None:
        if "'" in name:
            raise ValueError("a sink's name goes into SQL text: no quotes")
        self.name, self.table, self.columns, self.keys = name, table, list(columns), list(keys)
        self.newest, self.stage, self.transact, self.fields = newest, stage, transact, update_fields
        self.batches, self.attempts, self.pause, self.sleep = batches, attempts, pause, sleep
        self.staging = f"{table}_staging_{name}"

    def statements(self, batch_id: int) -> list[str]:
        """The upsert, unless this batch is in, then the record of the batch."""
        new = f"NOT EXISTS (SELECT 1 FROM {self.batches} WHERE sink = '{self.name}' AND batch_id >= {batch_id})"
        return [
            upsert_statement(self.table, self.staging, self.columns, self.keys, self.fields, new),
            f"INSERT INTO {self.batches} (sink, batch_id) VALUES ('{self.name}', {batch_id}) "
            f"ON CONFLICT (sink) DO UPDATE SET batch_id = GREATEST({self.batches}.batch_id, EXCLUDED.batch_id)",
        ]

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        values = F.struct(*[c for c in self.columns if c not in self.keys])
        # Of equal ``newest`` the greatest values count, so that every attempt stages the same rows.
        once = rows.groupBy(*self.keys).agg(F.max_by(values, F.struct(self.newest, values)).alias("_row"))
        staged = once.select(*self.keys, "_row.*").select(*self.columns)
        for attempt in range(1, self.attempts + 1):
            try:
                self.stage(staged, self.staging)
                self.transact(self.statements(batch_id))
                return
            except Exception:
                if attempt == self.attempts:
                    raise
                self.sleep(self.pause * 2 ** (attempt - 1))

    def writer(self, rows: DataFrame, checkpoint: str, output_mode: str = "update") -> DataStreamWriter:
        return (
            rows.writeStream.outputMode(output_mode)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self)
        )
