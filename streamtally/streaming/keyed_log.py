"""The newest row per key, kept as a log of batches beside a ``foreachBatch`` sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class KeyedLog:
    """Each batch appends its rows as a folder named by its id; a repeated batch overwrites its own.

    Every ``fold`` batches the log is folded into one newest row per key, and readers start there, so
    a read covers the keys and at most ``fold`` batches, whatever the age of the stream. Which rows
    are newest says ``newest`` (by default: those of the latest batch). Nothing is deleted here:
    folders before the last fold are for the table's housekeeping.
    """

    def __init__(
        self,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        newest: Sequence[str] = ("batch",),
        fold: int = 64,
    ) -> None:
        self.path, self.schema, self.keys = path, schema, list(keys)
        self.order, self.fold = [F.col(c) for c in newest], fold

    def _batch(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def _folded(self, batch_id: int) -> str:
        return f"{self.path}-folded/before={batch_id}"

    def append(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Stores a batch's rows and returns them as a table."""
        spark = rows.sparkSession
        if batch_id and batch_id % self.fold == 0:
            before = self._newest(self._since(spark, batch_id - 1))
            before.write.mode("overwrite").parquet(self._folded(batch_id))
        rows.select(*self.schema.names).write.mode("overwrite").parquet(self._batch(batch_id))
        return spark.read.schema(self.schema).parquet(self._batch(batch_id))

    def _since(self, spark: SparkSession, batch_id: int) -> DataFrame:
        first = batch_id // self.fold * self.fold
        batches = [self._batch(i) for i in range(first, batch_id + 1)]
        read = spark.read.schema(self.schema).option("basePath", self.path)
        rows = read.parquet(*batches).select(*self.schema.names, "batch")
        if first:
            folded = spark.read.schema(self.schema).parquet(self._folded(first))
            rows = rows.unionByName(folded.select(*self.schema.names, F.lit(first - 1).alias("batch")))
        return rows

    def _newest(self, rows: DataFrame) -> DataFrame:
        rank: Column = F.struct(*self.order)
        values = [c for c in self.schema.names if c not in self.keys]
        return (
            rows.groupBy(*self.keys)
            .agg(F.max_by(F.struct(*values), rank).alias("_row"))
            .select(*self.keys, "_row.*")
            .select(*self.schema.names)
        )

    def read(
        self, spark: SparkSession, batch_id: int, only: DataFrame | None = None
    ) -> DataFrame:
        """The newest row per key after a batch; with ``only``, of the rows that its columns select."""
        rows = self._since(spark, batch_id)
        if only is not None:
            rows = rows.join(only.distinct(), only.columns, "left_semi")
        return self._newest(rows)
