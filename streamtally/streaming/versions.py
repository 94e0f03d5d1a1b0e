"""Small tables carried from micro-batch to micro-batch in versioned folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class VersionedTable:
    """State of a ``foreachBatch`` sink: batch N reads version N-1 and writes version N.

    A repeated batch therefore starts from the same version and overwrites its own result, and
    each batch's plan starts at a file scan. Versions older than the previous one are deleted.
    """

    def __init__(self, path: str, schema: T.StructType) -> None:
        self.path, self.schema = path, schema

    def _folder(self, version: int) -> str:
        return f"{self.path}/v={version}"

    def read(self, spark: SparkSession, version: int) -> DataFrame:
        if version < 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self._folder(version))

    def newest(self, spark: SparkSession) -> int:
        """The last version that was written whole, -1 without any."""
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return -1
        names = [s.getPath().getName() for s in files.listStatus(root)]
        done = spark._jvm.org.apache.hadoop.fs.Path
        whole = [n for n in names if files.exists(done(f"{self.path}/{n}/_SUCCESS"))]
        return max((int(n.removeprefix("v=")) for n in whole), default=-1)

    def write(self, rows: DataFrame, version: int) -> DataFrame:
        spark = rows.sparkSession
        rows.select(*self.schema.names).write.mode("overwrite").parquet(self._folder(version))
        self._drop(spark, version - 2)
        return self.read(spark, version)

    def _drop(self, spark: SparkSession, version: int) -> None:
        if version < 0:
            return
        folder = spark._jvm.org.apache.hadoop.fs.Path(self._folder(version))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
