"""Keyed tables on Parquet: upsert and delete by primary key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, GONE = "_bucket", "_gone"


def merge(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_fields: Sequence[str] | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """``target`` after an upsert: rows of known keys take ``update_fields`` (default: all but the
    keys) from ``updates``, unknown keys are added with all fields.

    Of several updates of one key the newest by ``order`` (then by all fields) counts. Keys are
    unique in ``target``."""
    fields = [c for c in target.columns if c not in keys]
    changed = set(fields if update_fields is None else update_fields)
    old = target.select(*keys, F.struct(*fields).alias("_old"))
    newest = F.struct(*order, *[c for c in fields if c not in order])
    new = updates.groupBy(*keys).agg(F.max(newest).alias("_newest"))
    new = new.select(*keys, F.struct(*[F.col(f"_newest.{c}").alias(c) for c in fields]).alias("_new"))
    joined = old.join(new, list(keys), "full_outer")

    def value(name: str) -> Column:
        if name in changed:
            pick = F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(
                F.col(f"_old.{name}")
            )
        else:
            pick = F.when(F.col("_old").isNotNull(), F.col(f"_old.{name}")).otherwise(
                F.col(f"_new.{name}")
            )
        return pick.alias(name)

    return joined.select(*keys, *[value(f) for f in fields]).select(*target.columns)


class KeyedTable:
    """A Parquet table in hash buckets of its key; an upsert rewrites the touched buckets only.

    A rewrite replaces a bucket only if it has rows, so a deleted key stays as a marked row, hidden
    from readers, until its bucket is next rewritten.
    """

    def __init__(
        self, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 16
    ) -> None:
        self.path, self.schema, self.keys, self.buckets = path, schema, list(keys), buckets

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets)).cast("int")
        return rows.withColumn(BUCKET, bucket)

    def _stored(self, spark: SparkSession) -> DataFrame:
        full = T.StructType(
            [
                *self.schema.fields,
                T.StructField(GONE, T.BooleanType()),
                T.StructField(BUCKET, T.IntegerType()),
            ]
        )
        return spark.read.schema(full).parquet(self.path).where(~F.col(GONE)).drop(GONE)

    def create(self, rows: DataFrame) -> None:
        bucketed = self._bucketed(rows.select(*self.schema.names)).withColumn(GONE, F.lit(False))
        bucketed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).drop(BUCKET)

    def upsert(
        self,
        updates: DataFrame,
        update_fields: Sequence[str] | None = None,
        deletes: DataFrame | None = None,
        order: Sequence[str] = (),
    ) -> None:
        """Apply upserts, then remove the keys in ``deletes``. Of several updates of one key the
        newest by ``order`` counts.

        At most ``buckets`` numbers come to the driver, to prune the buckets that stay as they are.
        """
        spark = updates.sparkSession
        new = self._bucketed(updates.select(*self.schema.names))
        keys = [BUCKET, *self.keys]
        touched = new.select(BUCKET)
        if deletes is not None:
            gone = self._bucketed(deletes.select(*self.keys).distinct())
            touched = touched.union(gone.select(BUCKET))
        numbers = [row[0] for row in touched.distinct().collect()]
        if not numbers:
            return
        old = self._stored(spark).where(F.col(BUCKET).isin(numbers))
        merged = merge(old, new, keys, update_fields, order)
        if deletes is None:
            merged = merged.withColumn(GONE, F.lit(False))
        else:
            merged = merged.join(gone.withColumn(GONE, F.lit(True)), keys, "left").withColumn(
                GONE, F.coalesce(GONE, F.lit(False))
            )
        (
            merged.hint("rebalance", BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.path)
        )
