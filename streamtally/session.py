"""Session and working-folder helpers."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_PARTITIONS = "spark.sql.shuffle.partitions"


def local_session(name: str = "streamtally", cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches; a cluster brings its own session and settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="streamtally-")


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names, else a local one for tests."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(
            f"set {CHECKPOINT_CONF} to a folder all executors share; "
            "sinks, streams and checkpoints are written below it"
        )
    return _local_root()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session with the caller's settings for streams with state, but with no more shuffle partitions
    than ``partitions`` (default: the cores there are). Each of them opens and commits every state store
    in every batch, whatever it holds, and the number stays fixed for the life of a checkpoint."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    most = spark.sparkContext.defaultParallelism if partitions is None else partitions
    own.conf.set(_PARTITIONS, min(int(spark.conf.get(_PARTITIONS)), max(1, most)))
    return own


def stored(rows: DataFrame, label: str = "stored") -> DataFrame:
    """The same rows as a written table: computed once, its lineage cut, and of known size, so that
    the optimizer itself decides whether a join may broadcast it."""
    path = fresh_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
