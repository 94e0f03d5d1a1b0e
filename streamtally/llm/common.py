"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY: dict[str, tuple[Callable, str | None]] = {}
# Characters of text that a Python task works on at a time, whatever the size of the Arrow batch.
CHUNK_CHARS = 1 << 22
# Stands for a null doc_id in row keys.
NO_ID = -(2**63)


def register(sql: str | None = None) -> Callable[[Callable], Callable]:
    """Names a query (session, table folder) -> DataFrame and the SQL it must agree with."""

    def add(run: Callable) -> Callable:
        REGISTRY[run.__name__] = (run, sql)
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id and the whole text; a null text counts as empty. Other columns, whatever their names, are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def row_key(docs: DataFrame) -> tuple[Column, Column]:
    """Identity of a document row: its id (null has a value of its own) and a hash of its text.
    Repeated rows are equal in both and are treated alike."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def merged(left: DataFrame, right: DataFrame, on: list[str] | str, how: str = "inner") -> DataFrame:
    """A join by sorting both sides, at every size. For tables that grow with the documents, and for small ones beside
    each other: none of them is gathered in the driver, where every broadcast join makes a table of some megabytes,
    however few its rows, which stays until the driver collects its garbage."""
    return left.join(right.hint("merge"), on, how)


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be no column of ``docs`` (in any case)."""
    taken, found = {c.lower() for c in docs.columns}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        found.append(name)
    return found


def let(body: Callable[[Column], Column], **values: Column) -> Column:
    """``body`` of a struct of values, each computed once for a row however often the body names it."""
    return F.element_at(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body), 1)


def chunks(batch: pd.DataFrame, column: str = "text", size: int = CHUNK_CHARS) -> Iterator[pd.DataFrame]:
    """Row slices of a batch with about ``size`` characters each; one longer text is a slice of its own."""
    if not len(batch):
        return
    lengths = batch[column].str.len().to_numpy(dtype=np.int64)
    part = (np.cumsum(lengths) - lengths) // size
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(batch)], strict=True):
        yield batch.iloc[lo:hi]


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i] + counts[i] - 1 for every i, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing of unsigned integers (splitmix64's finisher)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
