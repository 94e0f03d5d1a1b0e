"""Vectors of a table, checked and packed into blocks that tasks exchange."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PACKED = "dim int, part int, ids binary, data binary"


def usable(embeddings: DataFrame, zero: bool = True) -> DataFrame:
    """vec_id, v (doubles) and dim of the vectors that take part: not null, not empty, all components finite, and
    not all zero unless ``zero``. Rows without vec_id take no part. Of rows that share a vec_id the least vector
    stands for all, so repeated rows count once. Other columns are ignored."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & good)
    if not zero:
        rows = rows.filter(F.exists(v, lambda x: x != 0))
    return (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
        .withColumn("dim", F.size("v"))
    )


def pack(rows: DataFrame, parts: int) -> DataFrame:
    """One row per dimension and part: ids and vectors as bytes. A part is a hash of vec_id."""

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        data = np.stack(pdf["v"].to_numpy()).astype("<f8")
        ids = pdf["vec_id"].to_numpy(dtype="<i8")
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1].array, "part": pdf["part"].iloc[:1].array, "ids": [ids.tobytes()], "data": [data.tobytes()]})

    part = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(parts)).cast("int")
    return rows.select("vec_id", "v", "dim", part.alias("part")).groupBy("dim", "part").applyInPandas(block, PACKED)


def unpack(ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    number = np.frombuffer(ids, "<i8")
    return number, np.frombuffer(data, "<f8").reshape(len(number), -1)


def best_rows(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int, largest: bool) -> np.ndarray:
    """Indices of each query's ``k`` best rows, ties to the smaller vec_id."""
    order = np.lexsort((vec, -score if largest else score, query))
    q = query[order]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    return order[rank < k]
