"""Operator 1: exact top-k inner products by ball-tree branch and bound per shard.

Every shard of the vectors is a ball tree, built once. A ball of centre c and radius r bounds the inner product of
whatever it holds by q.c + |q| r; a node's bound is also at most its parent's. Each query visits the leaves in the
order of their bounds and stops at the first that is below its current kth score. That score is shared: every query
first searches one shard, and takes the kth score found there into all others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamtally.session import stored

from .common import register, table
from .vectors import best_rows, pack, unpack, usable

TOP = 5
QUERY_STEP = 50
SHARD_ROWS = 8192
QUERY_ROWS = 1024
LEAF_ROWS = 128


class BallTree:
    def __init__(self, points: np.ndarray) -> None:
        self.order = np.arange(len(points))
        spans, parents = [(0, len(points))], [-1]
        centres, radii, self.leaves = [], [], []
        node = 0
        while node < len(spans):
            lo, hi = spans[node]
            own = points[self.order[lo:hi]]
            centre = own.mean(axis=0)
            away = np.sqrt(((own - centre) ** 2).sum(axis=1))
            centres.append(centre)
            # A little more than the largest distance, so that rounding never cuts a point off.
            radii.append(away.max() * (1 + 1e-9) + 1e-9)
            if hi - lo <= LEAF_ROWS:
                self.leaves.append(node)
            else:
                # Halves along the line between two far points; equal points are halved all the same.
                a = own[away.argmax()]
                b = own[((own - a) ** 2).sum(axis=1).argmax()]
                half = (hi - lo) // 2
                self.order[lo:hi] = self.order[lo:hi][np.argpartition(own @ (b - a), half)]
                spans += [(lo, lo + half), (lo + half, hi)]
                parents += [node, node]
            node += 1
        self.spans, self.parents = spans, parents
        self.centres, self.radii = np.array(centres), np.array(radii)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Of every query and leaf the largest inner product that the leaf can hold."""
        bound = queries @ self.centres.T + np.sqrt((queries**2).sum(axis=1))[:, None] * self.radii
        for node, parent in enumerate(self.parents):
            if parent >= 0:
                bound[:, node] = np.minimum(bound[:, node], bound[:, parent])
        leaf = bound[:, self.leaves]
        return leaf + 1e-9 * np.abs(leaf) + 1e-6


def top_products(ids: np.ndarray, points: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's ``k`` best points of one shard, as far as they reach ``floor``, the kth score known so far."""
    tree = BallTree(points)
    bound = tree.bounds(queries)
    ranked = np.argsort(-bound, axis=1, kind="stable")
    kth, best = floor.astype(np.float64).copy(), np.full((len(queries), k), -np.inf)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for step in range(len(tree.leaves)):
        leaf = ranked[:, step]
        active = np.flatnonzero(bound[np.arange(len(queries)), leaf] >= kth)
        if not len(active):
            break
        by_leaf = active[np.argsort(leaf[active], kind="stable")]
        for own in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
            lo, hi = tree.spans[tree.leaves[leaf[own[0]]]]
            rows = tree.order[lo:hi]
            score = queries[own] @ points[rows].T
            score[query_ids[own][:, None] == ids[rows][None, :]] = -np.inf
            best[own] = -np.sort(-np.hstack([best[own], score]), axis=1)[:, :k]
            kth[own] = np.maximum(kth[own], best[own, k - 1])
            q, x = np.nonzero((score >= kth[own][:, None]) & np.isfinite(score))
            found.append((own[q], rows[x], score[q, x]))
    if not found:
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
    q, x, score = (np.concatenate(c) for c in zip(*found, strict=True))
    keep = score >= kth[q]
    q, x, score = q[keep], x[keep], score[keep]
    keep = best_rows(q, ids[x], score, k, largest=True)
    return pd.DataFrame({"query_id": query_ids[q[keep]], "vec_id": ids[x[keep]], "score": score[keep].astype(np.int64)})


def _search(blocks: DataFrame, shards: DataFrame, k: int) -> DataFrame:
    """Query blocks (dim, part, ids, data, floors, shard) against the shards they name."""
    asked = blocks.select(F.col("dim").alias("d"), F.col("shard").alias("s"), F.col("part").alias("p")).distinct()
    left = shards.join(asked, (shards["dim"] == F.col("d")) & (shards["part"] == F.col("s"))).select("d", "s", "p", "ids", "data")

    def search(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if shard.empty or block.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
        ids, points = unpack(shard["ids"].iloc[0], shard["data"].iloc[0])
        query_ids, queries = unpack(block["ids"].iloc[0], block["data"].iloc[0])
        floor = np.frombuffer(block["floors"].iloc[0], "<f8")
        return top_products(ids, points, query_ids, queries, floor, k)

    pairs = left.groupBy("d", "s", "p").cogroup(blocks.groupBy("dim", "shard", "part"))
    return pairs.applyInPandas(search, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each query with all vectors but its own.

    Both inputs: vec_id, v, dim, with whole numbers as components; only vectors of one length are compared. Ties go to
    the smaller vec_id. Fewer candidates give fewer rows; an empty side gives none."""
    n_shards = max(1, -(-vectors.count() // shard_rows))
    n_blocks = max(1, -(-queries.count() // query_rows))
    shards = stored(pack(vectors, n_shards), "shards")
    packed = stored(pack(queries, n_blocks), "queries")

    def no_floor(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(floors=[np.full(len(i) // 8, -np.inf).tobytes() for i in pdf["ids"]])

    schema = "dim int, part int, ids binary, data binary, shard int, floors binary"
    home = F.pmod(F.col("part"), F.lit(n_shards)).cast("int")
    first = packed.withColumn("shard", home).mapInPandas(lambda it: map(no_floor, it), schema)
    seeds = stored(_search(first, shards, k), "seeds")
    kth = seeds.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).filter(f"n = {k}")
    floors = queries.join(kth.select(F.col("query_id").alias("vec_id"), "kth"), "vec_id", "left")

    # The kth scores travel as one more component of each query.
    with_floor = floors.select("vec_id", F.concat("v", F.array(F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf"))))).alias("v"), "dim")

    def split_floor(pdf: pd.DataFrame) -> pd.DataFrame:
        both = [unpack(i, d)[1] for i, d in zip(pdf["ids"], pdf["data"], strict=True)]
        return pdf.assign(data=[b[:, :-1].tobytes() for b in both], floors=[b[:, -1].tobytes() for b in both])

    others = F.array_remove(F.sequence(F.lit(0), F.lit(n_shards - 1)), home)
    second = pack(with_floor, n_blocks).withColumn("shard", F.explode(others)).select("dim", "part", "ids", "data", "shard")
    rest = _search(second.mapInPandas(lambda it: map(split_floor, it), schema), shards, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = seeds.union(rest).withColumn("rank", F.row_number().over(order)).filter(f"rank <= {k}")
    return ranked.select("query_id", "rank", "vec_id", "score")


def scaled(embeddings: DataFrame) -> DataFrame:
    """The usable vectors with each component x as floor(256 x)."""
    rows = usable(embeddings)
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * 256).cast("double")))


@register()
def op1_ball_tree_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = stored(scaled(table(spark, folder, "embeddings")), "vectors")
    return top_k(vectors, vectors.filter(F.col("vec_id") % QUERY_STEP == 0))
