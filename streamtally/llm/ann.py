"""Operator 3: approximate nearest neighbours over balanced posting lists.

A bounded sample is halved again and again along its widest line; the halves' means are the centroids, so that all
lists are of like size. Every vector goes to the list of its nearest centroid, and boundary vectors also to others
that are nearly as near. A query finds centroids by walking a small graph of them that every task holds in memory,
and searches every list whose centroid is within a ratio of the nearest one's distance, however many these are. A list longer than a part is
cut into parts by a hash, so that no list has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamtally.session import stored

from .common import register, table
from .vectors import best_rows, usable

TOP = 10
QUERY_STEP = 100
# Vectors that the centroids are fitted on, rows aimed at in a list, and most centroids (all bounded, all parameters).
SAMPLE_ROWS = 20_000
LIST_ROWS = 400
MOST_CENTROIDS = 2_048
# A vector is also kept in lists up to this much farther than its nearest, in so many lists at most.
REPLICA_RATIO = 1.08
REPLICAS = 4
# A query searches lists up to this much farther than its nearest centroid.
SEARCH_RATIO = 1.15
DEGREE = 24
PART_ROWS = 4_096


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def fit_centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Means of equally large parts of the sample."""
    parts = [sample]
    while len(parts) < lists:
        parts.sort(key=len)
        largest = parts.pop()
        if len(largest) < 2:
            parts.append(largest)
            break
        centre = largest.mean(axis=0)
        a = largest[((largest - centre) ** 2).sum(axis=1).argmax()]
        b = largest[((largest - a) ** 2).sum(axis=1).argmax()]
        half = len(largest) // 2
        order = np.argpartition(largest @ (b - a), half)
        parts += [largest[order[:half]], largest[order[half:]]]
    centres = np.unique(np.stack([p.mean(axis=0) for p in parts]), axis=0)
    return centres


class Graph:
    """Centroids linked to their nearest ones, in cells around some that lie far apart, where every walk starts."""

    def __init__(self, centres: np.ndarray) -> None:
        n = len(centres)
        self.centres = centres
        apart = _distances(centres, centres)
        self.links = np.argsort(apart, axis=1, kind="stable")[:, 1 : DEGREE + 1]
        # Entries: each the centroid farthest from those before it. Every centroid is in its nearest entry's cell.
        entries, out = [0], apart[0].copy()
        while len(entries) < min(n, int(np.ceil(np.sqrt(n)))):
            entries.append(int(out.argmax()))
            out = np.minimum(out, apart[entries[-1]])
        self.entries = np.unique(entries)
        self.cell = apart[:, self.entries].argmin(axis=1)
        self.out = apart[np.arange(n), self.entries[self.cell]]

    def walk(self, query: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """All centroids up to ``ratio`` times as far as the nearest one, nearest first, and their distances.

        Whatever is within the ratio of the nearest so far is expanded. Then those that the walk did not meet are
        measured, unless their entry's distance alone (triangle inequality) puts them beyond the ratio."""
        far = np.full(len(self.centres), np.inf)
        open_ = np.zeros(len(self.centres), bool)

        def meet(at: np.ndarray) -> None:
            far[at] = np.sqrt(((self.centres[at] - query) ** 2).sum(axis=1))
            open_[at] = True

        meet(self.entries)
        entry = far[self.entries]
        while len(at := np.flatnonzero(open_ & (far <= ratio * far.min() + 1e-12))):
            open_[at] = False
            fresh = np.unique(self.links[at])
            meet(fresh[np.isinf(far[fresh])])
        # 1e-6: the distances between centroids come from products.
        limit = ratio * far.min() + 1e-6 * (1 + entry.max())
        meet(np.flatnonzero(np.isinf(far) & (entry[self.cell] - self.out <= limit)))
        ids = np.flatnonzero(far <= ratio * far.min() + 1e-12)
        ids = ids[np.argsort(far[ids], kind="stable")]
        return ids, far[ids]


def build_index(vectors: DataFrame, dim: int, list_rows: int, most: int, sample_rows: int, replicas: int, ratio: float) -> tuple[DataFrame, Graph | None]:
    """Rows (list, part, vec_id, v) of all vectors of one length, and the centroids' graph."""
    rows = vectors.filter(F.col("dim") == dim)
    total = rows.count()
    slots = max(1, -(-total // sample_rows))
    sample = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(slots)) == 0).select("v").toPandas()["v"]
    if not len(sample):
        sample = rows.select("v").limit(1).toPandas()["v"]
    lists = int(min(most, max(1, total // list_rows), max(1, len(sample) // 4)))
    graph = Graph(fit_centroids(np.stack(sample.to_numpy()), lists))
    shared = vectors.sparkSession.sparkContext.broadcast(graph.centres)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres = shared.value
        for batch in batches:
            if batch.empty:
                continue
            far = _distances(np.stack(batch["v"].to_numpy()), centres)
            some = min(replicas, len(centres))
            near = np.argpartition(far, some - 1, axis=1)[:, :some]
            d = np.take_along_axis(far, near, 1)
            row, column = np.nonzero(d <= ratio * d.min(axis=1, keepdims=True) + 1e-12)
            yield pd.DataFrame({"list": near[row, column].astype(np.int32), "vec_id": batch["vec_id"].to_numpy()[row], "v": batch["v"].to_numpy()[row]})

    return rows.select("vec_id", "v").mapInPandas(deal, "list int, vec_id long, v array<double>"), graph


def _nearest(ids: np.ndarray, points: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's ``k`` nearest points; chosen by products, measured by differences."""
    square = (queries**2).sum(axis=1)[:, None] + (points**2).sum(axis=1)[None, :] - 2 * (queries @ points.T)
    square[query_ids[:, None] == ids[None, :]] = np.inf
    kth = np.partition(square, k - 1, axis=1)[:, k - 1] if square.shape[1] > k else np.full(len(queries), np.inf)
    scale = 1e-9 * (1 + (queries**2).sum(axis=1) + np.where(np.isfinite(kth), np.abs(kth), 0))
    q, x = np.nonzero((square <= (kth + scale)[:, None]) & np.isfinite(square))
    score = np.sqrt(((queries[q] - points[x]) ** 2).sum(axis=1))
    keep = best_rows(q, ids[x], score, k, largest=False)
    return pd.DataFrame({"query_id": query_ids[q[keep]], "vec_id": ids[x[keep]], "score": score[keep]})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = TOP, search_ratio: float = SEARCH_RATIO, list_rows: int = LIST_ROWS,
            most: int = MOST_CENTROIDS, sample_rows: int = SAMPLE_ROWS, replicas: int = REPLICAS, replica_ratio: float = REPLICA_RATIO,
            part_rows: int = PART_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest vectors found for each query, its own left out.

    Both inputs: vec_id, v, dim, as ``usable`` gives them (no nulls, no repeated ids; zero vectors as the caller
    decides); only vectors of one length are compared. Ties go to the smaller vec_id. A table too small for two lists
    is one list, so fewer candidates than k are all found. An empty table gives no rows."""
    spark = vectors.sparkSession
    found = None
    for dim in [r.dim for r in vectors.select("dim").distinct().orderBy("dim").collect()]:
        dealt, graph = build_index(vectors, dim, list_rows, most, sample_rows, replicas, replica_ratio)
        dealt = stored(dealt, "postings")
        shared = spark.sparkContext.broadcast(graph)

        def ask(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            graph = shared.value
            for batch in batches:
                lists = [graph.walk(np.asarray(v), search_ratio)[0].astype(np.int32) for v in batch["v"]]
                yield pd.DataFrame({"query_id": batch["vec_id"].array, "q": batch["v"].array, "list": lists})

        asked = queries.filter(F.col("dim") == dim).select("vec_id", "v").mapInPandas(ask, "query_id long, q array<double>, list array<int>")
        asked = stored(asked.select("query_id", "q", F.explode("list").alias("list")), "asked")
        # Parts of a list and blocks of its queries, each of bounded size, meet once.
        parts = dealt.groupBy("list").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
        blocks = asked.groupBy("list").agg(F.ceil(F.count("*") / 1024).cast("int").alias("blocks"))
        grid = stored(parts.join(blocks, "list"), "grid")
        left = dealt.join(grid, "list").select(
            "list", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.col("parts")).cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "v")
        right = asked.join(grid, "list").select(
            F.col("list").alias("l"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"),
            F.pmod(F.xxhash64("query_id", F.lit(2)), F.col("blocks")).cast("int").alias("b"), "query_id", "q")

        def search(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
            if rows.empty or asks.empty:
                return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
            return _nearest(rows["vec_id"].to_numpy(), np.stack(rows["v"].to_numpy()), asks["query_id"].to_numpy(), np.stack(asks["q"].to_numpy()), k)

        part = left.groupBy("list", "part", "block").cogroup(right.groupBy("l", "p", "b")).applyInPandas(search, "query_id long, vec_id long, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # A vector kept in several lists is found several times, always at the same distance.
    single = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return single.withColumn("rank", F.row_number().over(order)).filter(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")


@register()
def op3_posting_lists(spark: SparkSession, folder: str) -> DataFrame:
    vectors = stored(usable(table(spark, folder, "embeddings"), zero=False), "vectors")
    return nearest(vectors, vectors.filter(F.col("vec_id") % QUERY_STEP == 0))
