"""Operator 11: which filter of a chain removes a document, in every order of the chain.

The mask matrix holds 0 where a kind of document fails a filter and infinity elsewhere; the position matrix holds, for
every order, the place of each filter (the inverse permutation). Their min-plus product is the step at which each kind
of document goes in each order: the least, over the filters it fails, of the filter's place. With these removal ranks
all counts are weighted scatters over kinds of documents. Kinds are failure masks, 32 for five filters, so Spark first
counts documents by part and mask, and no later step depends on how many there are.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtally.session import stored

from .common import register, table

FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
NEVER = 1 << 30
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)


def removal_ranks(n: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders of n filters, and the step (from 0; NEVER if it stays) at which each mask goes in each order."""
    orders = np.array(list(itertools.permutations(range(n))), np.int64).reshape(-1, n)
    position = np.argsort(orders, axis=1)
    fails = np.arange(1 << n)[:, None] >> np.arange(n) & 1
    mask = np.where(fails == 1, 0, NEVER)
    rank = np.full((1 << n, len(orders)), NEVER)
    for f in range(n):
        rank = np.minimum(rank, mask[:, f, None] + position[None, :, f])
    return orders, rank


def _scatter(n: int, orders: np.ndarray, rank: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of one part, each of shape (orders, steps), from weights of shape (3, masks): all, good, toxic."""
    at = np.arange(len(orders))
    gone = np.zeros((3, len(orders), n + 1), np.int64)
    for mask in range(1, 1 << n):
        gone[:, at, rank[mask]] += weights[:, mask, None]
    gone = gone[:, :, :n]
    removed = gone[0]
    fails = np.arange(1 << n)[:, None] >> np.arange(n) & 1
    failing = weights[0] @ fails
    per_filter = np.zeros(n, np.int64)
    np.add.at(per_filter, orders, removed)
    return {
        "kept": weights[0].sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        # Who fails a step's filter goes there, or went before.
        "redundant": failing[orders] - removed,
        "unique_fails": weights[0][1 << orders],
        "good_lost": gone[1],
        "toxic_lost": gone[2],
        "shapley": per_filter[orders],
    }


def interactions(kinds: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Counts of every order and step for each part of ``kinds`` (part, mask, n, good, toxic), zeros included.

    Bit i of a mask says that filter i fails. Several rows of one part and mask are added up. All orders are listed, so
    the number of filters is for the caller to bound (7 have 5,040 orders). Other columns are ignored."""
    n = len(filters)
    summed = kinds.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    # At most 2^n entries a part.
    parts = summed.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("kinds"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        orders, rank = removal_ranks(n)
        rank = np.minimum(rank, n)
        names = np.array(["".join(filters[f] for f in order) for order in orders], object)
        keys = {"filter_order": np.repeat(names, n), "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))}
        for batch in batches:
            for part, held in zip(batch["part"], batch["kinds"], strict=True):
                weights = np.zeros((3, 1 << n), np.int64)
                for k in held:
                    weights[:, k["mask"]] = k["n"], k["good"], k["toxic"]
                counts = _scatter(n, orders, rank, weights)
                yield pd.DataFrame({"part": part} | keys | {c: counts[c].ravel() for c in _COUNTS})

    return parts.mapInPandas(work, RESULT)


def failures(docs: DataFrame) -> DataFrame:
    """did, part, digest of the text and mask of the filters A to D of every row; nothing of the text."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("did"),
        F.coalesce(F.col("source"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    words = rows.withColumn("words", F.filter(F.split("text", SPACE), lambda w: w != ""))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length("text") - F.length(F.translate("text", string.ascii_uppercase, ""))
    failing = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * F.length("text"), F.col("text").rlike("[#$%&*|]")]
    mask = sum((c.cast("int") * (1 << i) for i, c in enumerate(failing)), F.lit(0))
    return words.select("did", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), mask.alias("mask"))


def document_kinds(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good and toxic of all documents.

    Null texts are empty, null sources the empty string. A row without doc_id is no repeat of a smaller one, makes no
    other row a repeat, and has no label. Rows that share an id and a text are counted each, and none makes another a
    repeat. Of several labels of one id one good (one toxic) label is enough; labels of no document change nothing. Texts
    are compared by their SHA-256. Whole texts of any length are read once; other columns are ignored."""
    rows = stored(failures(docs), "failures")
    # Rows that agree in all that counts become one before anything is joined.
    counted = rows.groupBy("did", "digest", "part", "mask").agg(F.count("*").alias("n"))
    firsts = rows.groupBy("digest").agg(F.min("did").alias("first")).filter("first is not null").withColumnRenamed("digest", "first_digest")
    marks = labels.select(
        F.col("doc_id").cast("long").alias("labelled"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"),
    )
    marks = marks.filter("labelled is not null and (good or toxic)").groupBy("labelled").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    # Rows without id must not meet in one task: they are dealt out by their digest and match nothing.
    dealt = counted.withColumn("at", F.coalesce("did", F.xxhash64("digest")))
    has_id = F.col("did").isNotNull()
    joined = dealt.join(
        firsts, (F.col("at") == F.col("first")) & (F.col("digest") == F.col("first_digest")) & has_id, "left"
    ).join(marks, (F.col("at") == F.col("labelled")) & has_id, "left")
    repeat = (has_id & F.col("first").isNull()).cast("int") * (1 << FILTERS.index("E"))
    marked = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return joined.groupBy("part", (F.col("mask") + repeat).alias("mask")).agg(
        F.sum("n").alias("n"), marked("good").alias("good"), marked("toxic").alias("toxic")
    )


SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM texts),
failing AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
  FROM split),
marks AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
kinds AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failing LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
placed AS (
  SELECT k.*, o.filter_order, s.step, filter_order[s.step] AS f,
    list_min([CASE WHEN contains(fails, x) THEN strpos(filter_order, x) ELSE 6 END FOR x IN ['A', 'B', 'C', 'D', 'E']]) AS gone
  FROM kinds k, orders o, (SELECT unnest(range(1, 6)) AS step) s),
counts AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, any_value(f) AS f,
    CAST(sum(n) FILTER (gone > step) AS BIGINT) AS kept,
    CAST(sum(n) FILTER (gone = step) AS BIGINT) AS removed,
    CAST(sum(n) FILTER (gone < step AND contains(fails, f)) AS BIGINT) AS redundant,
    CAST(sum(n) FILTER (fails = f) AS BIGINT) AS unique_fails,
    CAST(sum(good) FILTER (gone = step) AS BIGINT) AS good_lost,
    CAST(sum(toxic) FILTER (gone = step) AS BIGINT) AS toxic_lost
  FROM placed GROUP BY part, filter_order, step)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
  coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM counts
"""


@register(SQL)
def op11_filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return interactions(document_kinds(table(spark, folder, "documents"), table(spark, folder, "labels")))
