"""Operator 6: sharding by extendible hashing.

A row's hash is 32 bits of a hash of its doc_id and, behind them, 31 bits of a hash of id and text, which only matter
where one id holds more than a shard. The directory starts with one bucket; a bucket over the byte limit, and no
other, is split on its next bit, until every bucket fits or holds one row (or equal rows only, which no bit parts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import register, table

BYTE_LIMIT = 1 << 20
BITS = 63
# Bits looked at in one pass over the rows that are still in oversized buckets.
STEP = 9


def hash_of(docs: DataFrame) -> Column:
    """63 bits: first those of the id, then those of id and text."""
    did = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = F.coalesce(F.col("text"), F.lit(""))
    head = F.conv(F.substring(F.md5(did), 1, 8), 16, 10).cast("long")
    tail = F.conv(F.substring(F.md5(F.concat(did, F.lit(":"), text)), 1, 8), 16, 10).cast("long")
    return F.shiftleft(head, 31).bitwiseOR(F.shiftright(tail, 1))


def shards(docs: DataFrame, byte_limit: int = BYTE_LIMIT, step: int = STEP) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, hash, n_bytes) and directory (depth, prefix, shard_bytes, shard_rows): a row belongs to the
    one entry whose prefix its hash begins with.

    Null ids and texts have a hash of their own and no bytes; repeated rows share a hash and stay together, so a
    shard of equal rows can exceed the limit, as can one of a single row. An empty table has an empty directory."""
    from streamtally.session import stored

    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), hash_of(docs).alias("hash"), size.alias("n_bytes")), "hashes")
    directory, depth = None, 0
    open_rows = rows
    while True:
        low, high = depth, min(depth + step, BITS)
        # Bytes of every prefix of the deepest level of this pass, then of all levels above it.
        finest = open_rows.groupBy(F.expr(f"shiftright(hash, {BITS - high})").alias("leaf")).agg(
            F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n"), F.min("hash").alias("lo"), F.max("hash").alias("hi")
        )
        levels = F.explode(F.sequence(F.lit(low), F.lit(high)))
        per_level = finest.select("*", levels.alias("depth")).groupBy(
            "depth", F.expr(f"shiftright(leaf, {high} - depth)").alias("prefix")
        ).agg(F.sum("n_bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        per_level = stored(per_level.withColumn("fits", (F.col("shard_bytes") <= byte_limit) | (F.col("lo") == F.col("hi"))), "levels")
        good = per_level.filter("fits").drop("fits", "lo", "hi")
        # An entry is final if the bucket it came from was too large.
        parents = per_level.filter("not fits").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        final = good.withColumn("parent", F.shiftright("prefix", 1)).join(parents, ["depth", "parent"], "left_semi").drop("parent")
        if depth == 0:
            final = final.unionByName(good.filter("depth = 0"))
        # What no fitting level holds is looked at again, deeper.
        over = stored(per_level.filter(f"depth = {high} and not fits").select(F.col("prefix").alias("_over")), "over")
        directory = final if directory is None else directory.unionByName(final)
        if high == BITS or over.isEmpty():
            return rows, stored(directory, "directory")
        open_rows = stored(
            open_rows.join(over, F.expr(f"shiftright(hash, {BITS - high})") == F.col("_over"), "left_semi"), "open"
        )
        depth = high


def assign(docs: DataFrame, byte_limit: int = BYTE_LIMIT) -> DataFrame:
    """doc_id, n_bytes, shard (its bits; empty for the only one), depth, shard_bytes and shard_rows of every row."""
    rows, directory = shards(docs, byte_limit)
    depths = [r.depth for r in directory.select("depth").distinct().orderBy("depth").collect()]
    # Of the at most 64 depths a row's prefix exists at exactly one.
    tried = rows.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths]).cast("array<int>")))
    keyed = tried.withColumn("prefix", F.expr(f"shiftright(hash, {BITS} - depth)"))
    found = keyed.join(directory, ["depth", "prefix"])
    bits = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(conv(prefix, 10, 2), depth, '0')"))
    return found.select("doc_id", "n_bytes", bits.alias("shard"), F.col("depth").cast("long").alias("depth"), "shard_bytes", "shard_rows")


SQL = f"""
WITH hashed AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
    (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8))::BIGINT << 31)
    | (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')), 1, 8))::BIGINT >> 1) AS h
  FROM documents),
buckets AS (
  SELECT d AS depth, h >> ({BITS} - d) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_rows,
    min(h) = max(h) AS alone
  FROM hashed, (SELECT unnest(range(0, 33)) AS d) GROUP BY ALL),
fits AS (
  SELECT doc_id, n_bytes, h, b.*, row_number() OVER (PARTITION BY doc_id ORDER BY b.depth) AS k
  FROM hashed JOIN buckets b ON h >> ({BITS} - b.depth) = b.prefix
  WHERE shard_bytes <= {BYTE_LIMIT} OR alone)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), CAST(depth AS INTEGER), '0') END AS shard,
  depth, shard_bytes, shard_rows
FROM fits WHERE k = 1
"""


@register(SQL)
def op6_extendible_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return assign(table(spark, folder, "documents"))
