"""From raw documents to encoded training text: five stages, each written as Parquet and read again by the next.

Every stage works on all rows its predecessor kept and, but for the last, returns the columns of ``documents``.
Run on a cluster, the stages' tables lie below spark.checkpoint.dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamtally.llm import bpe, jaccard, line_dedup, mixing, toxicity
from streamtally.llm.common import table
from streamtally.session import stored


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that operator 5 rejects."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later repeats of passages (operator 10); documents of which nothing is left go."""
    return line_dedup.drop_repeats(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (operator 7)."""
    return jaccard.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights ask for them (operator 9)."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of each document's ids and of their decoded text (operator 8)."""
    return bpe.digest_documents(docs, bpe.tokenizer_path())


STAGES = [
    ("toxicity", toxic),
    ("line dedup", repeated_lines),
    ("near duplicates", near_copies),
    ("mixing", mixed),
    ("encoding", encoded),
]

# A trained model, hashes of lines and merges of letters are beyond SQL: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
