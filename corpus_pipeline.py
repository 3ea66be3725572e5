"""From raw documents to packed sequences: quality rules, near-duplicates, mixing, packing.

Each stage reads what the one before it has written as Parquet in the shared folder, so that
no stage is recomputed if an executor is lost.
"""

from pyspark.sql import DataFrame, SparkSession

from ohlcraft.llm import dedup, mixing, packing, quality
from ohlcraft.llm.common import stage, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality rules reject."""
    return quality.kept_documents(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return dedup.kept_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that the sources meet their targets."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 1024."""
    return packing.pack_documents(docs)


STAGES = [("quality", good), ("near_duplicates", distinct), ("mixing", mixed), ("packing", packed)]

#: SQL has neither the token ids nor the signatures; tests/llm holds the stages against loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
