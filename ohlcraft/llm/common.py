"""What several operators share: tables, staging in the shared folder, words, row numbers."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ohlcraft.plans.tables import shared_folder

#: A word, in Java's and Python's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own in the folder that all nodes share."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def new_name(rows: DataFrame) -> str:
    """A column name that the rows don't have."""
    return next(name for n in range(len(rows.columns) + 1) if (name := f"_own_{n}") not in rows.columns)


def stage(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read from there: later steps do not
    recompute them, whichever executor is lost."""
    path = new_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def rows_a_batch(spark: SparkSession, n: int) -> Iterator[None]:
    """Hands Python tasks at most n rows at once in the jobs run meanwhile: where rows are large,
    Spark's usual number of them would not fit a worker's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def n_words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(
    rows: DataFrame, groups: list[str], order: list[str], number: str, few: bool = False,
) -> DataFrame:
    """Rows with their place in their group, from 0 and without gaps, in the given order.

    No group is gathered in one task: the rows are dealt by ranges of (groups, order, input
    position), so that even equal keys part; each partition numbers its stretch of a group, and
    the stretches before it are added. The ``groups`` columns must hold no nulls. ``few``: the
    number of groups is bounded, and so are the stretches: partitions + groups at most.
    """
    part, place, tie = f"{number}_part", f"{number}_place", f"{number}_tie"
    keys = [*groups, *order, tie]
    dealt = rows.withColumn(tie, F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = stage(
        dealt.drop(tie).withColumns({
            part: F.spark_partition_id(), place: F.monotonically_increasing_id()}), "numbered")
    stretches = dealt.groupBy(part, *groups).agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*groups).orderBy(part).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = stretches.select(part, *groups, (
        F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias(f"{number}_shift"))
    return (
        dealt.join(F.broadcast(starts) if few else starts, [part, *groups])
        .withColumn(number, (F.col(place) + F.col(f"{number}_shift")).cast("long"))
        .drop(part, place, f"{number}_shift"))
