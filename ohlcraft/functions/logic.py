"""Two-valued comparisons: one with a missing price counts as false."""

from pyspark.sql import Column, functions as F


def holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))
