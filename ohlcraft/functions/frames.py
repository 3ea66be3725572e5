"""Row frames over one stock's bars in date order.

Frames count rows, never calendar days, because halted stocks skip dates. A stock has
one bar a day at most, the key of the charts, which bounds what one frame can span.
Every function here uses the same partitioning and order, so a chain of them costs
one shuffle and one sort.
"""

from pyspark.sql import Column, Window, functions as F

HISTORY = ("stock_id",)


def in_order():
    return Window.partitionBy(*HISTORY).orderBy("chart_date")


def rows_back(n: int, skip: int = 0):
    """The ``n`` rows that end ``skip`` rows before the current one."""
    return in_order().rowsBetween(-(n - 1) - skip, -skip)


def back(column: Column | str, k: int) -> Column:
    return F.lag(column, k).over(in_order())


def filled(value: Column, column: Column | str, n: int, skip: int = 0) -> Column:
    """``value``, or null unless all ``n`` rows of the frame have ``column``."""
    return F.when(F.count(column).over(rows_back(n, skip)) == n, value)


def mean(column, n: int, skip: int = 0) -> Column:
    return filled(F.avg(column).over(rows_back(n, skip)), column, n, skip)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
