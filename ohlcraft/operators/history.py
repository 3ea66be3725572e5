"""How much history a computation sees."""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ohlcraft.functions import frames

WARMUP = 60


def numbered(bars: DataFrame, warmup: int = WARMUP) -> DataFrame:
    """Adds ``bar_no``, the position of the bar in its stock's history from 1, and
    ``seasoned_on``, the date of bar number ``warmup``."""
    warm = F.max(F.when(F.col("bar_no") == warmup, F.col("chart_date"))).over(
        Window.partitionBy(*frames.HISTORY))
    return (
        bars.withColumn("bar_no", F.row_number().over(frames.in_order()))
        .withColumn("seasoned_on", warm))


def prior_bars(charts: DataFrame, before: Column | dt.date, n: int = WARMUP) -> DataFrame:
    """The newest ``n`` bars of each stock dated before ``before``, newest first."""
    newest_first = Window.partitionBy("stock_id").orderBy(F.desc("chart_date"))
    return (
        charts.where(F.col("chart_date") < before)
        .withColumn("rank", F.row_number().over(newest_first))
        .where(F.col("rank") <= n))


def warmup_bars(
    charts: DataFrame, start: dt.date, end: dt.date, n: int = WARMUP, near_days: int = 200,
    month_column: str | None = None,
) -> DataFrame:
    """Bars up to ``end`` holding at least ``n`` rows before ``start`` where they exist.

    Reads only the last ``near_days`` of history, plus all of it for the stocks that have
    bars in the range but too few rows in those days. ``month_column`` names a partition
    column with the first day of the bar's month, for pruning.
    """
    near_start = start - dt.timedelta(days=near_days)
    near = charts.where(F.col("chart_date").between(near_start, end))
    old = charts.where(F.col("chart_date") < near_start)
    if month_column is not None:
        month = near_start.replace(day=1)
        near, old = near.where(F.col(month_column) >= month), old.where(
            F.col(month_column) <= month)
    short = (
        near.groupBy("stock_id")
        .agg(F.count_if(F.col("chart_date") < start).alias("earlier"),
             F.count_if(F.col("chart_date") >= start).alias("inside"))
        .where((F.col("inside") > 0) & (F.col("earlier") < n))
        .select("stock_id"))
    return near.unionByName(old.join(short, "stock_id", "left_semi"))


def range_slice(numbered_bars: DataFrame, start: dt.date, n: int = WARMUP) -> DataFrame:
    """In-range bars and the ``n`` rows ahead of the first of them, for the stocks that
    have ``n`` rows before ``start`` and a bar in the range."""
    first_no = F.min(F.when(F.col("chart_date") >= start, F.col("bar_no"))).over(
        Window.partitionBy(*frames.HISTORY))
    return (
        numbered_bars.withColumn("first_no", first_no)
        .where((F.col("seasoned_on") < start) & (F.col("bar_no") >= F.col("first_no") - n)))


def in_reach(numbered_bars: DataFrame, start: dt.date, n: int = WARMUP) -> DataFrame:
    """In-range bars and at most ``n`` rows ahead of the first of them."""
    first_no = F.min(F.when(F.col("chart_date") >= start, F.col("bar_no"))).over(
        Window.partitionBy(*frames.HISTORY))
    return (
        numbered_bars.withColumn("first_no", first_no)
        .where(F.col("bar_no") >= F.col("first_no") - n))


def market_bars(
    charts: DataFrame, start: dt.date, end: dt.date, n: int = WARMUP, near_days: int = 200,
    month_column: str | None = None,
) -> DataFrame:
    """What the net advances of the range and of ``n`` sessions before it depend on: all bars of
    those dates, and each stock's bar before them, however old.

    Only stocks without such a bar in the last ``near_days`` are looked up in older months.
    """
    near_start = start - dt.timedelta(days=near_days)
    near = charts.where(F.col("chart_date").between(near_start, end))
    old = charts.where(F.col("chart_date") < near_start)
    if month_column is not None:
        month = near_start.replace(day=1)
        near, old = near.where(F.col(month_column) >= month), old.where(
            F.col(month_column) <= month)

    def session(rows: DataFrame) -> tuple[int, dt.date | None]:
        """How many of the last n sessions before the range the rows hold, and the earliest."""
        return rows.where(F.col("chart_date") < start).select("chart_date").distinct().orderBy(
            F.desc("chart_date")).limit(n).agg(F.count("*"), F.min("chart_date")).first()

    count, first = session(near)
    if count < n:
        count, first = session(charts)
        near, old = charts.where(F.col("chart_date") <= end), charts.limit(0)
    recent = near.where(F.col("chart_date") >= (first or start))
    earlier = near.where(F.col("chart_date") < (first or start))
    without = recent.select("stock_id").distinct().join(
        earlier.select("stock_id").distinct(), "stock_id", "left_anti")
    earlier = earlier.unionByName(old.join(without, "stock_id", "left_semi"))
    return recent.unionByName(prior_bars(earlier, first or start, 1).drop("rank"))


def calendar(added: DataFrame) -> DataFrame:
    """Per stock and month its bars, their first and last date and the last close, from the
    rows that loads have added."""
    return added.groupBy("stock_id", "chart_month").agg(
        F.sum("bars").alias("bars"), F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"), F.max_by("last_close", "last_date").alias("last_close"))


def month_calendar(charts: DataFrame) -> DataFrame:
    """The calendar of some charts, see :func:`calendar`."""
    return charts.groupBy("stock_id", F.trunc("chart_date", "month").alias("chart_month")).agg(
        F.count(F.lit(1)).alias("bars"), F.min("chart_date").alias("first_date"),
        F.max("chart_date").alias("last_date"), F.max_by("chart_close", "chart_date").alias("last_close"))


def reach(months: DataFrame, start: dt.date, end: dt.date, n: int = WARMUP) -> DataFrame:
    """The months (stock_id, chart_month) that hold the range and the last ``n`` bars before it of
    the stocks with charts in it.

    ``months`` is a calendar: a row per stock and month, however many bars there are. Of a
    month that the range begins in, bars before it are not counted.
    """
    first = start.replace(day=1)
    newest_first = Window.partitionBy("stock_id").orderBy(F.desc("chart_month"))
    earlier = F.when(F.col("last_date") < start, F.col("bars")).otherwise(0)
    inside = (F.col("last_date") >= start) & (F.col("first_date") <= end)
    return (
        months.where((F.col("chart_month") <= end))
        .withColumns({
            "_newer": F.coalesce(F.sum(earlier).over(newest_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_inside": F.max(inside).over(Window.partitionBy("stock_id"))})
        .where(F.col("_inside") & ((F.col("chart_month") >= first) | (F.col("_newer") < n)))
        .select("stock_id", "chart_month"))


def previous_closes(months: DataFrame, before: dt.date) -> DataFrame:
    """Each stock's last bar (stock_id, chart_date, chart_close) of the months before a date's."""
    return months.where(F.col("chart_month") < before.replace(day=1)).groupBy("stock_id").agg(
        F.max("last_date").alias("chart_date"), F.max_by("last_close", "last_date").alias("chart_close"))
