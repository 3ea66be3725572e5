"""Readers and selections of daily bars."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ohlcraft import schema
from ohlcraft.functions import scalar


def _int_day(day: dt.date) -> int:
    return day.year * 10_000 + day.month * 100 + day.day


def bars_in_range(raw: DataFrame, symbols: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Raw bars of the given symbols dated from ``start`` to ``end``, both included."""
    return (
        raw.where(F.col("date").between(_int_day(start), _int_day(end)))
        .join(symbols.select("symbol").distinct(), "symbol", "left_semi"))


def read_raw_bars(
    spark: SparkSession, path: str, symbols: DataFrame | None = None,
    start: dt.date | None = None, end: dt.date | None = None, fmt: str = "parquet", **options,
) -> DataFrame:
    """Adjusted daily bars ``(symbol, date, open, high, low, close, volume)`` from files."""
    raw = spark.read.schema(schema.RAW_BARS).format(fmt).options(**options).load(path)
    if start is not None:
        raw = raw.where(F.col("date") >= _int_day(start))
    if end is not None:
        raw = raw.where(F.col("date") <= _int_day(end))
    if symbols is not None:
        raw = raw.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    return raw


def read_raw_bars_jdbc(
    spark: SparkSession, url: str, table: str, start: dt.date, end: dt.date, partitions: int, **options,
) -> DataFrame:
    """Raw bars of a range from a database, read by ``partitions`` tasks with a stretch of dates
    each; the database selects the range."""
    first, last = _int_day(start), _int_day(end)
    rows = (
        spark.read.format("jdbc").options(url=url, dbtable=table, **options)
        .option("partitionColumn", "date").option("lowerBound", first).option("upperBound", last + 1)
        .option("numPartitions", partitions).load())
    return rows.where(F.col("date").between(first, last)).select(
        *(F.col(f.name).cast(f.dataType) for f in schema.RAW_BARS))


def chart_rows(raw: DataFrame) -> DataFrame:
    """Raw bars as typed rows with the turnover, keyed by ticker and date."""
    return raw.select(
        scalar.ticker_of(F.col("symbol")).alias("ticker"),
        scalar.day(F.col("date")).alias("chart_date"),
        *(F.col(x).alias(f"chart_{x}") for x in ("open", "high", "low", "close", "volume")),
        scalar.turnover(F.col("close"), F.col("volume")).alias("chart_turnover"))


def malformed_dates(raw: DataFrame) -> DataFrame:
    """Raw bars whose date :func:`chart_rows` would refuse."""
    return raw.where(scalar.day_or_null(F.col("date")).isNull())


_CHART_COLUMNS = (
    "chart_id", "stock_id", "ticker", "chart_date", "chart_open", "chart_high", "chart_low",
    "chart_close", "chart_volume", "chart_turnover", "chart_change_percentage")


def charts_by_date(
    charts: DataFrame, stocks: DataFrame, start: dt.date, end: dt.date, ordered: bool = True,
) -> DataFrame:
    """Charts of the date range with their ticker, null for an unknown stock."""
    found = (
        charts.where(F.col("chart_date").between(start, end))
        .join(stocks.select("stock_id", "ticker"), "stock_id", "left")
        .select(*_CHART_COLUMNS))
    return found.orderBy("stock_id", "chart_date") if ordered else found


def charts_of_tickers(
    charts: DataFrame, stocks: DataFrame, tickers: DataFrame | str,
    start: dt.date, end: dt.date, ordered: bool = True,
) -> DataFrame:
    """Charts of one ticker, or of a frame of tickers, in the date range."""
    if isinstance(tickers, str):
        wanted = stocks.where(F.col("ticker") == tickers)
    else:
        wanted = stocks.join(tickers.select("ticker").distinct(), "ticker", "left_semi")
    found = (
        charts.where(F.col("chart_date").between(start, end))
        .join(wanted.select("stock_id").distinct(), "stock_id", "left_semi")
        .select("chart_id", "chart_date", "chart_open", "chart_high", "chart_low",
                "chart_close", "chart_volume", "stock_id"))
    return found.orderBy("stock_id", "chart_date") if ordered else found


def had_session(raw: DataFrame, symbol: str, day: dt.date) -> DataFrame:
    """One row ``had_session``: whether the symbol has a bar on the day."""
    return (
        raw.where((F.col("symbol") == symbol) & (F.col("date") == _int_day(day)))
        .agg((F.count("*") > 0).alias("had_session")))


def sessions(charts: DataFrame) -> DataFrame:
    """Per date, how many stocks have a bar, and whether it is the newest date."""
    by_date = charts.groupBy("chart_date").agg(F.count("*").alias("stocks"))
    newest = charts.agg(F.max("chart_date")).scalar()
    return by_date.select("chart_date", "stocks", (F.col("chart_date") == newest).alias("is_newest"))
