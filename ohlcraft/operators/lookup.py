"""Joins to the dimensions.

No side is forced to be broadcast: Spark broadcasts a dimension when its size allows and
otherwise shuffles both sides, splitting skewed partitions.
"""

from pyspark.sql import DataFrame, functions as F

from ohlcraft.functions import scalar

#: Names in an error's message; all are in its frame.
SHOWN = 20


class UnknownKeys(ValueError):
    """Rows refer to names the dimension does not have; ``missing`` is a frame of all of them."""

    def __init__(self, column: str, missing: DataFrame, count: int) -> None:
        some = sorted(str(row[0]) for row in missing.take(SHOWN))
        rest = f" and {count - len(some)} more, see .missing" if count > len(some) else ""
        super().__init__(f"{count} unknown {column}: {some}{rest}")
        self.column = column
        self.missing = missing
        self.count = count


def with_stock_ids(rows: DataFrame, stocks: DataFrame) -> DataFrame:
    """Rows with ``stock_id`` in place of ``ticker``, null where the ticker is unknown."""
    return rows.join(stocks.select("ticker", "stock_id"), "ticker", "left").drop("ticker")


def mapped_and_rejected(rows: DataFrame, stocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of known tickers with their ``stock_id``, and the rows of unknown ones."""
    tickers = stocks.select("ticker", "stock_id")
    return (
        rows.join(tickers, "ticker").drop("ticker"),
        rows.join(tickers, "ticker", "left_anti"))


def missing_keys(rows: DataFrame, dimension: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` that the dimension lacks, a missing value included."""
    return (
        rows.select(column).distinct()
        .join(dimension.select(column), column, "left_anti"))


def require_known(rows: DataFrame, id_column: str, name_column: str) -> None:
    """Raise :class:`UnknownKeys` with the names of rows whose id was not found."""
    unknown = rows.where(F.col(id_column).isNull()).select(name_column).distinct()
    count = unknown.count()
    if count:
        raise UnknownKeys(name_column, unknown, count)


def market_caps_by_stock(
    caps: DataFrame, stocks: DataFrame, order_by: str | None = None,
) -> DataFrame:
    """``(symbol, ticker, stock_id, cap)`` and the order column; ``stock_id`` is null for an
    unknown ticker."""
    return (
        caps.withColumn("ticker", scalar.ticker_of(F.col("symbol")))
        .join(stocks.select("ticker", "stock_id"), "ticker", "left")
        .select("symbol", "ticker", "stock_id", "cap", *([order_by] if order_by else [])))


def stocks_with_sector_ids(listed: DataFrame, sectors: DataFrame) -> DataFrame:
    """``(ticker, stock_name, sector_id)`` and the sector name; the id is null for an unknown
    sector."""
    return (
        listed.join(sectors.select("sector_name", "sector_id"), "sector_name", "left")
        .select("ticker", "stock_name", "sector_id", "sector_name"))


def with_line_ids(
    long: DataFrame, lines: DataFrame, how: str = "inner", *keep: str,
) -> DataFrame:
    """Indicator values by line id, as the table stores them.

    Values without chart, name or number are dropped, and names are trimmed. Values of a
    name that is no line drop out, or have a null id with ``how="left"``.
    """
    value = scalar.number_or_null(F.col("daily_indicator_value"))
    return (
        long.withColumns({
            "daily_indicator_value": value,
            "indicator_line_name": scalar.trimmed(F.col("indicator_line_name"))})
        .dropna(subset=["chart_id", "indicator_line_name", "daily_indicator_value"])
        .join(lines.select("indicator_line_name", "indicator_line_id"),
              "indicator_line_name", how)
        .select(
            F.col("chart_id").cast("long").alias("chart_id"), "indicator_line_id",
            "daily_indicator_value", *keep))
