"""Symbol sets and the snapshots keyed by symbol."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ohlcraft import schema
from ohlcraft.functions import scalar


def symbols_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """Symbols of a header-less one-column CSV."""
    return spark.read.schema(schema.SYMBOLS).option("header", False).csv(path)


def symbols_from_stocks(stocks: DataFrame) -> DataFrame:
    return stocks.select(scalar.symbol_of(F.col("ticker")).alias("symbol"))


def symbols_from_list(spark: SparkSession, symbols: list[str]) -> DataFrame:
    return spark.createDataFrame([(s,) for s in symbols], schema.SYMBOLS)


def listed_stocks(symbols: DataFrame, listing: DataFrame) -> DataFrame:
    """Ticker, stock name and bare sector name of each symbol in the listing snapshot."""
    return (
        symbols.join(listing, "symbol", "left")
        .select(
            "symbol",
            scalar.ticker_of(F.col("symbol")).alias("ticker"),
            "stock_name",
            scalar.sector_label(F.col("sector_name")).alias("sector_name")))


def listed_sectors(symbols: DataFrame, listing: DataFrame) -> DataFrame:
    """Distinct bare sector names of the symbols."""
    return listed_stocks(symbols, listing).select("sector_name").distinct()


def market_caps(symbols: DataFrame, snapshot: DataFrame, order_by: str | None = None) -> DataFrame:
    """Market cap per symbol. Of several rows the one last in ``order_by`` counts; without
    an order the rows of a symbol must agree, so the largest is as good as any."""
    cap = F.max_by("cap", order_by) if order_by else F.max("cap")
    return (
        snapshot.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
        .groupBy("symbol").agg(cap.alias("cap")))
