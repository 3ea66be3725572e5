"""Column functions for symbols, dates and text values."""

from pyspark.sql import Column, functions as F

# fixed values: the prefix of symbols, and the market prefix of sector names
SYMBOL_PREFIX = "A"
SECTOR_PREFIX = "코스닥 "


def ticker_of(symbol: Column) -> Column:
    """Ticker of a symbol: every leading ``A`` is removed, so ``AA1`` gives ``1``."""
    return F.ltrim(symbol, F.lit(SYMBOL_PREFIX))


def symbol_of(ticker: Column) -> Column:
    return F.concat(F.lit(SYMBOL_PREFIX), ticker)


def day(yyyymmdd: Column) -> Column:
    """Date of an integer like 20240131; a malformed one raises."""
    return F.to_date(yyyymmdd.cast("string"), "yyyyMMdd")


def day_or_null(yyyymmdd: Column) -> Column:
    """Like :func:`day`, but null for a malformed value, to set such rows aside."""
    return F.try_to_date(yyyymmdd.cast("string"), "yyyyMMdd")


def turnover(close: Column, volume: Column) -> Column:
    return close.cast("long") * volume.cast("long")


def sector_label(sector_name: Column) -> Column:
    return F.when(
        sector_name.startswith(SECTOR_PREFIX),
        F.substring(sector_name, len(SECTOR_PREFIX) + 1, 1 << 30),
    ).otherwise(sector_name)


def number_or_null(value: Column) -> Column:
    """Double value; text that is no number, and NaN, become null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def trimmed(value: Column) -> Column:
    return F.trim(value.cast("string"))
