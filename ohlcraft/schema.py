"""Table schemas."""

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


LONG, INT, DOUBLE, STRING, DATE = (
    T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.DateType())

RAW_BARS = _schema(
    symbol=STRING, date=INT, open=LONG, high=LONG, low=LONG, close=LONG, volume=LONG)

SYMBOLS = _schema(symbol=STRING)

LISTING = _schema(symbol=STRING, stock_name=STRING, sector_name=STRING)

SECTORS = _schema(sector_id=LONG, sector_name=STRING)

STOCKS = _schema(stock_id=LONG, ticker=STRING, stock_name=STRING, sector_id=LONG)

CHARTS = _schema(
    chart_id=LONG, stock_id=LONG, chart_date=DATE,
    chart_open=LONG, chart_high=LONG, chart_low=LONG, chart_close=LONG,
    chart_volume=LONG, chart_turnover=LONG, chart_change_percentage=DOUBLE)

MARKET_CAPS = _schema(stock_id=LONG, cap=LONG)

PATTERN_RECORDS = _schema(pattern_id=INT, chart_id=LONG)

INDICATOR_LINES = _schema(indicator_line_id=INT, indicator_line_name=STRING)

DAILY_INDICATORS = _schema(
    chart_id=LONG, indicator_line_id=INT, daily_indicator_value=DOUBLE)

LATEST_DATE = _schema(latest_date_name=STRING, latest_date=DATE)

# What loads keep beside the eight tables, to read and compare less later.

#: Per load: bars of a stock in a month, their first and last date, and the close of the last.
CHART_CALENDAR = _schema(
    stock_id=LONG, chart_month=DATE, bars=LONG, first_date=DATE, last_date=DATE, last_close=LONG)

#: Per load: what a date's advancing less declining stocks have changed by.
NET_ADVANCES = _schema(chart_date=DATE, net=LONG)

#: Per load: the lines of a chart that have a value, as bits of 64 ids a word.
STORED_LINES = _schema(chart_id=LONG, words=T.ArrayType(LONG))
