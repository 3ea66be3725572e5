"""What the loads and the daily run leave in their tables, and the SQL that must give the same rows.

The tables are filled once per session and data set: dimensions twice, the history without some
bars, the history again with them (they come late), then the daily run of a range, twice.
"""

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import pattern_sql as ps
from checks import table_sql as ts
from ohlcraft.operators.indicators.families import FAMILIES
from ohlcraft.plans import daily
from ohlcraft.plans.tables import Tables, shared_folder
from ohlcraft.sources import derived, symbols

FIRST = dt.date(1990, 1, 1)
START, END = dt.date(1990, 9, 1), dt.date(1991, 6, 30)
KEYS = ["moving_average", "aroon", "macd", "ad_line"]
_FILLED: dict[tuple[str, str], Tables] = {}

#: The bars of known stocks: others are not stored.
MAPPED = f"SELECT * FROM ({ps.BARS}) WHERE stock_id IN (SELECT c_custkey FROM customer)"
_UNTIL = f"WITH bars AS (SELECT * FROM ({MAPPED}) WHERE chart_date <= DATE '{END}')"
_TICKER = "lpad(stock_id::VARCHAR, 12, '0') AS ticker"


def filled(spark: SparkSession, sf_dir: str) -> Tables:
    key = spark.sparkContext.applicationId, sf_dir
    if key in _FILLED:
        return _FILLED[key]
    tables = Tables(spark, f"{shared_folder(spark)}/daily-{uuid.uuid4().hex}")
    listing = derived.listing(spark, sf_dir)
    listed = listing.select("symbol")
    # four loads read the raw bars: they are derived once
    derived.raw_bars(spark, sf_dir).write.parquet(f"{tables.root}/raw_bars")
    raw = spark.read.parquet(f"{tables.root}/raw_bars")
    marks = [("charts", FIRST), ("daily_indicators", FIRST)]
    tables.append("latest_date", spark.createDataFrame(marks, Tables.SCHEMAS["latest_date"]))
    for _ in range(2):
        daily.refresh_dimensions(tables, listed, listing)
    for bars in (raw.where("volume % 7 > 0"), raw):
        daily.load_bars(tables, bars, listed, FIRST, START - dt.timedelta(days=1))
    names = [family.name for family in FAMILIES.values() if family.key in KEYS]
    for _ in range(2):
        daily.run_daily(tables, raw, listed, START, END, names)
    _FILLED[key] = tables
    return tables


def _named(tables: Tables) -> DataFrame:
    return tables.read("charts").join(tables.read("stocks").select("stock_id", "ticker"), "stock_id")


def loaded_charts(spark, sf_dir):
    return _named(filled(spark, sf_dir)).select(
        "ticker", "chart_date", "chart_open", "chart_high", "chart_low", "chart_close", "chart_volume",
        "chart_turnover", F.round("chart_change_percentage", 6).alias("chart_change_percentage"))


def refreshed_stocks(spark, sf_dir):
    tables = filled(spark, sf_dir)
    return tables.read("stocks").join(tables.read("sectors"), "sector_id").select(
        "ticker", "stock_name", "sector_name")


def daily_run_patterns(spark, sf_dir):
    tables = filled(spark, sf_dir)
    return tables.read("pattern_records").join(
        _named(tables).select("chart_id", "ticker", "chart_date"), "chart_id").select(
        "ticker", "chart_date", "pattern_id")


def daily_run_indicators(spark, sf_dir):
    tables = filled(spark, sf_dir)
    named = tables.read("daily_indicators").join(tables.read("indicators_lines"), "indicator_line_id")
    return named.join(_named(tables).select("chart_id", "ticker", "chart_date"), "chart_id").select(
        "ticker", "chart_date", "indicator_line_name",
        F.round("daily_indicator_value", 6).alias("daily_indicator_value"))


def kept_net_advances(spark, sf_dir):
    return filled(spark, sf_dir).net_advances()


def kept_calendar(spark, sf_dir):
    tables = filled(spark, sf_dir)
    return tables.calendar().join(tables.read("stocks").select("stock_id", "ticker"), "stock_id").select(
        "ticker", "chart_month", "bars", "first_date", "last_date", "last_close")


def latest_dates(spark, sf_dir):
    return filled(spark, sf_dir).read("latest_date")


def updated_changes(spark, sf_dir):
    """Changes after those of a range were stored wrong and computed again."""
    tables = Tables(spark, f"{shared_folder(spark)}/changes-{uuid.uuid4().hex}")
    tables.append("stocks", derived.stocks(spark, sf_dir))
    symbols_of = symbols.symbols_from_stocks(derived.stocks(spark, sf_dir))
    daily.load_bars(tables, derived.raw_bars(spark, sf_dir), symbols_of, FIRST, END)
    in_range = F.col("chart_date").between(START, END)
    wrong = tables.read("charts", hidden=True).withColumn(
        "chart_change_percentage", F.when(in_range, F.lit(77.0)).otherwise(F.col("chart_change_percentage")))
    tables.replace("charts", wrong, tables.commits.latest())
    tables.update_changes(START, END)
    return _named(tables).select(
        "ticker", "chart_date", F.round("chart_change_percentage", 6).alias("chart_change_percentage"))


def symbols_from_csv(spark, sf_dir):
    path = f"{shared_folder(spark)}/symbols-{uuid.uuid4().hex}"
    symbols.symbols_from_stocks(derived.stocks(spark, sf_dir)).write.csv(path)
    return symbols.symbols_from_csv(spark, path)


def symbols_from_list(spark, sf_dir):
    names = [row[0] for row in derived.table(spark, sf_dir, "nation").select("n_name").collect()]
    return symbols.symbols_from_list(spark, names)


def any_bars(spark, sf_dir):
    """The check that ends a run of a range without bars: two ranges, the second one without."""
    tables = filled(spark, sf_dir)
    later = END + dt.timedelta(days=1), END + dt.timedelta(days=400)
    return spark.createDataFrame([
        (first, not tables.read("charts", first, last).where(F.col("chart_date").between(first, last)).isEmpty())
        for first, last in ((START, END), later)], "start date, found boolean")


QUERIES = {
    "updated_changes": (updated_changes, f"""{_UNTIL}
SELECT {_TICKER}, c.chart_date, CASE WHEN lag(chart_close) OVER w = 0 AND c.chart_date BETWEEN DATE '{START}' AND DATE '{END}'
  THEN 77.0::DOUBLE WHEN lag(chart_close) OVER w IS NULL AND c.chart_date BETWEEN DATE '{START}' AND DATE '{END}'
  THEN 77.0::DOUBLE ELSE round(pct, 6) END AS chart_change_percentage
FROM bars c JOIN (SELECT chart_id, pct FROM ({ts.CHANGE})) USING (chart_id)
WINDOW w AS (PARTITION BY stock_id ORDER BY c.chart_date)"""),
    "symbols_from_csv": (symbols_from_csv, f"{ts.ctes('stocks')} SELECT 'A' || ticker AS symbol FROM stocks"),
    "symbols_from_list": (symbols_from_list, "SELECT n_name AS symbol FROM nation"),
    "any_bars": (any_bars, f"""{_UNTIL}, r AS (SELECT unnest([DATE '{START}', DATE '{END}' + 1]) AS start,
  unnest([DATE '{END}', DATE '{END}' + 400]) AS last)
SELECT start::DATE AS start, EXISTS (SELECT 1 FROM bars WHERE chart_date BETWEEN r.start AND r.last) AS found FROM r"""),
    "loaded_charts": (loaded_charts, f"""{_UNTIL}
SELECT {_TICKER}, c.chart_date, chart_open, chart_high, chart_low, chart_close, chart_volume,
  chart_close * chart_volume AS chart_turnover, round(pct, 6) AS chart_change_percentage
FROM bars c JOIN ({ts.CHANGE}) USING (chart_id)"""),
    "refreshed_stocks": (refreshed_stocks, f"""{ts.ctes('listing', 'listed')}
SELECT ticker, stock_name, sector_name FROM listed"""),
    "daily_run_patterns": (daily_run_patterns, f"""SELECT {_TICKER}, chart_date, pattern_id
FROM ({ps.sliced(str(START), str(END), True).replace(ps.BARS, MAPPED)})
JOIN ({MAPPED}) USING (chart_id)"""),
    "daily_run_indicators": (daily_run_indicators, f"""SELECT {_TICKER}, chart_date, indicator_line_name,
  daily_indicator_value FROM ({ts.long_of(KEYS).replace(ps.BARS, MAPPED)}) JOIN ({MAPPED}) USING (chart_id)
WHERE chart_date BETWEEN DATE '{START}' AND DATE '{END}'"""),
    "kept_net_advances": (kept_net_advances, f"""{_UNTIL},
d AS (SELECT chart_date, sign(chart_close - lag(chart_close) OVER (PARTITION BY stock_id ORDER BY chart_date)) AS s
      FROM bars)
SELECT chart_date, coalesce(sum(s), 0)::DOUBLE AS net FROM d GROUP BY chart_date"""),
    "kept_calendar": (kept_calendar, f"""{_UNTIL}
SELECT {_TICKER}, date_trunc('month', chart_date)::DATE AS chart_month, count(*) AS bars,
  min(chart_date) AS first_date, max(chart_date) AS last_date, arg_max(chart_close, chart_date) AS last_close
FROM bars GROUP BY stock_id, 2"""),
    "latest_dates": (latest_dates, f"""SELECT unnest(['charts', 'daily_indicators']) AS latest_date_name,
  DATE '{END}' AS latest_date"""),
}
