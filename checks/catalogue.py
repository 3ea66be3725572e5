"""Every query with the DuckDB SQL that must give the same rows."""

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import daily_queries, indicator_sql
from checks import pattern_sql as ps
from checks import table_sql as ts
from ohlcraft.functions import scalar
from ohlcraft.operators import change, detect, history, lookup, merge, reshape
from ohlcraft.operators.indicators.compute import indicators
from ohlcraft.operators.indicators.families import FAMILIES, LINE_NAMES
from ohlcraft.operators.patterns import PATTERNS
from ohlcraft.sources import bars as bar_source
from ohlcraft.sources import derived, symbols


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def _register(name: str, run, sql: str | None = None) -> None:
    assert name not in QUERIES, name
    QUERIES[name] = Query(run, sql)


START, END = dt.date(1990, 9, 1), dt.date(1991, 6, 30)


def _detect(**options):
    def run(spark, sf_dir):
        return detect.detect_patterns(
            derived.bars(spark, sf_dir), **options)
    return run


_register("bars", derived.bars, ps.BARS)
_register(
    "trend_flags",
    lambda spark, sf_dir: detect.trend_flags(derived.bars(spark, sf_dir)),
    f"""{ps.WITH_BARS}, {ps.facts()}
SELECT chart_id, u AS up, d AS down, coalesce(l > h1, false) AS rising,
       coalesce(h < l1, false) AS falling, dj AS doji, cnt20 AS dojis FROM f""")
for _id in PATTERNS:
    _register(f"pattern_{_id}", _detect(only=[_id]), ps.pattern(_id))
_register("patterns_all", _detect(), ps.all_patterns())
_register(
    "patterns_strict_prior", _detect(strict_prior=True),
    ps.all_patterns({**ps.CONDITIONS, **ps.STRICT_PRIOR}))
_register(
    "patterns_range", _detect(start=START, end=END), ps.sliced(str(START), str(END), True))
_register(
    "patterns_slice", _detect(start=START, end=END, emit="slice"),
    ps.sliced(str(START), str(END), False))
# the bars in another order and on other partitions
_register(
    "patterns_in_parts",
    lambda spark, sf_dir: detect.detect_patterns(
        derived.bars(spark, sf_dir).repartition(7, "chart_close").sortWithinPartitions("chart_high")),
    ps.all_patterns())


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(F.col(f"`{name}`"), 6) for name in names})


def _indicator(name: str, anchor: str = "bar"):
    def run(spark, sf_dir):
        wide = indicators(derived.bars(spark, sf_dir), [name], anchor=anchor)
        return _rounded(wide, *(c for c in wide.columns if c != "chart_id"))
    return run


for _family in FAMILIES.values():
    _register(f"ti_{_family.key}", _indicator(_family.name), indicator_sql.SQL[_family.key])
    if not _family.framed:  # one recursion over the whole history
        _register(f"once_{_family.key}", _indicator(_family.name, "range"), indicator_sql.SQL[_family.key].once)


# -- indicators together ---------------------------------------------------------------

_MIXED = ["moving_average", "aroon", "macd", "ad_line"]


def _names(keys) -> list[str]:
    return [family.name for family in FAMILIES.values() if family.key in keys]


def _long(spark, sf_dir, keys=_MIXED):
    wide = indicators(derived.bars(spark, sf_dir), _names(keys))
    return _rounded(reshape.indicators_long(wide), "daily_indicator_value")


_register("indicators_long", _long, ts.long_of(_MIXED))


def _line_summary(spark, sf_dir):
    """Count and extremes of every line, all families computed in one pass; a summary has no place
    for a family that raised."""
    wide = indicators(derived.bars(spark, sf_dir), strict=True)
    return (
        _rounded(reshape.indicators_long(wide), "daily_indicator_value")
        .groupBy("indicator_line_name")
        .agg(F.count("*").alias("bars"),
             F.min("daily_indicator_value").alias("lowest"),
             F.max("daily_indicator_value").alias("highest")))


_register(
    "indicators_all", _line_summary,
    f"""SELECT indicator_line_name, count(*) AS bars,
  min(daily_indicator_value) AS lowest, max(daily_indicator_value) AS highest
FROM ({ts.long_of([family.key for family in FAMILIES.values()])}) GROUP BY 1""")
_register(
    "indicators_range_anchor",
    lambda spark, sf_dir: _rounded(
        indicators(derived.bars(spark, sf_dir), ["MACD"], START, END, anchor="range"),
        "MACD", "MACD_Signal", "MACD_Oscillator"),
    ts.macd_from_range_start(str(START), str(END)))

# -- bars ------------------------------------------------------------------------------

_register(
    "change_pct",
    lambda spark, sf_dir: _rounded(
        change.change_percentage(derived.bars(spark, sf_dir))
        .select("chart_id", "chart_change_percentage"), "chart_change_percentage"),
    f"""{ps.WITH_BARS} SELECT chart_id, round(pct, 6) AS chart_change_percentage
FROM ({ts.CHANGE})""")
_register(
    "change_pct_range",
    lambda spark, sf_dir: _rounded(
        change.change_percentage(derived.bars(spark, sf_dir), START, END)
        .select("chart_id", "chart_change_percentage"), "chart_change_percentage"),
    f"""{ps.WITH_BARS} SELECT chart_id,
  CASE WHEN chart_date BETWEEN DATE '{START}' AND DATE '{END}' THEN round(pct, 6) END
    AS chart_change_percentage FROM ({ts.CHANGE})""")
_register(
    "prior_60",
    lambda spark, sf_dir: history.prior_bars(derived.bars(spark, sf_dir), START),
    f"""{ps.WITH_BARS} SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY stock_id ORDER BY chart_date DESC)::INT AS rank
  FROM bars WHERE chart_date < DATE '{START}') WHERE rank <= 60""")
_register(
    "raw_bars_in_range",
    lambda spark, sf_dir: bar_source.bars_in_range(
        derived.raw_bars(spark, sf_dir),
        symbols.symbols_from_stocks(derived.stocks(spark, sf_dir)), START, END),
    f"""{ts.ctes('bars', 'raw', 'stocks')} SELECT * FROM raw
WHERE date BETWEEN {START:%Y%m%d} AND {END:%Y%m%d}
  AND symbol IN (SELECT 'A' || ticker FROM stocks)""")
_register(
    "chart_rows",
    lambda spark, sf_dir: bar_source.chart_rows(derived.raw_bars(spark, sf_dir)),
    f"""{ts.ctes('bars', 'raw')} SELECT ltrim(symbol, 'A') AS ticker,
  strptime(date::VARCHAR, '%Y%m%d')::DATE AS chart_date, open AS chart_open,
  high AS chart_high, low AS chart_low, close AS chart_close, volume AS chart_volume,
  close * volume AS chart_turnover FROM raw""")
_register(
    "charts_by_date",
    lambda spark, sf_dir: bar_source.charts_by_date(
        derived.charts(spark, sf_dir), derived.stocks(spark, sf_dir), START, END),
    f"""{ts.ctes('bars', 'stocks')} SELECT {ts.CHART_COLUMNS}, s.ticker,
  c.chart_close * c.chart_volume AS chart_turnover, NULL::DOUBLE AS chart_change_percentage
FROM bars c LEFT JOIN stocks s USING (stock_id)
WHERE c.chart_date BETWEEN DATE '{START}' AND DATE '{END}'
ORDER BY c.stock_id, c.chart_date""")
_register(
    "charts_by_ticker",
    lambda spark, sf_dir: bar_source.charts_of_tickers(
        derived.charts(spark, sf_dir), derived.stocks(spark, sf_dir), "000000000001", START, END),
    f"""{ts.ctes('bars', 'stocks')} SELECT {ts.CHART_COLUMNS}
FROM bars c LEFT JOIN stocks s USING (stock_id)
WHERE c.chart_date BETWEEN DATE '{START}' AND DATE '{END}' AND s.ticker = '000000000001'
ORDER BY c.stock_id, c.chart_date""")
_register(
    "charts_by_tickers",
    lambda spark, sf_dir: bar_source.charts_of_tickers(
        derived.charts(spark, sf_dir), derived.stocks(spark, sf_dir),
        derived.stocks(spark, sf_dir).where("sector_id >= 10").select("ticker"), START, END),
    f"""{ts.ctes('bars', 'stocks')} SELECT {ts.CHART_COLUMNS}
FROM bars c JOIN stocks s USING (stock_id)
WHERE c.chart_date BETWEEN DATE '{START}' AND DATE '{END}' AND s.sector_id >= 10""")
_register(
    "session_check",
    lambda spark, sf_dir: bar_source.had_session(
        derived.raw_bars(spark, sf_dir), "A000000000001", START),
    f"""{ts.ctes('bars', 'raw')} SELECT count(*) > 0 AS had_session FROM raw
WHERE symbol = 'A000000000001' AND date = {START:%Y%m%d}""")
_register(
    "sessions",
    lambda spark, sf_dir: bar_source.sessions(derived.bars(spark, sf_dir)),
    f"""{ps.WITH_BARS} SELECT chart_date, count(*) AS stocks,
  chart_date = (SELECT max(chart_date) FROM bars) AS is_newest FROM bars GROUP BY chart_date""")

# -- symbols and text ------------------------------------------------------------------

_register(
    "symbol_normalise",
    lambda spark, sf_dir: derived.stocks(spark, sf_dir).select(
        "stock_id", scalar.symbol_of(F.col("ticker")).alias("symbol"),
        scalar.ticker_of(F.concat(F.lit("AA"), "stock_name")).alias("bare_name"),
        scalar.ticker_of(F.concat(F.lit("AAB"), "ticker")).alias("inner_a")),
    f"""{ts.ctes('stocks')} SELECT stock_id, 'A' || ticker AS symbol,
  regexp_replace('AA' || stock_name, '^A+', '') AS bare_name, 'B' || ticker AS inner_a FROM stocks""")
_register(
    "coerced_values",
    lambda spark, sf_dir: derived.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        scalar.number_or_null(F.substring("o_orderpriority", 1, 1)).alias("number"),
        scalar.number_or_null(F.col("o_orderpriority")).alias("no_number"),
        scalar.trimmed(F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))).alias("trimmed")),
    """SELECT o_orderkey, TRY_CAST(substring(o_orderpriority, 1, 1) AS DOUBLE) AS number,
  TRY_CAST(o_orderpriority AS DOUBLE) AS no_number, o_orderpriority AS trimmed FROM orders""")
_register(
    "symbols_from_stocks",
    lambda spark, sf_dir: symbols.symbols_from_stocks(derived.stocks(spark, sf_dir)),
    f"{ts.ctes('stocks')} SELECT 'A' || ticker AS symbol FROM stocks")


def _listed(spark, sf_dir):
    listing = derived.listing(spark, sf_dir)
    return symbols.listed_stocks(listing.select("symbol"), listing)


_register("listed_stocks", _listed, f"{ts.ctes('listing', 'listed')} SELECT * FROM listed")
_register(
    "listed_sectors",
    lambda spark, sf_dir: symbols.listed_sectors(
        derived.listing(spark, sf_dir).select("symbol"), derived.listing(spark, sf_dir)),
    f"{ts.ctes('listing', 'listed')} SELECT DISTINCT sector_name FROM listed")


def _caps_twice(spark, sf_dir):
    """Two snapshots of all caps, the later one a tenth higher."""
    caps = derived.market_cap_snapshot(spark, sf_dir)
    return caps.withColumn("at", F.lit(1)).unionByName(
        caps.withColumn("at", F.lit(2)).withColumn("cap", F.col("cap") + F.floor(F.col("cap") / 10)))


_register(
    "market_caps",
    lambda spark, sf_dir: symbols.market_caps(
        symbols.symbols_from_stocks(derived.stocks(spark, sf_dir)), _caps_twice(spark, sf_dir), "at"),
    f"{ts.ctes('caps')} SELECT symbol, cap + cap // 10 AS cap FROM caps")

# -- joins to the dimensions -----------------------------------------------------------


def _rows(spark, sf_dir):
    return bar_source.chart_rows(derived.raw_bars(spark, sf_dir))


_register(
    "charts_with_stock_ids",
    lambda spark, sf_dir: lookup.with_stock_ids(
        _rows(spark, sf_dir), derived.stocks(spark, sf_dir)
    ).select("stock_id", "chart_date", "chart_close"),
    f"""{ts.ctes('bars', 'stocks')} SELECT s.stock_id, chart_date, chart_close
FROM bars LEFT JOIN stocks s USING (stock_id)""")
_register(
    "rejected_bars",
    lambda spark, sf_dir: lookup.mapped_and_rejected(
        _rows(spark, sf_dir), derived.stocks(spark, sf_dir))[1].select("ticker", "chart_date"),
    f"""{ts.ctes('bars', 'stocks')} SELECT lpad(stock_id::VARCHAR, 12, '0') AS ticker, chart_date
FROM bars WHERE stock_id NOT IN (SELECT stock_id FROM stocks)""")
_register(
    "unmapped_tickers",
    lambda spark, sf_dir: lookup.missing_keys(
        _rows(spark, sf_dir), derived.stocks(spark, sf_dir), "ticker"),
    f"""{ts.ctes('bars', 'stocks')} SELECT DISTINCT lpad(stock_id::VARCHAR, 12, '0') AS ticker
FROM bars WHERE stock_id NOT IN (SELECT stock_id FROM stocks)""")
_register(
    "market_caps_by_stock",
    lambda spark, sf_dir: lookup.market_caps_by_stock(
        derived.market_cap_snapshot(spark, sf_dir), derived.stocks(spark, sf_dir)),
    f"""{ts.ctes('caps', 'stocks')} SELECT symbol, ticker, stock_id, cap
FROM caps LEFT JOIN stocks ON symbol = 'A' || ticker""")
_register(
    "stocks_with_sector_ids",
    lambda spark, sf_dir: lookup.stocks_with_sector_ids(
        _listed(spark, sf_dir), derived.sectors(spark, sf_dir)),
    f"""{ts.ctes('listing', 'listed', 'sectors')} SELECT ticker, stock_name, sector_id, sector_name
FROM listed LEFT JOIN sectors USING (sector_name)""")

# -- loads: what is in the table already is told by an attribute of the rows -----------


def _known_charts(spark, sf_dir):
    return derived.charts(spark, sf_dir).where("chart_volume < 50000").withColumn(
        "chart_turnover", F.lit(-1).cast("long"))


def _incoming_charts(spark, sf_dir):
    """All charts, some of them twice."""
    charts = derived.charts(spark, sf_dir)
    return charts.unionByName(charts.where("chart_volume > 90000"))


_register(
    "insert_ignore_charts",
    lambda spark, sf_dir: merge.with_inserts(
        _known_charts(spark, sf_dir), _incoming_charts(spark, sf_dir), ["stock_id", "chart_date"]
    ).drop("chart_change_percentage"),
    f"""{ps.WITH_BARS} SELECT *, CASE WHEN chart_volume < 50000 THEN -1
  ELSE chart_close * chart_volume END AS chart_turnover FROM bars""")
_register(
    "load_stats",
    lambda spark, sf_dir: merge.load_stats(merge.marked_new(
        _known_charts(spark, sf_dir), _incoming_charts(spark, sf_dir),
        ["stock_id", "chart_date"])),
    f"""{ps.WITH_BARS}, n AS (SELECT count(*) + count(*) FILTER (chart_volume > 90000) AS total,
  count(*) FILTER (chart_volume >= 50000) AS inserted FROM bars)
SELECT total, inserted, total - inserted AS skipped FROM n""")


def _hits(spark, sf_dir):
    return detect.detect_patterns(derived.bars(spark, sf_dir))


_register(
    "insert_ignore_patterns",
    lambda spark, sf_dir: merge.new_rows(
        _hits(spark, sf_dir).where("pattern_id < 40"), _hits(spark, sf_dir),
        ["pattern_id", "chart_id"]),
    f"""{ps.WITH_BARS}, {ps.facts()}, {ts.HITS}
SELECT chart_id, pattern_id FROM hits WHERE pattern_id >= 40""")

_LINE_IDS = {line: i for i, line in enumerate((line for name in FAMILIES for line in LINE_NAMES[name]), 1)}


def _new_indicators(spark, sf_dir):
    """Values of all lines; the lines of a chart with a value below 3000 are there already."""
    bars = derived.bars(spark, sf_dir)
    wide = _rounded(indicators(bars), *_LINE_IDS)
    lines = spark.createDataFrame(list(_LINE_IDS.items()), "indicator_line_name string, indicator_line_id int")
    known = reshape.indicators_long(wide).where("daily_indicator_value < 3000").join(
        F.broadcast(lines), "indicator_line_name")
    stored = merge.stored_lines(known, _LINE_IDS.values())
    told = merge.with_stored_lines(bars, stored, _LINE_IDS.values())
    wide = _rounded(indicators(told, keep=(merge.STORED,), breadth_bars=bars), *_LINE_IDS)
    return merge.melted(merge.new_line_values(None, wide, _LINE_IDS), wide, _LINE_IDS)


_register(
    "insert_ignore_indicators", _new_indicators,
    f"""SELECT chart_id, indicator_line_id, daily_indicator_value
FROM ({ts.long_of([family.key for family in FAMILIES.values()])})
JOIN (VALUES {", ".join(f"({i}, '{line.replace(chr(39), chr(39) * 2)}')" for line, i in _LINE_IDS.items())})
  AS l(indicator_line_id, indicator_line_name)
USING (indicator_line_name) WHERE daily_indicator_value >= 3000""")


def _upserted_caps(spark, sf_dir):
    stocks = derived.stocks(spark, sf_dir)
    known = stocks.where("sector_id < 10").select("stock_id", F.lit(0).cast("long").alias("cap"))
    known = known.unionByName(known.withColumn("stock_id", -F.col("stock_id")))  # not in the batch
    mapped = lookup.market_caps_by_stock(_caps_twice(spark, sf_dir), stocks, "at")
    return merge.upserted(known, mapped.select("stock_id", "cap", "at"), ["stock_id"], "at")


_register(
    "upsert_market_cap", _upserted_caps,
    f"""{ts.ctes('caps', 'stocks')},
c AS (SELECT stock_id, cap + cap // 10 AS cap FROM caps JOIN stocks ON symbol = 'A' || ticker)
SELECT stock_id, cap FROM c UNION ALL
SELECT x, 0 FROM (SELECT unnest([stock_id, -stock_id]) AS x FROM stocks WHERE sector_id < 10)
WHERE x NOT IN (SELECT stock_id FROM c)""")
_register(
    "new_sectors",
    lambda spark, sf_dir: merge.new_sectors(
        derived.sectors(spark, sf_dir).where("sector_id < 10"), _listed(spark, sf_dir)),
    f"""{ts.ctes('listing', 'listed', 'sectors')} SELECT DISTINCT sector_name FROM listed
WHERE sector_name NOT IN (SELECT sector_name FROM sectors WHERE sector_id < 10)""")
_register(
    "new_stocks",
    lambda spark, sf_dir: merge.new_stocks(
        derived.stocks(spark, sf_dir).where("sector_id < 10"), _listed(spark, sf_dir)),
    f"""{ts.ctes('listing', 'listed', 'stocks')} SELECT DISTINCT ticker, stock_name, sector_name
FROM listed WHERE stock_name NOT IN (SELECT stock_name FROM stocks WHERE sector_id < 10)""")
_register(
    "new_ids",
    lambda spark, sf_dir: merge.with_new_ids(
        derived.stocks(spark, sf_dir).select("stock_name"), "new_id", ["stock_name"], after=100)
    .agg(F.count("*").alias("rows"), F.countDistinct("new_id").alias("ids"),
         F.min("new_id").alias("first"), F.max("new_id").alias("last")),
    f"""{ts.ctes('stocks')} SELECT count(*) AS rows, count(*) AS ids, 101 AS first,
  100 + count(*) AS last FROM stocks""")
_register(
    "high_water_mark",
    lambda spark, sf_dir: merge.high_water_mark(
        derived.bars(spark, sf_dir).groupBy(
            F.concat(F.lit("stock "), F.col("stock_id").cast("string")).alias("latest_date_name"))
        .agg(F.max("chart_date").alias("latest_date")), "stock 1", END),
    f"""{ps.WITH_BARS} SELECT 'stock ' || stock_id AS latest_date_name,
  CASE WHEN stock_id = 1 THEN DATE '{END}' ELSE max(chart_date) END AS latest_date
FROM bars GROUP BY stock_id""")


# -- the lines of the whole market on a range, from what the daily run reads ---------------

def _breadth_in_range(spark, sf_dir):
    bars = derived.bars(spark, sf_dir)
    wide = indicators(
        history.warmup_bars(bars, START, END), _names(("ad_line", "mcclellan")), START, END,
        breadth_bars=history.market_bars(bars, START, END))
    return _rounded(reshape.indicators_long(wide), "daily_indicator_value")


_register(
    "breadth_in_range", _breadth_in_range,
    f"""SELECT x.* FROM ({ts.long_of(["ad_line", "mcclellan"])}) x
JOIN ({ps.BARS}) b USING (chart_id) WHERE b.chart_date BETWEEN DATE '{START}' AND DATE '{END}'""")


# -- what the loads and the daily run store -----------------------------------------------

for _name, (_run, _sql) in daily_queries.QUERIES.items():
    _register(_name, _run, _sql)
