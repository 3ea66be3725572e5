"""DuckDB SQL for sources, joins, loads and reshaping."""

from checks import indicator_sql as ti
from checks import pattern_sql as ps

HITS = f"hits AS ({ps.hits(ps.CONDITIONS)})"


def ctes(*names: str) -> str:
    texts = {
        "bars": ps.BARS, "stocks": ps.STOCKS, "sectors": ps.SECTORS, "caps": ps.CAPS,
        "listing": ps.LISTING, "raw": ps.RAW_BARS,
        "listed": """SELECT symbol, ltrim(symbol, 'A') AS ticker, stock_name,
          regexp_replace(sector_name, '^코스닥 ', '') AS sector_name FROM listing""",
    }
    return "WITH " + ",\n".join(f"{name} AS ({texts[name].strip()})" for name in names)


CHANGE = """SELECT chart_id,
  (chart_close - lag(chart_close) OVER w)::DOUBLE / lag(chart_close) OVER w * 100 AS pct,
  chart_date FROM bars WINDOW w AS (PARTITION BY stock_id ORDER BY chart_date)"""

CHART_COLUMNS = """c.chart_id, c.chart_date, c.chart_open, c.chart_high, c.chart_low,
  c.chart_close, c.chart_volume, c.stock_id"""


def long_of(keys: list[str]) -> str:
    """Families as ``(chart_id, indicator_line_name, daily_indicator_value)``."""
    return "\nUNION ALL\n".join(
        f"""SELECT chart_id, indicator_line_name, daily_indicator_value FROM (
          UNPIVOT ({ti.SQL[key]}) ON COLUMNS(* EXCLUDE (chart_id))
          INTO NAME indicator_line_name VALUE daily_indicator_value)""" for key in keys)


def macd_from_range_start(start: str, end: str) -> str:
    fast, slow = ti.ema("f1", "e.c", 12), ti.ema("s1", "e.c", 26)
    signal = ti.ema("g", f"({fast} - {slow})", 9)
    return f"""{ti.START},
s AS (SELECT stock_id, min(rn) - 60 AS first_rn FROM b2
      WHERE chart_date BETWEEN DATE '{start}' AND DATE '{end}'
      GROUP BY stock_id HAVING min(rn) > 60),
f AS (
  SELECT e.chart_id, e.chart_date, e.stock_id, e.rn, s.first_rn, e.c AS f1, e.c AS s1,
         0::DOUBLE AS g
  FROM s JOIN b2 e ON e.stock_id = s.stock_id AND e.rn = s.first_rn
  UNION ALL
  SELECT e.chart_id, e.chart_date, e.stock_id, e.rn, f.first_rn, {fast}, {slow}, {signal}
  FROM f JOIN b2 e ON e.stock_id = f.stock_id AND e.rn = f.rn + 1
  WHERE e.chart_date <= DATE '{end}')
SELECT chart_id, round(f1 - s1, 6) AS "MACD", round(g, 6) AS "MACD_Signal",
       round(f1 - s1 - g, 6) AS "MACD_Oscillator"
FROM f WHERE rn >= first_rn + 60"""
