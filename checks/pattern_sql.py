"""DuckDB SQL for bars, trends and patterns, written from the definitions alone."""

from ohlcraft.sources import derived

DAYS = "(SELECT unnest(generate_series(1, 62)) AS rn)"


def _text(sql: str, **tables: str) -> str:
    for name, table in {"text": "VARCHAR", "days": DAYS, **tables}.items():
        sql = sql.replace("{" + name + "}", table)
    return sql.strip()


BARS = _text(derived.BARS, orders="orders")
STOCKS = _text(derived.STOCKS, customer="customer")
SECTORS = _text(derived.SECTORS, nation="nation")
CAPS = _text(derived.MARKET_CAP_SNAPSHOT, customer="customer")
LISTING = _text(derived.LISTING, customer="customer", nation="nation")
RAW_BARS = _text(derived.RAW_BARS, charts="bars")

WITH_BARS = f"WITH bars AS ({BARS})"

_lags = ",\n  ".join(
    f"lag({x}, {k}) OVER w AS {x}{k}" for k in range(1, 9) for x in "ohlc")


def facts(bars: str = "bars") -> str:
    """CTEs that end in ``f``: lags, trends and frames per bar of the relation ``bars``."""
    return f"""
p AS (SELECT chart_id, stock_id, chart_date, chart_open AS o, chart_high AS h, chart_low AS l,
             chart_close AS c FROM {bars}),
s AS (SELECT *,
  coalesce(abs(o - c) < (h - l) * 0.05::DOUBLE, false) AS dj,
  avg(c) OVER (w ROWS 4 PRECEDING) AS ma5, avg(c) OVER (w ROWS 9 PRECEDING) AS ma10,
  count(c) OVER (w ROWS 9 PRECEDING) AS n10,
  min(c) OVER (w ROWS 4 PRECEDING) AS min5, max(c) OVER (w ROWS 4 PRECEDING) AS max5,
  lag(c, 9) OVER w AS c9
  FROM p WINDOW w AS (PARTITION BY stock_id ORDER BY chart_date)),
t AS (SELECT *,
  coalesce(n10 = 10 AND ma5 > ma10 AND min5 >= c9, false) AS u,
  coalesce(n10 = 10 AND ma5 < ma10 AND max5 <= c9, false) AS d FROM s),
f AS (SELECT *,
  {_lags},
  coalesce(lag(u, 1) OVER w, false) AS u1, coalesce(lag(u, 2) OVER w, false) AS u2,
  coalesce(lag(d, 1) OVER w, false) AS d1, coalesce(lag(d, 2) OVER w, false) AS d2,
  coalesce(lag(dj, 1) OVER w, false) AS dj1, coalesce(lag(dj, 2) OVER w, false) AS dj2,
  CASE WHEN count(o - c) OVER (w ROWS BETWEEN 21 PRECEDING AND 2 PRECEDING) = 20
       THEN avg(abs(o - c)) OVER (w ROWS BETWEEN 21 PRECEDING AND 2 PRECEDING) END AS avgb,
  sum(dj::INT) OVER (w ROWS 19 PRECEDING) AS cnt20,
  min(l) OVER (w ROWS 19 PRECEDING) AS lo20, max(h) OVER (w ROWS 19 PRECEDING) AS hi20,
  min(l) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS plo,
  max(h) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS phi,
  min(l) OVER (w ROWS BETWEEN 21 PRECEDING AND 2 PRECEDING) AS plo1,
  max(h) OVER (w ROWS BETWEEN 21 PRECEDING AND 2 PRECEDING) AS phi1,
  min(l) OVER (w ROWS BETWEEN 22 PRECEDING AND 3 PRECEDING) AS plo2,
  max(h) OVER (w ROWS BETWEEN 22 PRECEDING AND 3 PRECEDING) AS phi2
  FROM t WINDOW w AS (PARTITION BY stock_id ORDER BY chart_date))"""


def _div(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / ({b})::DOUBLE)"


def _band(k: int, bull: str) -> str:
    half = f"abs(o{k} - c{k}) / 2.0::DOUBLE"
    inside = " AND ".join(
        f"greatest(o{i}, c{i}) <= o{k} + {half} AND least(o{i}, c{i}) >= o{k} - {half}"
        f" AND abs(o{k} - c{k}) >= 3 * abs(o{i} - c{i})" for i in range(1, k))
    return f"({bull} AND {inside})"


def _methods(k: int, up: bool) -> str:
    a, b = ("c", "o") if up else ("o", "c")
    cmp = ">" if up else "<"
    smalls = " AND ".join(
        f"{a}{k} - {b}{k} >= 3 * abs(o{i} - c{i}) AND {a} - {b} >= 3 * abs(o{i} - c{i})"
        for i in range(1, k))
    return (f"({a}{k} > {b}{k} AND {a} > {b} AND {smalls} AND c {cmp} c{k} AND o {cmp} o{k})")


_PIN = "abs(o - c) <= (h - l) / 3.0::DOUBLE AND least(o, c) - l >= 2 * abs(o - c)"
_TAIL = """abs(o - c) < (h - l) * 0.3::DOUBLE AND h - greatest(o, c) > 2 * abs(o - c)
  AND least(o, c) - l < 0.1::DOUBLE * abs(o - c)"""
_IN = """abs(o1 - c1) >= avgb * 1.5::DOUBLE AND greatest(o, c) <= greatest(o1, c1)
  AND least(o, c) >= least(o1, c1)"""
_MORNING = f"""d2 AND c2 < o2 AND {_div('o2 - c2', 'o2')} >= 0.03::DOUBLE
  AND greatest(o1, c1) < least(o2, c2) AND c > o AND {_div('c - c2', 'o2 - c2')} >= 0.5::DOUBLE"""
_EVENING = f"""u2 AND c2 > o2 AND {_div('c2 - o2', 'o2')} >= 0.03::DOUBLE
  AND least(o1, c1) > greatest(o2, c2) AND c < o AND {_div('c2 - c', 'c2 - o2')} >= 0.5::DOUBLE"""
_OPEN_NEAR = "o >= 0.9::DOUBLE * o1 AND o <= 1.1::DOUBLE * o1"
_BODY_NEAR = ("abs(o - c) >= 0.9::DOUBLE * abs(o1 - c1) AND abs(o - c) <= 1.1::DOUBLE * abs(o1 - c1)")
_MID = "(o + c) / 2.0::DOUBLE"

CONDITIONS = {
    1: f"d AND {_PIN}",
    2: f"u AND {_PIN}",
    3: "d AND c1 < o1 AND c > o AND c > o1 AND o < c1",
    4: "u AND c1 > o1 AND c < o AND c < o1 AND o > c1",
    7: f"{_MORNING} AND abs(o1 - c1) < (h1 - l1) * 0.3::DOUBLE",
    8: f"{_EVENING} AND abs(o1 - c1) < (h1 - l1) * 0.3::DOUBLE",
    9: f"{_MORNING} AND abs(o1 - c1) < (h1 - l1) * 0.1::DOUBLE",
    10: f"{_EVENING} AND abs(o1 - c1) < (h1 - l1) * 0.1::DOUBLE",
    11: f"u1 AND {_TAIL}",
    12: f"d1 AND {_TAIL}",
    13: f"u2 AND {_IN} AND abs(o - c) < (h - l) * 0.3::DOUBLE",
    14: f"d2 AND {_IN} AND abs(o - c) < (h - l) * 0.3::DOUBLE",
    15: f"u2 AND {_IN} AND abs(o - c) < (h - l) * 0.1::DOUBLE",
    16: f"d2 AND {_IN} AND abs(o - c) < (h - l) * 0.1::DOUBLE",
    17: "d AND abs(l - l1) <= l * 0.001::DOUBLE AND abs(o - c) <= abs(o1 - c1) * 0.5::DOUBLE",
    18: "u AND abs(h - h1) <= h * 0.001::DOUBLE AND abs(o - c) <= abs(o1 - c1) * 0.5::DOUBLE",
    19: f"""d AND abs(o - l) <= l * 0.001::DOUBLE AND abs(c - h) <= h * 0.001::DOUBLE
      AND {_div('c - o', 'o')} >= 0.03::DOUBLE""",
    20: f"""u AND abs(h - o) <= o * 0.001::DOUBLE AND abs(l - c) <= c * 0.001::DOUBLE
      AND {_div('o - c', 'o')} >= 0.03::DOUBLE""",
    21: "u2 AND c2 > o2 AND c1 < o1 AND c < o AND h2 < o1 AND h2 < o AND o > o1 AND c < c1",
    22: """c2 < o2 AND c1 < o1 AND c < o AND abs(l - c) <= c * 0.1::DOUBLE
      AND abs(l1 - c1) <= c * 0.1::DOUBLE AND abs(l2 - c2) <= c * 0.1::DOUBLE
      AND c1 < o AND o < o1 AND c2 < o1 AND o1 < o2""",
    23: " AND ".join(
        f"c{k} > o{k} AND {_div(f'c{k} - o{k}', f'o{k}')} >= 0.03::DOUBLE"
        f" AND abs(h{k} - c{k}) <= c{k} * 0.1::DOUBLE" for k in ("", 1, 2))
        + """ AND o < c1 * 1.02::DOUBLE AND o > o1 * 0.98::DOUBLE
      AND o1 < c2 * 1.02::DOUBLE AND o1 > o2 * 0.98::DOUBLE""",
    26: f"""d1 AND {_div('o1 - c1', 'o1')} >= 0.03::DOUBLE AND c > o
      AND {_div('o - c1', 'c1')} <= -0.02::DOUBLE AND abs(c - c1) <= abs(o1 - c1) * 0.1::DOUBLE""",
    27: f"""u1 AND {_div('c1 - o1', 'o1')} >= 0.03::DOUBLE AND c < o
      AND {_div('o - c1', 'c1')} >= 0.02::DOUBLE AND abs(c - c1) <= abs(o1 - c1) * 0.1::DOUBLE""",
    32: "l > h1",
    33: "h < l1",
    34: f"l1 > h2 AND c1 > o1 AND c < o AND {_BODY_NEAR} AND c > h2",
    35: f"h1 < l2 AND c1 < o1 AND c > o AND {_BODY_NEAR} AND c < l2",
    36: "l > h1 AND (" + " OR ".join(_band(k, f"c{k} > o{k}") for k in range(5, 9)) + ")",
    37: "h < l1 AND (" + " OR ".join(_band(k, f"c{k} < o{k}") for k in range(5, 9)) + ")",
    38: f"""l2 > h3 AND c1 > o1 AND c > o AND {_OPEN_NEAR}
      AND c - o >= 0.5::DOUBLE * (c1 - o1) AND c - o <= 2 * (c1 - o1)""",
    39: f"""h2 < l3 AND c1 < o1 AND c < o AND {_OPEN_NEAR}
      AND o - c >= 0.5::DOUBLE * (o1 - c1) AND o - c <= 2 * (o1 - c1)""",
    40: "(" + " OR ".join(_methods(k, True) for k in range(3, 6)) + ")",
    41: "(" + " OR ".join(_methods(k, False) for k in range(3, 6)) + ")",
    42: f"u AND c1 < o1 AND c > o AND {_OPEN_NEAR}",
    43: f"d AND c1 > o1 AND c < o AND {_OPEN_NEAR}",
    44: "u AND dj AND cnt20 < 5",
    45: f"""d AND dj AND cnt20 < 5 AND {_MID} >= l + (h - l) / 3.0::DOUBLE
      AND {_MID} <= h - (h - l) / 3.0::DOUBLE""",
    46: f"d AND dj AND cnt20 < 5 AND {_MID} <= l + (h - l) / 4.0::DOUBLE",
    47: f"u AND dj AND cnt20 < 5 AND {_MID} >= h - (h - l) / 4.0::DOUBLE",
    48: "dj AND dj1 AND dj2 AND cnt20 < 6 AND l < lo20",
    49: "dj AND dj1 AND dj2 AND cnt20 < 6 AND h > hi20",
}

STRICT_PRIOR = {
    48: "dj AND dj1 AND dj2 AND cnt20 < 6 AND (l < plo OR l1 < plo1 OR l2 < plo2)",
    49: "dj AND dj1 AND dj2 AND cnt20 < 6 AND (h > phi OR h1 > phi1 OR h2 > phi2)",
}


def hits(conditions: dict[int, str], where: str = "true") -> str:
    """Rows ``(chart_id, pattern_id)`` of ``f`` for the given conditions."""
    flags = ", ".join(f"CASE WHEN {c} THEN {i} END" for i, c in conditions.items())
    return f"""SELECT chart_id, pattern_id FROM (
  SELECT chart_id, unnest([{flags}]) AS pattern_id FROM f WHERE {where})
WHERE pattern_id IS NOT NULL"""


def pattern(pattern_id: int) -> str:
    return f"{WITH_BARS}, {facts()}\n{hits({pattern_id: CONDITIONS[pattern_id]})}"


def all_patterns(conditions: dict[int, str] | None = None) -> str:
    return f"{WITH_BARS}, {facts()}\n{hits(conditions or CONDITIONS)}"


def sliced(start: str, end: str, in_range_only: bool) -> str:
    """Hits on the range with 60 rows ahead of it, for stocks that have those rows."""
    where = f"chart_date >= DATE '{start}'" if in_range_only else "true"
    return f"""{WITH_BARS},
n AS (SELECT *, row_number() OVER (PARTITION BY stock_id ORDER BY chart_date) AS rn
      FROM bars WHERE chart_date <= DATE '{end}'),
g AS (SELECT stock_id, min(rn) AS first_rn FROM n WHERE chart_date >= DATE '{start}'
      GROUP BY stock_id HAVING min(rn) > 60),
cut AS (SELECT n.* FROM n JOIN g USING (stock_id) WHERE rn >= first_rn - 60),
{facts('cut')}
{hits(CONDITIONS, where)}"""
