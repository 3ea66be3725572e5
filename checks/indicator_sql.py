"""DuckDB SQL for the indicator families, written from their definitions.

Frames use window functions. Recursive families step through the 61 bars that end with each
bar by a recursive CTE whose row is the state after position ``k`` of that slice.
"""

from checks.pattern_sql import BARS

START = f"""WITH RECURSIVE bars AS ({BARS}),
b0 AS (SELECT chart_id, stock_id, chart_date,
  row_number() OVER (PARTITION BY stock_id ORDER BY chart_date) AS rn,
  chart_open::DOUBLE AS o, chart_high::DOUBLE AS h, chart_low::DOUBLE AS l,
  chart_close::DOUBLE AS c, chart_volume::DOUBLE AS v FROM bars),
b1 AS (SELECT *, lag(c) OVER w AS c1, lag(h) OVER w AS h1, lag(l) OVER w AS l1,
  lag(v) OVER w AS v1, lag(c, 10) OVER w AS c10, (h + l + c) / 3 AS tp,
  lag((h + l + c) / 3) OVER w AS tp1
  FROM b0 WINDOW w AS (PARTITION BY stock_id ORDER BY rn)),
b2 AS (SELECT *, c - c1 AS d, abs(c - c1) AS ad,
  CASE WHEN c1 IS NOT NULL THEN greatest(c - c1, 0) END AS up,
  CASE WHEN c1 IS NOT NULL THEN greatest(c1 - c, 0) END AS dn,
  CASE WHEN c1 IS NOT NULL THEN greatest(h, c1) - least(l, c1) END AS tr
  FROM b1)"""


def over(function: str, x: str, n: int) -> str:
    frame = f"OVER (w ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({x}) {frame} = {n} THEN {function}({x}) {frame} END"


def avg(x: str, n: int) -> str:
    return over("avg", x, n)


def total(x: str, n: int) -> str:
    return over("sum", x, n)


def hi(x: str, n: int) -> str:
    return over("max", x, n)


def lo(x: str, n: int) -> str:
    return over("min", x, n)


def _levels(levels: list[dict[str, str]], source: str = "b2") -> tuple[str, str]:
    text = ""
    for i, columns in enumerate(levels):
        listed = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
        text += (f",\n{source}_{i} AS (SELECT *, {listed} FROM {source}"
                 " WINDOW w AS (PARTITION BY stock_id ORDER BY rn))")
        source = f"{source}_{i}"
    return text, source


def _lines(lines: dict[str, str]) -> str:
    return ", ".join(f'round({sql}, 6) AS "{name}"' for name, sql in lines.items())


def by_frames(lines: dict[str, str], *levels: dict[str, str]) -> str:
    text, source = _levels(list(levels))
    return f"{START}{text}\nSELECT chart_id, {_lines(lines)} FROM {source} WHERE rn > 60"


def with_signal(name: str, value: str, *levels: dict[str, str], n: int = 9) -> str:
    """A value computed on the last level, and its nine-row mean."""
    return by_frames(
        {name: "line", f"{name}_Signal": "signal"},
        *levels, {"line": value}, {"signal": avg("line", n)})


def step(state: str, x: str, weight: float) -> str:
    return f"coalesce(f.{state} + ({x} - f.{state}) * {weight!r}::DOUBLE, {x})"


def ema(state: str, x: str, n: int) -> str:
    return step(state, x, 2 / (n + 1))


def rma(state: str, x: str, n: int) -> str:
    return step(state, x, 1 / n)


def at(value: str, k: int = 60) -> str:
    return f"max(CASE WHEN k = {k} THEN {value} END)"


def mean(value: str, first: int = 52, last: int = 60) -> str:
    cases = f"CASE WHEN k BETWEEN {first} AND {last} THEN {value} END"
    return f"CASE WHEN count({cases}) = {last - first + 1} THEN avg({cases}) END"


class Stepped(str):
    """SQL that starts its steps anew for each bar; ``once`` starts them at a stock's first bar."""
    once: str


def _stepped(sql: str, once: str) -> Stepped:
    found = Stepped(sql)
    found.once = once
    return found


#: The last 61 steps up to each bar, out of one chain from the first bar on.
_LAST_STEPS = """
f AS (SELECT t.{id}, c.* EXCLUDE ({id}, k), c.k - t.k + 60 AS k
      FROM chain t JOIN chain c ON c.{of} = t.{of} AND c.k BETWEEN t.k - 60 AND t.k WHERE t.k >= 60)"""


def by_steps(
    states: dict[str, tuple[str, str]], lines: dict[str, str], *levels: dict[str, str],
    keep: str = "",
) -> Stepped:
    """``states`` maps a state to its value at the first bar ``e`` and its update."""
    text, source = _levels(list(levels))
    first = "".join(f", ({sql})::DOUBLE AS {name}" for name, (sql, _) in states.items())
    update = "".join(f", {sql}" for _, sql in states.values())
    kept = "".join(f", e.{name}" for name in keep.split())
    once = f"""{START}{text},
chain AS (
  SELECT e.chart_id, e.stock_id, 0 AS k{kept}{first} FROM {source} e WHERE e.rn = 1
  UNION ALL
  SELECT e.chart_id, f.stock_id, f.k + 1{kept}{update}
  FROM chain f JOIN {source} e ON e.stock_id = f.stock_id AND e.rn = f.k + 2),
{_LAST_STEPS.format(id="chart_id", of="stock_id")}
SELECT chart_id, {_lines(lines)} FROM f GROUP BY chart_id"""
    return _stepped(_by_steps(states, lines, text, source, keep), once)


def _by_steps(states, lines, text: str, source: str, keep: str) -> str:
    keep_first = "".join(f", t.{name}" for name in keep.split())
    keep_next = "".join(f", f.{name}" for name in keep.split())
    first = "".join(f", ({sql})::DOUBLE AS {name}" for name, (sql, _) in states.items())
    update = "".join(f", {sql}" for _, sql in states.values())
    return f"""{START}{text},
f AS (
  SELECT t.chart_id, t.stock_id, t.rn - 60 AS first_rn, 0 AS k{keep_first}{first}
  FROM {source} t JOIN {source} e ON e.stock_id = t.stock_id AND e.rn = t.rn - 60
  UNION ALL
  SELECT f.chart_id, f.stock_id, f.first_rn, f.k + 1{keep_next}{update}
  FROM f JOIN {source} e ON e.stock_id = f.stock_id AND e.rn = f.first_rn + f.k + 1
  WHERE f.k < 60)
SELECT chart_id, {_lines(lines)} FROM f GROUP BY chart_id"""


_e20 = ema("e1", "e.c", 20)
_e12 = ema("e1", "e.c", 12)
_e12_2 = ema("e2", _e12, 12)
_pdm = "CASE WHEN h - h1 > l1 - l AND h > h1 THEN h - h1 WHEN h1 IS NOT NULL THEN 0 END"
_mdm = "CASE WHEN l1 - l > h - h1 AND l < l1 THEN l1 - l WHEN h1 IS NOT NULL THEN 0 END"
_aroon = {
    "hs": over("list", "h", 26), "ls": over("list", "l", 26)}
_aroon_up = "100 * (25 - (list_position(list_reverse(hs), list_max(hs)) - 1)) / 25.0::DOUBLE"
_aroon_dn = "100 * (25 - (list_position(list_reverse(ls), list_min(ls)) - 1)) / 25.0::DOUBLE"
_rvi_inputs = (
    {"sd": over("stddev_pop", "c", 10)},
    {"su": "CASE WHEN d > 0 THEN sd ELSE 0 END", "sn": "CASE WHEN d < 0 THEN sd ELSE 0 END"})
_rvi_states = {
    name: ("NULL", f"CASE WHEN f.k + 1 >= 9 THEN {rma(name, x, 14)} END")
    for name, x in (("u", "e.su"), ("n", "e.sn"))}
_rvi = "100 * u / nullif(u + n, 0)"


def _line_end(j: int) -> str:
    inside = f"FILTER (WHERE k BETWEEN {j - 19} AND {j})"
    return (f"(CASE WHEN count({_rvi}) {inside} = 20"
            f" THEN regr_intercept({_rvi}, k::DOUBLE) {inside}"
            f" + {j} * regr_slope({_rvi}, k::DOUBLE) {inside} END)")


_mass = "m1 / nullif(m2, 0)"


def _mass_at(j: int) -> str:
    return f"sum(CASE WHEN k BETWEEN {j - 24} AND {j} THEN {_mass} END)"


def _mean9(at_j) -> str:
    return "(" + " + ".join(at_j(j) for j in range(52, 61)) + ") / 9"


_tsi = {
    "n1": ("NULL", ema("n1", "e.d", 25)), "n2": ("NULL", ema("n2", ema("n1", "e.d", 25), 13)),
    "g1": ("NULL", ema("g1", "e.ad", 25)), "g2": ("NULL", ema("g2", ema("g1", "e.ad", 25), 13))}
_smi_in = (
    {"hh": hi("h", 10), "ll": lo("l", 10)}, {"mo": "c - (hh + ll) / 2", "mr": "hh - ll"})
_smi_a = "CASE WHEN f.k + 1 >= 9 THEN e.mo END"
_smi_b = "CASE WHEN f.k + 1 >= 9 THEN e.mr END"
_smi_v = (f"(100 * ({ema('a2', ema('a1', _smi_a, 3), 3)})"
          f" / nullif(({ema('r2', ema('r1', _smi_b, 3), 3)}) / 2, 0))")
_macd = f"({ema('f1', 'e.c', 12)} - {ema('s1', 'e.c', 26)})"
_dx = (f"(100 * abs({rma('p', 'e.pdm', 14)} - {rma('m', 'e.mdm', 14)})"
       f" / nullif({rma('p', 'e.pdm', 14)} + {rma('m', 'e.mdm', 14)}, 0))")

_net = """,
net AS (SELECT chart_date, row_number() OVER (ORDER BY chart_date) AS dn,
        coalesce(sum(sign(d)), 0)::DOUBLE AS net FROM b2 GROUP BY chart_date)"""


def by_dates(states: dict[str, tuple[str, str]], lines: dict[str, str]) -> Stepped:
    first = "".join(f", {sql} AS {name}" for name, (sql, _) in states.items())
    update = "".join(f", {sql}" for _, sql in states.values())
    once = f"""{START}{_net},
chain AS (
  SELECT e.chart_date, 1 AS one, 0 AS k{first} FROM net e WHERE e.dn = 1
  UNION ALL
  SELECT e.chart_date, 1, f.k + 1{update} FROM chain f JOIN net e ON e.dn = f.k + 2),
{_LAST_STEPS.format(id="chart_date", of="one")},
g AS (SELECT chart_date, {_lines(lines)} FROM f GROUP BY chart_date)
SELECT chart_id, g.* EXCLUDE (chart_date) FROM b2 LEFT JOIN g USING (chart_date) WHERE rn > 60"""
    return _stepped(f"""{START}{_net},
f AS (
  SELECT t.chart_date, t.dn - 60 AS first_dn, 0 AS k{first}
  FROM net t JOIN net e ON e.dn = t.dn - 60
  UNION ALL
  SELECT f.chart_date, f.first_dn, f.k + 1{update}
  FROM f JOIN net e ON e.dn = f.first_dn + f.k + 1 WHERE f.k < 60),
g AS (SELECT chart_date, {_lines(lines)} FROM f GROUP BY chart_date)
SELECT chart_id, g.* EXCLUDE (chart_date) FROM b2 LEFT JOIN g USING (chart_date) WHERE rn > 60""", once)


SQL = {
    "moving_average": by_frames(
        {"단기 이동평균": "x", "중기 이동평균": "y", "장기 이동평균": "z"},
        {"x": avg("c", 5), "y": avg("c", 20), "z": avg("c", 60)}),
    "high_low_average": by_frames(
        {"고가이평": "x", "저가이평": "y"}, {"x": avg("h", 10), "y": avg("l", 10)}),
    "bollinger": by_frames(
        {"Boll 상한선": "m + 2 * s", "Boll 중앙선": "m", "Boll 하한선": "m - 2 * s"},
        {"m": avg("c", 20), "s": over("stddev_pop", "c", 20)}),
    "median_price": by_frames({"중간값": "(h + l) / 2"}),
    "dema": by_steps(
        {"e1": ("e.c", _e20), "e2": ("e.c", ema("e2", _e20, 20))},
        {"DEMA": at("2 * e1 - e2")}),
    "envelope": by_frames(
        {"Env 상한선": "m * 1.06::DOUBLE", "Env 중앙선": "m", "Env 하한선": "m * 0.94::DOUBLE"},
        {"m": avg("c", 20)}),
    "price_channel": by_frames(
        {"P.C 상한선": "x", "하한선": "y", "중앙선": "(x + y) / 2"},
        {"x": hi("h", 20), "y": lo("l", 20)}),
    "projection_bands": by_frames(
        {"Prj 상한선": "greatest(" + ", ".join(f"hl[{14 - i}] + {i} * sh" for i in range(14)) + ")",
         "Prj 하한선": "least(" + ", ".join(f"ll[{14 - i}] + {i} * sl" for i in range(14)) + ")"},
        {"sh": "regr_slope(h, rn::DOUBLE) OVER (w ROWS 13 PRECEDING)",
         "sl": "regr_slope(l, rn::DOUBLE) OVER (w ROWS 13 PRECEDING)",
         "hl": over("list", "h", 14), "ll": over("list", "l", 14)}),
    "typical_price": by_frames({"대표값": "tp"}),
    "vidya": by_steps(
        {"e1": ("e.c",
                f"coalesce(f.e1 + (e.c - f.e1) * (CASE WHEN f.k + 1 >= 9 THEN e.pace END"
                f" * {2 / 13!r}::DOUBLE), e.c)")},
        {"VIDYA": at("e1"), "VIDYA_Signal": mean("e1")},
        {"u9": total("up", 9), "n9": total("dn", 9)},
        {"pace": "CASE WHEN u9 + n9 = 0 THEN 0 ELSE abs(100 * ((u9 - n9) / (u9 + n9))) / 100 END"}),
    "dmi": by_steps(
        {"p": ("NULL", rma("p", "e.pdm", 14)), "m": ("NULL", rma("m", "e.mdm", 14)),
         "r": ("NULL", rma("r", "e.tr", 14)), "adx": ("NULL", rma("adx", _dx, 14))},
        {"+DI": at("100 * p / nullif(r, 0)"), "-DI": at("100 * m / nullif(r, 0)"),
         "ADX": at("adx"), "ADXR": f"({at('adx')} + {at('adx', 46)}) / 2"},
        {"pdm": _pdm, "mdm": _mdm}),
    "aroon": by_frames({"Aroon Up": _aroon_up, "Aroon Down": _aroon_dn}, _aroon),
    "aroon_oscillator": by_frames({"Aroon Osillator": f"{_aroon_up} - {_aroon_dn}"}, _aroon),
    "cci": with_signal(
        "CCI", "(hlc - m) / nullif(0.015::DOUBLE * mad, 0)",
        # three times the typical price: whole numbers, so that no movement is exactly zero
        {"hlc": "h + l + c"}, {"m": avg("hlc", 20), "tps": over("list", "hlc", 20)},
        {"mad": "list_avg(list_transform(tps, lambda t: abs(t - m)))"}),
    "elder_ray": by_steps(
        {"e1": ("e.c", ema("e1", "e.c", 13))},
        {"Bull Power": at("h - e1"), "Bear Power": at("l - e1")}, keep="h l"),
    "force_index": by_steps(
        {"a": ("NULL", ema("a", "e.fi", 2)), "b": ("NULL", ema("b", "e.fi", 13))},
        {"단기 FI": at("a"), "장기 FI": at("b")}, {"fi": "d * v"}),
    "macd": by_steps(
        {"f1": ("e.c", ema("f1", "e.c", 12)), "s1": ("e.c", ema("s1", "e.c", 26)),
         "g": ("0", ema("g", _macd, 9))},
        {"MACD": at("f1 - s1"), "MACD_Signal": at("g"), "MACD_Oscillator": at("f1 - s1 - g")}),
    "mao": with_signal("MAO", "x - y", {"x": avg("c", 5), "y": avg("c", 20)}),
    "mfi": with_signal(
        "MFI", "100 * p / nullif(p + q, 0)",
        {"mp": "CASE WHEN tp1 IS NULL THEN NULL WHEN (h + l + c) / 3 > tp1 THEN tp * v ELSE 0 END",
         "mn": "CASE WHEN tp1 IS NULL THEN NULL WHEN (h + l + c) / 3 < tp1 THEN tp * v ELSE 0 END"},
        {"p": total("mp", 14), "q": total("mn", 14)}),
    "sonar": by_steps(
        {"e1": ("e.c", _e20)},
        {"SONAR": f"{at('e1')} - {at('e1', 51)}",
         "SONAR_Signal": f"{mean('e1')} - {mean('e1', 43, 51)}"}),
    "trix": by_steps(
        {"e1": ("e.c", _e12), "e2": ("e.c", _e12_2), "e3": ("e.c", ema("e3", _e12_2, 12)),
         "e3p": ("NULL", "f.e3")},
        {"TRIX": at("100 * ((e3 - e3p) / nullif(e3p, 0))"),
         "TRIX_Signal": mean("100 * ((e3 - e3p) / nullif(e3p, 0))")}),
    "tsi": by_steps(
        _tsi, {"TSI": at("100 * n2 / nullif(g2, 0)"), "TSI_Signal": mean("100 * n2 / nullif(g2, 0)")}),
    "vhf": with_signal(
        "VHF", "(x - y) / nullif(z, 0)",
        {"x": hi("c", 28), "y": lo("c", 28), "z": total("ad", 28)}),
    "atr": by_steps(
        {"e1": ("NULL", rma("e1", "e.tr", 14))}, {"ATR": at("e1"), "ATR_Signal": mean("e1")}),
    "chaikin_volatility": by_steps(
        {"e1": ("e.h - e.l", ema("e1", "(e.h - e.l)", 10))},
        {"Chaikin's Volatility":
            f"100 * ({at('e1')} - {at('e1', 50)}) / nullif({at('e1', 50)}, 0)"}),
    "rvi": by_steps(_rvi_states, {"RVI": at(_rvi), "RVI_Signal": mean(_rvi)}, *_rvi_inputs),
    "inertia": by_steps(
        _rvi_states, {"Inertia": _line_end(60), "Inertia_Signal": _mean9(_line_end)},
        *_rvi_inputs),
    "disparity": by_frames(
        {f"이격도{i}": f"100 * c / nullif(m{n}, 0)" for i, n in enumerate((5, 10, 20, 60), 1)},
        {f"m{n}": avg("c", n) for n in (5, 10, 20, 60)}),
    "ease_of_movement": by_frames(
        {"EOM": "y", "EOM_Signal": "z"},
        {"em": "((h + l) / 2 - (h1 + l1) / 2) * (h - l) / nullif(v, 0)"},
        {"y": avg("em", 14)}, {"z": avg("y", 9)}),
    "cmo": by_frames(
        {"CMO": "100 * (x - y) / nullif(x + y, 0)"}, {"x": total("up", 14), "y": total("dn", 14)}),
    "mass_index": by_steps(
        {"m1": ("e.h - e.l", ema("m1", "(e.h - e.l)", 9)),
         "m2": ("e.h - e.l", ema("m2", ema("m1", "(e.h - e.l)", 9), 9))},
        {"Mass Index": _mass_at(60), "Mass Index_Signal": _mean9(_mass_at)}),
    "momentum": with_signal("Momentum", "100 * c / nullif(c10, 0)"),
    "nvi": by_steps(
        {"e1": ("1000", "f.e1 * (1 + e.q)")}, {"NVI": at("e1"), "NVI_Signal": mean("e1")},
        {"q": "CASE WHEN v < v1 THEN coalesce(d / nullif(c1, 0), 0) ELSE 0 END"}),
    "rsi": by_steps(
        {"u": ("NULL", rma("u", "e.up", 14)), "n": ("NULL", rma("n", "e.dn", 14))},
        {"RSI": at("100 * u / nullif(u + n, 0)"), "RSI_Signal": mean("100 * u / nullif(u + n, 0)")}),
    "smi": by_steps(
        {"a1": ("NULL", ema("a1", _smi_a, 3)), "a2": ("NULL", ema("a2", ema("a1", _smi_a, 3), 3)),
         "r1": ("NULL", ema("r1", _smi_b, 3)), "r2": ("NULL", ema("r2", ema("r1", _smi_b, 3), 3)),
         "g": ("NULL", ema("g", _smi_v, 3))},
        {"SMI": at("100 * a2 / nullif(r2 / 2, 0)"), "SMI_Signal": at("g")}, *_smi_in),
    "stochastic_fast": by_frames(
        {"Fast %K": "k", "Fast %D": "kd"},
        {"x": hi("h", 5), "y": lo("l", 5)}, {"k": "100 * (c - y) / nullif(x - y, 0)"},
        {"kd": avg("k", 3)}),
    "stochastic_slow": by_frames(
        {"Slow %K": "sk", "Slow %D": "sd"},
        {"x": hi("h", 5), "y": lo("l", 5)}, {"k": "100 * (c - y) / nullif(x - y, 0)"},
        {"sk": avg("k", 3)}, {"sd": avg("sk", 3)}),
    "ultimate": with_signal(
        "UOSC", "100 * (4 * b7 / nullif(t7, 0) + 2 * b14 / nullif(t14, 0) + b28 / nullif(t28, 0)) / 7",
        {"bp": "CASE WHEN c1 IS NOT NULL THEN c - least(l, c1) END"},
        {**{f"b{n}": total("bp", n) for n in (7, 14, 28)},
         **{f"t{n}": total("tr", n) for n in (7, 14, 28)}}),
    "chaikin_money_flow": by_frames(
        {"Chaikin's Money Flow": "x / nullif(y, 0)"},
        {"mf": "coalesce(((c - l) - (h - c)) / nullif(h - l, 0), 0) * v"},
        {"x": total("mf", 21), "y": total("v", 21)}),
    "williams_ad": by_steps(
        {"e1": ("0", "f.e1 + e.ws")},
        {"Williams Accumulation Distribution": at("e1"),
         "Williams Accumulation Distribution_Signal": mean("e1")},
        {"ws": "CASE WHEN c > c1 THEN c - least(l, c1) WHEN c < c1 THEN c - greatest(h, c1)"
               " WHEN c1 IS NOT NULL THEN 0 END"}),
    "volume_oscillator": with_signal(
        "VO", "100 * (x - y) / nullif(y, 0)", {"x": avg("v", 5), "y": avg("v", 10)}),
    "ad_line": by_dates(
        {"e1": ("e.net", "f.e1 + e.net")}, {"A/D Line": at("e1"), "A/D Line_Signal": mean("e1")}),
    "mcclellan": by_dates(
        {"a": ("e.net", ema("a", "e.net", 19)), "b": ("e.net", ema("b", "e.net", 39))},
        {"McCellan Oscillator": at("a - b")}),
}
