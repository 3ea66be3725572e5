"""The indicator families: their lines and how each line is computed.

Formulas are the published standard ones; every length and smoothing constant is a module
constant or stands in the formula. A zero denominator gives null.

A family names the columns it reads and is called with their values as arrays of shape (position
in the slice, slice), so one call computes many bars. It returns one array per line, of
which the last ``keep`` positions count. Recursions start at the first bar of the slice, so that
a value depends on that slice alone and not on how the history was loaded; ``keep`` is a
:class:`Run`, which lets them go on where a part of a long slice was computed before. What looks at the last n bars is taken over views of the arrays, which hold no
copies; a missing value among them leaves the line empty.
"""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

from ohlcraft.operators.indicators.columns import Columns

SIGNAL = 9

# fixed values: the line names of each indicator family, in line order
LINE_NAMES = {
    "이동평균(라인3개)": ("단기 이동평균", "중기 이동평균", "장기 이동평균"),
    "고저이동평균": ("고가이평", "저가이평"),
    "Bollinger Band": ("Boll 상한선", "Boll 중앙선", "Boll 하한선"),
    "중간값(Median Price)": ("중간값",),
    "DEMA": ("DEMA",),
    "Envelope": ("Env 상한선", "Env 중앙선", "Env 하한선"),
    "Price Channel": ("P.C 상한선", "하한선", "중앙선"),
    "Projection Bands": ("Prj 상한선", "Prj 하한선"),
    "대표값(Typical Price)": ("대표값",),
    "VIDYA": ("VIDYA", "VIDYA_Signal"),
    "DMI": ("+DI", "-DI", "ADX", "ADXR"),
    "Aroon": ("Aroon Up", "Aroon Down"),
    "Aroon Osillator": ("Aroon Osillator",),
    "CCI": ("CCI", "CCI_Signal"),
    "Elder-Ray": ("Bull Power", "Bear Power"),
    "Force Index": ("단기 FI", "장기 FI"),
    "MACD": ("MACD", "MACD_Signal", "MACD_Oscillator"),
    "MAO": ("MAO", "MAO_Signal"),
    "MFI": ("MFI", "MFI_Signal"),
    "SONAR": ("SONAR", "SONAR_Signal"),
    "TRIX": ("TRIX", "TRIX_Signal"),
    "TSI": ("TSI", "TSI_Signal"),
    "VHF": ("VHF", "VHF_Signal"),
    "ATR": ("ATR", "ATR_Signal"),
    "Chaikin's Volatility": ("Chaikin's Volatility",),
    "Relative Volatility Index": ("RVI", "RVI_Signal"),
    "Inertia": ("Inertia", "Inertia_Signal"),
    "이격도": ("이격도1", "이격도2", "이격도3", "이격도4"),
    "Ease of Movement": ("EOM", "EOM_Signal"),
    "Chande Momentum Oscillator": ("CMO",),
    "Mass Index": ("Mass Index", "Mass Index_Signal"),
    "Momentum": ("Momentum", "Momentum_Signal"),
    "Negative Volume Index": ("NVI", "NVI_Signal"),
    "RSI": ("RSI", "RSI_Signal"),
    "SMI": ("SMI", "SMI_Signal"),
    "Stochastic Fast": ("Fast %K", "Fast %D"),
    "Stochastic Slow": ("Slow %K", "Slow %D"),
    "Ultimate Oscillator": ("UOSC", "UOSC_Signal"),
    "Chaikin's Money Flow": ("Chaikin's Money Flow",),
    "Williams Accumulation Distribution": (
        "Williams Accumulation Distribution", "Williams Accumulation Distribution_Signal"),
    "Volume Oscillator": ("VO", "VO_Signal"),
    "A/D Line": ("A/D Line", "A/D Line_Signal"),
    "McCellan Oscillator": ("McCellan Oscillator",),
}


def line_name(family: str, i: int) -> str:
    """Name of a family's line number ``i``; one without a name is called after both."""
    lines = LINE_NAMES.get(family, ())
    return lines[i] if 0 <= i < len(lines) else f"{family}_{i}"


@dataclass(frozen=True)
class Family:
    key: str
    name: str
    inputs: Callable[[Columns], list[str]]
    slice_lines: Callable[..., list[np.ndarray]]
    by_date: bool = False
    #: Whether the lines depend on nothing but the last bars, so that no recursion is needed.
    framed: bool = False


FAMILIES: dict[str, Family] = {}


def _slices(key: str, name: str, inputs, by_date: bool = False, framed: bool = False):
    def register(lines):
        FAMILIES[name] = Family(key, name, inputs, lines, by_date, framed)
        return lines
    return register


def _frames(key: str, name: str, inputs):
    return _slices(key, name, inputs, framed=True)


def _ratio(num: str, den: str) -> str:
    return f"try_divide(CAST({num} AS DOUBLE), CAST({den} AS DOUBLE))"


# -- shared per-bar quantities --------------------------------------------------------

def _change(t: Columns, x: str = "c") -> str:
    return t.let(f"{x}_change", f"{x} - {t.lag(x)}")


def _gain(t: Columns) -> str:
    d = _change(t)
    return t.let("gain", f"if({d} > 0, {d}, {d} * 0)")


def _loss(t: Columns) -> str:
    d = _change(t)
    return t.let("loss", f"if({d} < 0, -{d}, {d} * 0)")


def _move(t: Columns) -> str:
    return t.let("move", f"abs({_change(t)})")


def _true_range(t: Columns) -> str:
    c1 = t.lag("c")
    return t.let(
        "true_range",
        f"if({c1} IS NULL, NULL, greatest(h - l, abs(h - {c1}), abs(l - {c1})))")


def _price_sum(t: Columns) -> str:
    return t.let("price_sum", "h + l + c")


def _bar_range(t: Columns) -> str:
    return t.let("bar_range", "h - l")


# -- array steps ----------------------------------------------------------------------

class Run(int):
    """How many positions at the end count, and how to go on where an earlier run of the same slice
    stopped.

    The arrays of a run that goes on begin at position ``passed`` of the slice. Its recursions
    begin ``edge`` positions later, from the values in ``before``; the positions ahead are there for
    frames. ``left`` gets the recursions' values, in the order of their calls, ``tail``
    positions before the last.
    """

    def __new__(cls, keep: int, before: list[np.ndarray] | None = None, edge: int = 0, passed: int = 0, tail: int = 0):
        run = super().__new__(cls, keep)
        run.before, run.edge, run.passed, run.tail, run.left = before, edge, passed, tail, []
        return run

    def recursion(self, x: np.ndarray, first: Callable, step: Callable) -> np.ndarray:
        """``out[0] = first()`` and ``out[k] = step(k, out[k - 1])``, or on from where it stopped."""
        out = np.full(x.shape, np.nan)
        if self.before is None:
            out[0], start = first(), 1
        else:
            start = self.edge
            out[start] = step(start, self.before[len(self.left)])
            start += 1
        for k in range(start, len(x)):
            out[k] = step(k, out[k - 1])
        self.left.append(out[len(x) - 1 - self.tail].copy())
        return out


def _since(run: Run, k: int, x: np.ndarray) -> np.ndarray:
    """``x`` without the first ``k`` positions of the slice, whose values look back out of it."""
    known = x.copy()
    known[:max(0, k - run.passed)] = np.nan
    return known


def _smooth(run: Run, x: np.ndarray, weight) -> np.ndarray:
    """Exponential smoothing that starts at the first value of ``x``; ``weight`` may vary."""
    weights = np.broadcast_to(weight, x.shape)
    missing = np.isnan(x) | np.isnan(weights)
    gaps = missing.any(axis=1)

    def step(k: int, before: np.ndarray) -> np.ndarray:
        value = before + (x[k] - before) * weights[k]
        if gaps[k] or k == run.edge or gaps[k - 1]:
            value = np.where(np.isnan(value), x[k], value)
        return value

    return run.recursion(x, lambda: x[0], step)


def _ema(run: Run, x: np.ndarray, n: int) -> np.ndarray:
    return _smooth(run, x, 2 / (n + 1))


def _wilder(run: Run, x: np.ndarray, n: int) -> np.ndarray:
    return _smooth(run, x, 1 / n)


def _quotient(num: np.ndarray, den: np.ndarray) -> np.ndarray:
    return np.divide(num, den, out=np.full_like(den, np.nan), where=den != 0)


def _trailing(x: np.ndarray, weights, keep: int) -> np.ndarray:
    """Weighted sum of the newest values at each of the last ``keep`` positions; the first
    weight is the newest value's."""
    n = len(x)
    return sum(w * x[n - keep - i:n - i] for i, w in enumerate(weights))


def _last(x: np.ndarray, keep: int, back: int = 0) -> np.ndarray:
    """The last ``keep`` positions, or those ``back`` before them."""
    return x[len(x) - keep - back:len(x) - back]


def _views(x: np.ndarray, n: int, keep: int) -> np.ndarray:
    """The last n values, oldest first, at each of the last ``keep`` positions: an array of
    shape (n, keep, slices) that shares the memory of ``x``."""
    return np.moveaxis(sliding_window_view(x[len(x) - keep - n + 1:], n, axis=0), -1, 0)


def _sum(x: np.ndarray, n: int, keep: int) -> np.ndarray:
    return _views(x, n, keep).sum(axis=0)


def _mean(x: np.ndarray, n: int, keep: int) -> np.ndarray:
    return _views(x, n, keep).sum(axis=0) / n


def _highest(x: np.ndarray, n: int, keep: int) -> np.ndarray:
    return _views(x, n, keep).max(axis=0)


def _lowest(x: np.ndarray, n: int, keep: int) -> np.ndarray:
    return _views(x, n, keep).min(axis=0)


def _spread(x: np.ndarray, n: int, keep: int) -> np.ndarray:
    return _views(x, n, keep).std(axis=0)


def _full(frame, x: np.ndarray, n: int) -> np.ndarray:
    """A frame at all positions, empty at the first ones that have fewer values."""
    found = np.full_like(x, np.nan)
    found[n - 1:] = frame(x, n, len(x) - n + 1)
    return found


def _with_signal(value: np.ndarray, keep: int) -> list[np.ndarray]:
    """A line of ``keep + SIGNAL - 1`` positions, and its mean."""
    return [value, _signal(value, keep)]


def _chande(gain: np.ndarray, loss: np.ndarray, n: int, keep: int) -> np.ndarray:
    up, down = _sum(gain, n, keep), _sum(loss, n, keep)
    return 100 * _quotient(up - down, up + down)


def _fast_k(h: np.ndarray, l: np.ndarray, c: np.ndarray, keep: int) -> np.ndarray:
    low, high = _lowest(l, 5, keep), _highest(h, 5, keep)
    return 100 * _quotient(_last(c, keep) - low, high - low)


def _signal(x: np.ndarray, keep: int) -> np.ndarray:
    return _trailing(x, [1.0] * SIGNAL, keep) / SIGNAL


def _cumulated(run: Run, step: np.ndarray, first: Callable) -> np.ndarray:
    """Running sum that starts with ``first()`` at the first position."""
    return run.recursion(step, first, lambda k, before: before + step[k])


# -- price ----------------------------------------------------------------------------

@_frames("moving_average", "이동평균(라인3개)", lambda t: ["c"])
def _(keep, c):
    return [_mean(c, n, keep) for n in (5, 20, 60)]


@_frames("high_low_average", "고저이동평균", lambda t: ["h", "l"])
def _(keep, h, l):
    return [_mean(h, 10, keep), _mean(l, 10, keep)]


@_frames("bollinger", "Bollinger Band", lambda t: ["c"])
def _(keep, c):
    middle, width = _mean(c, 20, keep), _spread(c, 20, keep)
    return [middle + 2 * width, middle, middle - 2 * width]


@_frames("median_price", "중간값(Median Price)", lambda t: ["h", "l"])
def _(keep, h, l):
    return [(h + l) / 2]


@_slices("dema", "DEMA", lambda t: ["c"])
def _(keep, c):
    once = _ema(keep, c, 20)
    return [2 * once - _ema(keep, once, 20)]


@_frames("envelope", "Envelope", lambda t: ["c"])
def _(keep, c):
    middle = _mean(c, 20, keep)
    return [middle * 1.06, middle, middle * 0.94]


@_frames("price_channel", "Price Channel", lambda t: ["h", "l"])
def _(keep, h, l):
    upper, lower = _highest(h, 20, keep), _lowest(l, 20, keep)
    return [upper, lower, (upper + lower) / 2]


@_frames("projection_bands", "Projection Bands", lambda t: ["h", "l"])
def _(keep, h, l):
    n = 14
    at = np.arange(n).reshape(-1, 1, 1)

    def projected(x: np.ndarray) -> np.ndarray:
        # least-squares slope over n consecutive rows, in whole numbers up to the division
        views = _views(x, n, keep)
        slope = ((2 * at - n + 1) * views).sum(axis=0) / (n * (n * n - 1) / 6)
        return views + (n - 1 - at) * slope

    return [projected(h).max(axis=0), projected(l).min(axis=0)]


@_frames("typical_price", "대표값(Typical Price)", lambda t: [_price_sum(t)])
def _(keep, price):
    return [price / 3]


@_slices("vidya", "VIDYA", lambda t: ["c", _gain(t), _loss(t)])
def _(keep, c, gain, loss):
    n = 9
    up, down = _full(_sum, gain, n), _full(_sum, loss, n)
    # no movement at all leaves the average where it is
    pace = np.where(up + down == 0, 0, abs(_quotient(up - down, up + down)))
    value = _smooth(keep, c, _since(keep, n, pace) * (2 / 13))
    return [value, _signal(value, keep)]


# -- trend ----------------------------------------------------------------------------

def _dmi_inputs(t: Columns) -> list[str]:
    rise, fall = _change(t, "h"), _change(t, "l")
    plus = t.let("plus_move", f"if({rise} > -{fall} AND {rise} > 0, {rise}, {rise} * 0)")
    minus = t.let("minus_move", f"if(-{fall} > {rise} AND {fall} < 0, -{fall}, {fall} * 0)")
    return [plus, minus, _true_range(t)]


@_slices("dmi", "DMI", _dmi_inputs)
def _(keep, plus, minus, reach):
    p, m, r = (_wilder(keep, _since(keep, 1, x), 14) for x in (plus, minus, reach))
    adx = _wilder(keep, 100 * _quotient(abs(p - m), p + m), 14)
    earlier = np.roll(adx, 14, axis=0)
    return [100 * _quotient(p, r), 100 * _quotient(m, r), adx, (adx + earlier) / 2]


def _aroon(h: np.ndarray, l: np.ndarray, keep: int) -> list[np.ndarray]:
    n = 25

    def line(x: np.ndarray, newest) -> np.ndarray:
        # the newest of equal extremes counts
        views = _views(x, n + 1, keep)[::-1]
        return np.where(np.isnan(views).any(axis=0), np.nan, 100 * (n - newest(views, axis=0)) / n)

    return [line(h, np.argmax), line(l, np.argmin)]


@_frames("aroon", "Aroon", lambda t: ["h", "l"])
def _(keep, h, l):
    return _aroon(h, l, keep)


@_frames("aroon_oscillator", "Aroon Osillator", lambda t: ["h", "l"])
def _(keep, h, l):
    up, down = _aroon(h, l, keep)
    return [up - down]


@_frames("cci", "CCI", lambda t: [_price_sum(t)])
def _(keep, price):
    n, keep_value = 20, keep + SIGNAL - 1
    mean = _mean(price, n, keep_value)
    spread = abs(_views(price, n, keep_value) - mean).sum(axis=0) / n
    return _with_signal(_quotient(_last(price, keep_value) - mean, 0.015 * spread), keep)


@_slices("elder_ray", "Elder-Ray", lambda t: ["h", "l", "c"])
def _(keep, h, l, c):
    average = _ema(keep, c, 13)
    return [h - average, l - average]


@_slices("force_index", "Force Index", lambda t: [t.let("force", f"{_change(t)} * v")])
def _(keep, force):
    return [_ema(keep, _since(keep, 1, force), n) for n in (2, 13)]


@_slices("macd", "MACD", lambda t: ["c"])
def _(keep, c):
    macd = _ema(keep, c, 12) - _ema(keep, c, 26)
    signal = _ema(keep, macd, 9)
    return [macd, signal, macd - signal]


@_frames("mao", "MAO", lambda t: ["c"])
def _(keep, c):
    short, long = (_mean(c, n, keep + SIGNAL - 1) for n in (5, 20))
    return _with_signal(short - long, keep)


def _mfi_inputs(t: Columns) -> list[str]:
    price = _price_sum(t)
    change = _change(t, price)
    return [t.let("flow_in", f"if({change} > 0, {price} * v, {change} * 0)"),
            t.let("flow_out", f"if({change} < 0, {price} * v, {change} * 0)")]


@_frames("mfi", "MFI", _mfi_inputs)
def _(keep, flow_in, flow_out):
    gained, lost = (_sum(x, 14, keep + SIGNAL - 1) for x in (flow_in, flow_out))
    return _with_signal(100 * _quotient(gained, gained + lost), keep)


@_slices("sonar", "SONAR", lambda t: ["c"])
def _(keep, c):
    average = _ema(keep, c, 20)
    value = average - np.roll(average, 9, axis=0)
    return [value, _signal(value, keep)]


@_slices("trix", "TRIX", lambda t: ["c"])
def _(keep, c):
    third = _ema(keep, _ema(keep, _ema(keep, c, 12), 12), 12)
    earlier = np.roll(third, 1, axis=0)
    value = 100 * _quotient(third - earlier, earlier)
    return [value, _signal(value, keep)]


@_slices("tsi", "TSI", lambda t: [_change(t), _move(t)])
def _(keep, change, move):
    net, gross = (_ema(keep, _ema(keep, _since(keep, 1, x), 25), 13) for x in (change, move))
    value = 100 * _quotient(net, gross)
    return [value, _signal(value, keep)]


@_frames("vhf", "VHF", lambda t: ["c", _move(t)])
def _(keep, c, move):
    n, keep_value = 28, keep + SIGNAL - 1
    reach = _highest(c, n, keep_value) - _lowest(c, n, keep_value)
    return _with_signal(_quotient(reach, _sum(move, n, keep_value)), keep)


# -- volatility -----------------------------------------------------------------------

@_slices("atr", "ATR", lambda t: [_true_range(t)])
def _(keep, reach):
    value = _wilder(keep, _since(keep, 1, reach), 14)
    return [value, _signal(value, keep)]


@_slices("chaikin_volatility", "Chaikin's Volatility", lambda t: [_bar_range(t)])
def _(keep, reach):
    average = _ema(keep, reach, 10)
    earlier = np.roll(average, 10, axis=0)
    return [100 * _quotient(average - earlier, earlier)]


def _relative_volatility(keep: Run, c: np.ndarray, change: np.ndarray) -> np.ndarray:
    spread = _full(_spread, c, 10)
    up, down = (_wilder(keep, _since(keep, 9, np.where(moved, spread, 0)), 14) for moved in (change > 0, change < 0))
    return 100 * _quotient(up, up + down)


@_slices("rvi", "Relative Volatility Index", lambda t: ["c", _change(t)])
def _(keep, c, change):
    value = _relative_volatility(keep, c, change)
    return [value, _signal(value, keep)]


def _end_point_weights(n: int) -> list[float]:
    """Weights, newest first, that give the end of a least-squares line through n values."""
    middle = (n - 1) / 2
    squares = n * (n * n - 1) / 12
    return [1 / n + (middle - i) * middle / squares for i in range(n)]


@_slices("inertia", "Inertia", lambda t: ["c", _change(t)])
def _(keep, c, change):
    value = _trailing(
        _relative_volatility(keep, c, change), _end_point_weights(20), keep + SIGNAL - 1)
    return [value, _signal(value, keep)]


# -- momentum -------------------------------------------------------------------------

@_frames("disparity", "이격도", lambda t: ["c"])
def _(keep, c):
    return [100 * _quotient(_last(c, keep), _mean(c, n, keep)) for n in (5, 10, 20, 60)]


def _ease_inputs(t: Columns) -> list[str]:
    middle = _change(t, t.let("high_plus_low", "h + l"))
    return [t.let("ease", _ratio(f"{middle} * (h - l)", "2 * v"))]


@_frames("ease_of_movement", "Ease of Movement", _ease_inputs)
def _(keep, ease):
    return _with_signal(_mean(ease, 14, keep + SIGNAL - 1), keep)


@_frames("cmo", "Chande Momentum Oscillator", lambda t: [_gain(t), _loss(t)])
def _(keep, gain, loss):
    return [_chande(gain, loss, 14, keep)]


@_slices("mass_index", "Mass Index", lambda t: [_bar_range(t)])
def _(keep, reach):
    once = _ema(keep, reach, 9)
    value = _trailing(_quotient(once, _ema(keep, once, 9)), [1.0] * 25, keep + SIGNAL - 1)
    return [value, _signal(value, keep)]


@_frames("momentum", "Momentum", lambda t: ["c"])
def _(keep, c):
    keep_value = keep + SIGNAL - 1
    return _with_signal(100 * _quotient(_last(c, keep_value), _last(c, keep_value, 10)), keep)


def _nvi_inputs(t: Columns) -> list[str]:
    share = _ratio(_change(t), t.lag("c"))
    return [t.let("quiet_change", f"if({_change(t, 'v')} < 0, coalesce({share}, 0D), 0D)")]


@_slices("nvi", "Negative Volume Index", _nvi_inputs)
def _(keep, change):
    value = keep.recursion(change, lambda: np.full(change.shape[1], 1000.0), lambda k, before: before * (1 + change[k]))
    return [value, _signal(value, keep)]


@_slices("rsi", "RSI", lambda t: [_gain(t), _loss(t)])
def _(keep, gain, loss):
    up, down = (_wilder(keep, _since(keep, 1, x), 14) for x in (gain, loss))
    value = 100 * _quotient(up, up + down)
    return [value, _signal(value, keep)]


@_slices("smi", "SMI", lambda t: ["h", "l", "c"])
def _(keep, h, l, c):
    high, low = _full(_highest, h, 10), _full(_lowest, l, 10)
    num, den = (_ema(keep, _ema(keep, _since(keep, 9, x), 3), 3) for x in (c - (high + low) / 2, high - low))
    value = 100 * _quotient(num, den / 2)
    return [value, _ema(keep, value, 3)]


@_frames("stochastic_fast", "Stochastic Fast", lambda t: ["h", "l", "c"])
def _(keep, h, l, c):
    value = _fast_k(h, l, c, keep + 2)
    return [value, _mean(value, 3, keep)]


@_frames("stochastic_slow", "Stochastic Slow", lambda t: ["h", "l", "c"])
def _(keep, h, l, c):
    slow = _mean(_fast_k(h, l, c, keep + 4), 3, keep + 2)
    return [slow, _mean(slow, 3, keep)]


def _ultimate_inputs(t: Columns) -> list[str]:
    pressure = t.let("pressure", f"if({t.lag('c')} IS NULL, NULL, c - least(l, {t.lag('c')}))")
    return [pressure, _true_range(t)]


@_frames("ultimate", "Ultimate Oscillator", _ultimate_inputs)
def _(keep, pressure, reach):
    keep_value = keep + SIGNAL - 1
    week, two, four = (
        _quotient(_sum(pressure, n, keep_value), _sum(reach, n, keep_value)) for n in (7, 14, 28))
    return _with_signal(100 * (4 * week + 2 * two + four) / 7, keep)


# -- volume ---------------------------------------------------------------------------

def _money_flow_inputs(t: Columns) -> list[str]:
    # a bar without a range moves no money either way
    return [t.let("money_flow", "if(h = l, 0D, (2 * c - l - h) * v / (h - l))"), "v"]


@_frames("chaikin_money_flow", "Chaikin's Money Flow", _money_flow_inputs)
def _(keep, flow, v):
    return [_quotient(_sum(flow, 21, keep), _sum(v, 21, keep))]


def _williams_inputs(t: Columns) -> list[str]:
    d, c1 = _change(t), t.lag("c")
    return [t.let(
        "williams_step",
        f"CASE WHEN {d} > 0 THEN c - least(l, {c1}) WHEN {d} < 0 THEN c - greatest(h, {c1})"
        f" WHEN {d} = 0 THEN 0 END")]


@_slices("williams_ad", "Williams Accumulation Distribution", _williams_inputs)
def _(keep, step):
    value = _cumulated(keep, step, lambda: np.zeros(step.shape[1]))
    return [value, _signal(value, keep)]


@_frames("volume_oscillator", "Volume Oscillator", lambda t: ["v"])
def _(keep, v):
    short, long = (_mean(v, n, keep + SIGNAL - 1) for n in (5, 10))
    return _with_signal(100 * _quotient(short - long, long), keep)


# -- breadth: over dates, ``net`` is advancing minus declining stocks of a date --------

@_slices("ad_line", "A/D Line", lambda t: ["net"], by_date=True)
def _(keep, net):
    value = _cumulated(keep, net, lambda: net[0])
    return [value, _signal(value, keep)]


@_slices("mcclellan", "McCellan Oscillator", lambda t: ["net"], by_date=True)
def _(keep, net):
    return [_ema(keep, net, 19) - _ema(keep, net, 39)]


def _check_names() -> None:
    names = [line for family in FAMILIES for line in LINE_NAMES[family]]
    assert len(names) == len(set(names)), "two indicator lines share a name"


_check_names()
