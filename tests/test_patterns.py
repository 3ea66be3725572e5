"""Patterns against a bar-by-bar check in plain numbers, and their properties."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ohlcraft.operators import detect
from ohlcraft.operators.patterns import PATTERNS

KIND = ("chart_id long, stock_id long, chart_date date, chart_open long, chart_high long,"
        " chart_low long, chart_close long")
FIRST = dt.date(2020, 1, 1)


def _frame(spark, series):
    rows = [
        (stock * 10_000 + i, stock, FIRST + dt.timedelta(days=i), *bar)
        for stock, bars in series.items() for i, bar in enumerate(bars)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, KIND)


def _hits(frame, **options):
    return {(r.chart_id, r.pattern_id) for r in detect.detect_patterns(frame, **options).collect()}


class _Bar:
    """A stock seen from row t; missing prices and rows are NaN, which no comparison meets."""

    def __init__(self, table, t):
        self.table, self.t = table, t

    def __getattr__(self, name):
        column = "ohlc".index(name)
        return lambda k=0: self.table[self.t - k][column] if self.t >= k else np.float64("nan")

    def body(self, k=0):
        return abs(self.o(k) - self.c(k))

    def top(self, k=0):
        return np.fmax(self.o(k), self.c(k))

    def bot(self, k=0):
        return np.fmin(self.o(k), self.c(k))

    def span(self, k=0):
        return self.h(k) - self.l(k)

    def trend(self, sign, k=0):
        closes = [self.c(k + i) * sign for i in range(10)]
        return sum(closes[:5]) / 5 > sum(closes) / 10 and min(closes[:5]) >= closes[9] \
            and not np.isnan(sum(closes))

    def doji(self, k=0):
        return self.body(k) < self.span(k) * 0.05

    def dojis(self):
        return sum(bool(self.doji(k)) for k in range(20))

    def gap(self, sign, k=0):
        return self.l(k) > self.h(k + 1) if sign > 0 else self.h(k) < self.l(k + 1)

    def gain(self, sign, k=0):
        return sign * (self.c(k) - self.o(k))


def _star(b, s, share):
    near, far = (b.bot(1), b.top(2)) if s > 0 else (-b.top(1), -b.bot(2))
    return (b.trend(s, 2) and b.gain(s, 2) > 0 and b.gain(s, 2) / b.o(2) >= .03
            and b.body(1) < b.span(1) * share and near > far and b.gain(-s) > 0
            and s * (b.c(2) - b.c()) / b.gain(s, 2) >= .5)


def _harami(b, s, share):
    usual = sum(b.body(k) for k in range(2, 22)) / 20
    return (b.trend(s, 2) and b.body(1) >= usual * 1.5 and b.body() < b.span() * share
            and b.top() <= b.top(1) and b.bot() >= b.bot(1))


def _play(b, s):
    def fits(k):
        half = b.body(k) / 2
        return (b.gain(s, k) > 0 and b.body(k) >= 3 * np.fmax.reduce([b.body(i) for i in range(1, k)])
                and not any(b.top(i) > b.o(k) + half or b.bot(i) < b.o(k) - half for i in range(1, k)))
    return b.gap(s) and any(fits(k) for k in range(5, 9))


def _methods(b, s):
    def fits(k):
        small = 3 * np.fmax.reduce([b.body(i) for i in range(1, k)])
        return (b.gain(s, k) > 0 and b.gain(s) > 0 and b.gain(s, k) >= small and b.gain(s) >= small
                and s * b.c() > s * b.c(k) and s * b.o() > s * b.o(k))
    return any(fits(k) for k in range(3, 6))


def _near_open(b):
    return .9 * b.o(1) <= b.o() <= 1.1 * b.o(1)


def _extreme(b, s):
    side = b.h if s > 0 else b.l
    pick = np.fmax if s > 0 else np.fmin
    return any(s * side(k) > s * pick.reduce([side(k + i) for i in range(1, 21)]) for k in range(3))


def _expected(b):
    mid = (b.o() + b.c()) / 2
    for s, pin, tail, engulf in ((-1, 1, 12, 3), (1, 2, 11, 4)):
        yield pin, b.trend(s) and b.body() <= b.span() / 3 and b.bot() - b.l() >= 2 * b.body()
        yield tail, (b.trend(s, 1) and b.body() < b.span() * .3 and b.h() - b.top() > 2 * b.body()
                     and b.bot() - b.l() < .1 * b.body())
        yield engulf, (b.trend(s) and b.gain(s, 1) > 0 and b.gain(-s) > 0
                       and s * b.c() < s * b.o(1) and s * b.o() > s * b.c(1))
    for s, star, doji_star, harami, cross in ((-1, 7, 9, 14, 16), (1, 8, 10, 13, 15)):
        yield star, _star(b, s, .3)
        yield doji_star, _star(b, s, .1)
        yield harami, _harami(b, s, .3)
        yield cross, _harami(b, s, .1)
    yield 17, b.trend(-1) and abs(b.l() - b.l(1)) <= b.l() * .001 and b.body() <= b.body(1) * .5
    yield 18, b.trend(1) and abs(b.h() - b.h(1)) <= b.h() * .001 and b.body() <= b.body(1) * .5
    yield 19, (b.trend(-1) and abs(b.o() - b.l()) <= b.l() * .001
               and abs(b.c() - b.h()) <= b.h() * .001 and b.gain(1) / b.o() >= .03)
    yield 20, (b.trend(1) and abs(b.h() - b.o()) <= b.o() * .001
               and abs(b.l() - b.c()) <= b.c() * .001 and b.gain(-1) / b.o() >= .03)
    yield 21, (b.trend(1, 2) and b.gain(1, 2) > 0 and b.gain(-1, 1) > 0 and b.gain(-1) > 0
               and b.h(2) < b.o(1) and b.h(2) < b.o() and b.o() > b.o(1) and b.c() < b.c(1))
    yield 22, (all(b.gain(-1, k) > 0 and abs(b.l(k) - b.c(k)) <= b.c() * .1 for k in range(3))
               and b.c(1) < b.o() < b.o(1) and b.c(2) < b.o(1) < b.o(2))
    yield 23, (all(b.gain(1, k) > 0 and b.gain(1, k) / b.o(k) >= .03
                   and abs(b.h(k) - b.c(k)) <= b.c(k) * .1 for k in range(3))
               and all(b.o(k + 1) * .98 < b.o(k) < b.c(k + 1) * 1.02 for k in range(2)))
    for s, i in ((-1, 26), (1, 27)):
        yield i, (b.trend(s, 1) and b.gain(s, 1) / b.o(1) >= .03 and b.gain(-s) > 0
                  and s * ((b.o() - b.c(1)) / b.c(1)) >= .02
                  and abs(b.c() - b.c(1)) <= b.body(1) * .1)
    for s, window, tasuki, play, side, methods, lines in (
            (1, 32, 34, 36, 38, 40, 42), (-1, 33, 35, 37, 39, 41, 43)):
        yield window, b.gap(s)
        edge = b.h(2) if s > 0 else b.l(2)
        yield tasuki, (b.gap(s, 1) and b.gain(s, 1) > 0 and b.gain(-s) > 0
                       and .9 * b.body(1) <= b.body() <= 1.1 * b.body(1) and s * b.c() > s * edge)
        yield play, _play(b, s)
        yield side, (b.gap(s, 2) and b.gain(s, 1) > 0 and b.gain(s) > 0 and _near_open(b)
                     and .5 * b.gain(s, 1) <= b.gain(s) <= 2 * b.gain(s, 1))
        yield methods, _methods(b, s)
        yield lines, b.trend(s) and b.gain(-s, 1) > 0 and b.gain(s) > 0 and _near_open(b)
    rare = b.doji() and b.dojis() < 5
    yield 44, b.trend(1) and rare
    yield 45, b.trend(-1) and rare and b.l() + b.span() / 3 <= mid <= b.h() - b.span() / 3
    yield 46, b.trend(-1) and rare and mid <= b.l() + b.span() / 4
    yield 47, b.trend(1) and rare and mid >= b.h() - b.span() / 4
    three = all(b.doji(k) for k in range(3)) and b.dojis() < 6
    yield 48, three and _extreme(b, -1)
    yield 49, three and _extreme(b, 1)


def _random_series(seed, n=260):
    """A rough walk with flat, halted and incomplete bars and runs of a trend."""
    rng = random.Random(seed)
    price, drift, bars = rng.randint(80, 400), 0, []
    for i in range(n):
        if i % 12 == 0:
            drift = rng.choice((-6, -2, 0, 2, 6))
        o = max(1, price + rng.choice((0, 0, rng.randint(-12, 12))))
        c = max(1, o + drift + rng.choice((0, 1, rng.randint(-3, 3), rng.randint(-15, 15))))
        h = max(o, c) + rng.choice((0, 0, rng.randint(0, 25)))
        l = max(0, min(o, c) - rng.choice((0, 0, rng.randint(0, 25))))
        price = c
        bar = [o, h, l, c]
        if rng.random() < .02:
            bar = [0, 0, 0, rng.choice((0, c))]
        elif rng.random() < .02:
            bar[rng.randrange(4)] = None
        elif rng.random() < .02:
            bar = [c, c, c, c]
        bars.append(tuple(bar))
    return bars


@pytest.fixture(scope="module")
def series():
    return {stock: _random_series(stock) for stock in range(1, 25)}


def test_all_patterns_bar_by_bar(spark, series):
    expected = set()
    with np.errstate(all="ignore"):
        for stock, bars in series.items():
            table = [[np.float64("nan") if x is None else np.float64(x) for x in bar] for bar in bars]
            for t in range(len(bars)):
                for pattern, met in _expected(_Bar(table, t)):
                    if met:
                        expected.add((stock * 10_000 + t, pattern))
    found = _hits(_frame(spark, series), strict_prior=True)
    assert found == expected
    assert len({pattern for _, pattern in found}) > 30


def test_partitioning_does_not_change_hits(spark, series):
    frame = _frame(spark, series)
    assert _hits(frame.repartition(7, "chart_close")) == _hits(frame)
    undated = frame.withColumn("chart_date", F.when(F.col("chart_id") % 50 != 7, F.col("chart_date")))
    assert detect.trend_flags(undated).count() == frame.count()


def test_history_gate(spark):
    rising = [(10 * i + 5, 10 * i + 9, 10 * i + 4, 10 * i + 8) for i in range(1, 80)]
    frame = _frame(spark, {1: rising})
    assert _hits(frame, only=[32], start=FIRST + dt.timedelta(days=59)) == set()
    late = FIRST + dt.timedelta(days=60)
    assert len(_hits(frame, only=[32], start=late)) == 0 + 19 * (rising[1][2] > rising[0][1])
    with pytest.raises(ValueError):
        detect.detect_patterns(frame, emit="slice")
    with pytest.raises(ValueError):
        detect.detect_patterns(frame, emit="all")


def test_subsets_exclusions_and_impossible_patterns(bars):
    found = _hits(bars)
    of = {i: {chart for chart, pattern in found if pattern == i} for i in PATTERNS}
    for inner, outer in ((9, 7), (10, 8), (15, 13), (16, 14), (47, 44)):
        assert of[inner] <= of[outer]
    assert not of[48] and not of[49]
    assert not of[32] & of[33]
    flags = detect.trend_flags(bars)
    assert flags.where("up AND down").isEmpty()


def test_mirrored_prices_give_mirrored_patterns(spark, bars):
    mirrored = bars.withColumns({
        "chart_open": -F.col("chart_open"), "chart_close": -F.col("chart_close"),
        "chart_high": -F.col("chart_low"), "chart_low": -F.col("chart_high")})
    pairs = ((3, 4), (32, 33), (34, 35), (36, 37), (40, 41))
    found, other = _hits(bars), _hits(mirrored)
    for a, b in pairs:
        for x, y in ((a, b), (b, a)):
            assert {c for c, p in found if p == x} == {c for c, p in other if p == y}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_and_no_python(bars):
    plan = _plan(detect.detect_patterns(bars))
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1
    assert "Python" not in plan and "Arrow" not in plan
