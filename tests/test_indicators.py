import datetime as dt
import logging

import numpy as np
import pytest
from pyspark.sql import functions as F

from ohlcraft.operators import history, reshape
from ohlcraft.operators.indicators.compute import indicators
from ohlcraft.operators.indicators.families import FAMILIES, LINE_NAMES, line_name

NAMES = ["MACD", "DMI", "RSI", "Aroon", "CCI", "McCellan Oscillator"]


def _rows(df):
    return {r.chart_id: tuple(None if v is None else round(v, 6) for v in r[1:])
            for r in df.collect()}


def test_families_and_line_names():
    assert len(FAMILIES) == len(LINE_NAMES) == 43
    assert sum(map(len, LINE_NAMES.values())) == 87
    assert line_name("MACD", 1) == "MACD_Signal"
    assert line_name("MACD", 3) == "MACD_3"
    assert line_name("Unknown", 0) == "Unknown_0"


def test_unknown_family_is_skipped(bars, caplog):
    with caplog.at_level(logging.WARNING):
        wide = indicators(bars, ["MACD", "Nope", "MACD"])
    assert wide.columns == ["chart_id", *LINE_NAMES["MACD"]]
    assert "Nope" in caplog.text


def test_every_bar_with_sixty_before_it_has_a_row(bars):
    wide = indicators(bars, ["DEMA"])
    per_stock = bars.groupBy("stock_id").count().collect()
    assert wide.count() == sum(max(0, r["count"] - 60) for r in per_stock)
    first = bars.where("stock_id = 0").orderBy("chart_date").limit(60)
    assert indicators(first, ["DEMA", "이동평균(라인3개)"]).isEmpty()


def test_partitioning_and_batches_do_not_change_values(spark, bars):
    whole = _rows(indicators(bars, NAMES))
    assert _rows(indicators(bars.repartition(5, "chart_volume"), NAMES)) == whole
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        assert _rows(indicators(bars, NAMES)) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_value_depends_on_the_last_61_bars_only(bars):
    dates = [r[0] for r in bars.where("stock_id = 0").select("chart_date").orderBy("chart_date").collect()]
    recent = bars.where(F.col("stock_id") == 0).where(F.col("chart_date") >= dates[-61])
    names = [name for name, f in FAMILIES.items() if not f.by_date]
    alone = _rows(indicators(recent, names))
    assert len(alone) == 1
    whole = _rows(indicators(bars, names, start=dates[-1]))
    assert alone.items() <= whole.items()


def test_both_anchors_agree_on_the_first_day(spark, bars):
    start, end = dt.date(1990, 9, 1), dt.date(1990, 11, 30)
    names = [*NAMES, "SONAR", "Inertia", "Mass Index"]
    by_bar = _rows(indicators(bars, names, start, end))
    by_range = _rows(indicators(bars, names, start, end, anchor="range"))
    assert by_bar.keys() == by_range.keys()
    first = {r[0] for r in bars.where(F.col("chart_date") == start).select("chart_id").collect()}
    assert first and all(by_bar[c] == by_range[c] for c in first)
    assert by_bar != by_range
    # stocks of unlike lengths side by side, over all of their history
    uneven = bars.where("stock_id % 3 <> 0 OR chart_date > '1991-01-01'")
    some = _rows(indicators(uneven.where("stock_id IN (3, 4)"), names, anchor="range"))
    assert some.items() <= _rows(indicators(uneven, names, anchor="range")).items()


@pytest.mark.parametrize("size", [1, 13, 60, 61, 62, 97, 331])
def test_recursions_go_on_from_batch_to_batch(spark, bars, size):
    names = [name for name, f in FAMILIES.items() if not f.by_date]
    some = bars.where("stock_id IN (0, 1) OR chart_date < '1990-03-20'").where("chart_date < '1990-07-20'")
    start, end = dt.date(1990, 3, 5), dt.date(1990, 7, 10)
    whole = [_rows(indicators(some, names, anchor="range")),
             _rows(indicators(some, names, start, end, anchor="range"))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
    try:
        parts = [_rows(indicators(some, names, anchor="range")),
                 _rows(indicators(some, names, start, end, anchor="range"))]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(whole) and parts == whole


def test_recursions_against_plain_loops(bars):
    closes = [r[0] for r in bars.where("stock_id = 1").orderBy("chart_date").select("chart_close").collect()]

    def ema(values, n):
        out = [values[0]]
        for x in values[1:]:
            out.append(out[-1] + (x - out[-1]) * 2 / (n + 1))
        return out

    window = closes[-61:]
    macd = [a - b for a, b in zip(ema(window, 12), ema(window, 26))]
    last = bars.where("stock_id = 1").orderBy(F.desc("chart_date")).first()
    row = indicators(bars, ["MACD", "RSI"]).where(F.col("chart_id") == last.chart_id).first()
    assert row.MACD == pytest.approx(macd[-1])
    assert row.MACD_Signal == pytest.approx(ema(macd, 9)[-1])
    moves = np.diff(window)
    up, down = max(moves[0], 0), max(-moves[0], 0)
    for move in moves[1:]:
        up += (max(move, 0) - up) / 14
        down += (max(-move, 0) - down) / 14
    assert row.RSI == pytest.approx(100 * up / (up + down))


def test_all_families_take_one_shuffle(bars):
    names = [name for name, f in FAMILIES.items() if not f.by_date]
    plan = indicators(bars, names)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1


def test_lines_of_the_market_do_not_shuffle_those_of_the_stocks(spark, bars):
    """However large the bars are estimated to be, wide rows stay where they were computed."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = indicators(bars)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    above = plan[:plan.index("MapInArrow")]
    assert "BroadcastHashJoin" in above and "hashpartitioning" not in above


def test_long_form_drops_what_is_no_number(spark):
    wide = spark.createDataFrame(
        [(2, "1.5", float("nan")), (1, "n/a", 2.0), (3, None, None)],
        "chart_id long, `P.C x` string, y double")
    rows = [tuple(r) for r in reshape.indicators_long(wide, ordered=True).collect()]
    assert rows == [(1, 2.0, "y"), (2, 1.5, "P.C x")]


def test_breadth_of_a_range_equals_that_of_all_history(bars):
    """With stocks that resume just then, are halted on the day, or are gone."""
    start, end = dt.date(1991, 2, 20), dt.date(1991, 2, 27)
    breadth = [name for name, f in FAMILIES.items() if f.by_date]
    sessions = [r[0] for r in bars.where(F.col("chart_date") < start).select("chart_date").distinct().orderBy(
        F.desc("chart_date")).limit(61).collect()]
    holes = bars.where(
        f"NOT (stock_id % 4 = 1 AND chart_date BETWEEN '1990-06-01' AND '{sessions[60]}')"
        f" AND NOT (stock_id % 4 = 2 AND chart_date BETWEEN '{start}' AND '{end}')"
        f" AND NOT (stock_id % 4 = 3 AND chart_date > '{sessions[30]}')")
    whole = _rows(indicators(holes, breadth, start, end))
    near = history.warmup_bars(holes, start, end, near_days=120)
    market = history.market_bars(holes, start, end, near_days=120)
    assert whole and _rows(indicators(near, breadth, start, end, breadth_bars=market)) == whole
    assert market.count() < holes.count() / 2
