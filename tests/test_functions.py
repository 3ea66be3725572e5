import datetime as dt

import pytest
from pyspark.sql import functions as F

from ohlcraft import schema
from ohlcraft.functions import scalar
from ohlcraft.operators import change, history, lookup, merge
from ohlcraft.sources import bars as bar_source, symbols


def _values(spark, values, kind, function):
    frame = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in frame.select(function(F.col("x"))).collect()]


def test_symbols_lose_every_leading_a(spark):
    values = ["AA000001", "A", "0001A0", "A0001A0", None]
    assert _values(spark, values, "string", scalar.ticker_of) == [
        "000001", "", "0001A0", "0001A0", None]
    assert _values(spark, ["1"], "string", scalar.symbol_of) == ["A1"]


def test_sector_prefix_is_dropped_once(spark):
    values = ["코스닥 제조", "코스닥 코스닥 제조", "코스닥", "제조"]
    assert _values(spark, values, "string", scalar.sector_label) == [
        "제조", "코스닥 제조", "코스닥", "제조"]


def test_dates_and_numbers(spark):
    assert _values(spark, [20240229], "int", scalar.day) == [dt.date(2024, 2, 29)]
    with pytest.raises(Exception, match="20240230|CANNOT_PARSE|DateTime"):
        _values(spark, [20240230], "int", scalar.day)
    assert _values(spark, [20240230], "int", scalar.day_or_null) == [None]
    assert _values(spark, ["1.5", "n/a", "NaN", None], "string", scalar.number_or_null) == [
        1.5, None, None, None]


def test_malformed_rows_can_be_set_aside(spark):
    raw = spark.createDataFrame(
        [("A1", 20240102, 1, 2, 1, 2, 10), ("A1", 20241345, 1, 2, 1, 2, 10)],
        "symbol string, date int, open long, high long, low long, close long, volume long")
    assert bar_source.malformed_dates(raw).count() == 1
    row = bar_source.chart_rows(raw.where("date = 20240102")).first()
    assert (row.ticker, row.chart_date, row.chart_turnover) == ("1", dt.date(2024, 1, 2), 20)
    day = dt.date(2024, 1, 2)
    assert bar_source.had_session(raw, "A1", day).first()[0]
    assert not bar_source.had_session(raw, "A2", day).first()[0]


def test_change_keeps_what_it_can_not_compute(spark):
    closes = [100, 110, 0, 50] + [50 + i for i in range(400)]
    day = dt.date(2020, 1, 1)
    frame = spark.createDataFrame(
        [(1, day + dt.timedelta(days=i), c, 7.0) for i, c in enumerate(closes)],
        "stock_id long, chart_date date, chart_close long, chart_change_percentage double")
    last = day + dt.timedelta(days=300)
    changed = change.change_percentage(frame, day, last)
    got = [r.chart_change_percentage for r in changed.orderBy("chart_date").collect()]
    expected = [7.0] + [
        (b - a) / a * 100 if a else 7.0 for a, b in zip(closes, closes[1:])]
    assert got == expected[:301] + [7.0] * (len(closes) - 301)


def test_prior_bars_are_the_newest_before_the_date(bars):
    day = dt.date(1990, 6, 1)
    prior = history.prior_bars(bars, day, 5).where("stock_id = 0").collect()
    assert sorted(r.chart_date for r in prior) == [day - dt.timedelta(days=i) for i in range(5, 0, -1)]


def test_one_row_per_key_in_order(spark):
    rows = spark.createDataFrame(
        [(1, 5, 1), (1, 3, 2), (1, 4, 0), (2, 9, 1)], "k int, v int, at int")
    first = {r.k: (r.v, r["_rows"]) for r in merge.one_per_key(rows, ["k"], "at").collect()}
    last = {r.k: r.v for r in merge.one_per_key(rows, ["k"], "at", last=True).collect()}
    assert first == {1: (4, 3), 2: (9, 1)}
    assert last == {1: 3, 2: 9}


def test_new_ids_are_consecutive(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("name"))
    ids = [r[0] for r in merge.with_new_ids(rows, "new", ["name"], 10).select("new").collect()]
    assert sorted(ids) == list(range(11, 5011))


def test_unknown_names_are_listed(spark):
    stocks = spark.createDataFrame([("1", 1)], "ticker string, stock_id long")
    caps = spark.createDataFrame([("A1", 5), ("A2", 6), ("AA3", 7)], "symbol string, cap long")
    mapped = lookup.market_caps_by_stock(caps, stocks)
    with pytest.raises(lookup.UnknownKeys) as error:
        lookup.require_known(mapped, "stock_id", "ticker")
    assert sorted(r[0] for r in error.value.missing.collect()) == ["2", "3"]
    lookup.require_known(mapped.where("stock_id IS NOT NULL"), "stock_id", "ticker")


def test_last_market_cap_of_a_symbol_counts(spark):
    snapshot = spark.createDataFrame(
        [("A1", 5, 1), ("A1", 3, 2), ("A2", 9, 1)], "symbol string, cap long, at int")
    wanted = symbols.symbols_from_list(spark, ["A1", "A1"])
    assert [tuple(r) for r in symbols.market_caps(wanted, snapshot, "at").collect()] == [("A1", 3)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_raw_bars_are_read_for_symbols_and_range(spark, tmp_path, fmt):
    rows = [("A1", 20240101 + i, 1, 2, 1, 2, 10) for i in range(5)] + [("A2", 20240103, 1, 2, 1, 2, 10)]
    path = str(tmp_path / fmt)
    spark.createDataFrame(rows, schema.RAW_BARS).write.format(fmt).save(path)
    read = bar_source.read_raw_bars(
        spark, path, symbols.symbols_from_list(spark, ["A1"]),
        dt.date(2024, 1, 2), dt.date(2024, 1, 4), fmt=fmt)
    assert sorted(r.date for r in read.collect()) == [20240102, 20240103, 20240104]
    assert read.schema == schema.RAW_BARS
