import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import catalogue, daily_queries
from ohlcraft.operators import detect, history, lookup, merge, reshape
from ohlcraft.operators.indicators import families
from ohlcraft.operators.indicators.compute import indicators
from ohlcraft.plans import daily
from ohlcraft.plans.commits import Commits
from ohlcraft.plans.tables import MONTH, Tables
from ohlcraft.sources import derived, symbols
from tests.conftest import SF_DIR

FAMILIES = ["MACD", "이동평균(라인3개)", "A/D Line"]


def _loaded(spark, root, until):
    """Tables with the dimensions and all charts of known stocks up to a date."""
    tables = Tables(spark, str(root))
    listing = derived.listing(spark, SF_DIR)
    daily.refresh_dimensions(tables, listing.select("symbol"), listing)
    marks = [("charts", dt.date(1990, 1, 1)), ("daily_indicators", dt.date(1990, 1, 1))]
    tables.append("latest_date", spark.createDataFrame(marks, Tables.SCHEMAS["latest_date"]))
    raw = derived.raw_bars(spark, SF_DIR)
    daily.load_bars(tables, raw, listing.select("symbol"), dt.date(1990, 1, 1), until)
    return tables, raw, listing.select("symbol")


def test_daily_run_is_idempotent_and_complete(spark, tmp_path):
    start, end = dt.date(1991, 2, 27), dt.date(1991, 3, 3)
    tables, raw, listed = _loaded(spark, tmp_path, start - dt.timedelta(days=1))
    before = tables.read("charts").count()
    report = daily.run_daily(
        tables, raw, listed, start, end, FAMILIES, session_symbol="A" + "1".zfill(12))
    assert report.had_session
    assert report.charts.inserted == report.charts.total == tables.read("charts").count() - before
    assert report.changes == report.charts.inserted
    assert report.patterns.inserted > 0 and report.patterns.skipped == 0
    # per bar: three averages, three MACD lines, two breadth lines
    assert report.indicators.inserted == report.charts.inserted * 8
    marks = {r[0]: r[1] for r in tables.read("latest_date").collect()}
    assert marks == {"charts": end, "daily_indicators": end}

    again = daily.run_daily(tables, raw, listed, start, end, FAMILIES)
    for first, second in ((report.charts, again.charts), (report.patterns, again.patterns),
                          (report.indicators, again.indicators)):
        assert second.inserted == 0
        assert second.skipped == second.total == first.total

    # the stored hits are those found with the whole history at hand
    charts = tables.read("charts")
    expected = detect.detect_patterns(charts, start, end)
    stored = tables.read("pattern_records").select("chart_id", "pattern_id")
    assert sorted(stored.collect()) == sorted(expected.collect())
    whole = indicators(charts, ["MACD"], start, end)
    macd = (
        tables.read("daily_indicators")
        .join(tables.read("indicators_lines"), "indicator_line_id")
        .where("indicator_line_name = 'MACD'"))
    assert {r.chart_id: r.daily_indicator_value for r in macd.collect()} == {
        r.chart_id: r.MACD for r in whole.collect()}

    # changes equal those against the previous row, and other rows were left alone
    changed = charts.where(F.col("chart_change_percentage").isNotNull())
    assert changed.where(F.col("chart_date").between(start, end)).count() == report.changes
    assert charts.count() - changed.count() == charts.select("stock_id").distinct().count()
    assert charts.count() == before + report.charts.inserted
    assert charts.where(F.trunc("chart_date", "month") != F.col(MONTH)).count() == 0


def test_run_without_charts_stops(spark, tmp_path):
    tables, raw, listed = _loaded(spark, tmp_path, dt.date(1990, 2, 1))
    day = dt.date(2020, 1, 1)
    report = daily.run_daily(tables, raw, listed, day, day, session_symbol="A" + "1".zfill(12))
    assert not report.had_session
    assert report.charts.total == 0 and report.patterns is None
    assert tables.read("latest_date").where("latest_date = '2020-01-01'").isEmpty()


def test_short_near_history_is_widened(bars):
    start, end = dt.date(1991, 2, 20), dt.date(1991, 2, 27)
    # stock 0 keeps its bars, the others lose those of the last weeks before the range
    thinned = bars.where("stock_id = 0 OR chart_date NOT BETWEEN '1991-01-01' AND '1991-02-19'")
    expected = sorted(detect.detect_patterns(thinned, start, end).collect())
    assert expected
    near = history.warmup_bars(thinned, start, end, near_days=90)
    assert sorted(detect.detect_patterns(near, start, end).collect()) == expected
    counts = {r.stock_id: r["count"] for r in near.groupBy("stock_id").count().collect()}
    assert counts[0] == 98
    assert counts[1] > 300


def test_refresh_adds_only_new_names(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    listing = derived.listing(spark, SF_DIR)
    some = listing.where("symbol < 'A000000000050'").select("symbol")
    sectors, stocks = daily.refresh_dimensions(tables, some, listing)
    assert sectors.count() == tables.read("sectors").count() > 0
    assert stocks.count() == 50
    assert not tables.read("sectors").where("sector_name LIKE '코스닥 %'").count()
    _, stocks = daily.refresh_dimensions(tables, listing.select("symbol"), listing)
    assert stocks.count() == 100
    ids = [r[0] for r in tables.read("stocks").select("stock_id").collect()]
    assert sorted(ids) == list(range(1, 151))
    sectors, stocks = daily.refresh_dimensions(tables, listing.select("symbol"), listing)
    assert sectors.isEmpty() and stocks.isEmpty()


def test_unknown_sector_raises_with_its_name(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    listed = spark.createDataFrame(
        [("1", "one", "S"), ("2", "two", "T")], "ticker string, stock_name string, sector_name string")
    tables.insert_sectors(listed.where("sector_name = 'S'"))
    with pytest.raises(lookup.UnknownKeys) as error:
        tables.insert_stocks(listed)
    assert [r[0] for r in error.value.missing.collect()] == ["T"]
    assert tables.read("stocks").isEmpty()


def test_market_caps_last_write_wins(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    stocks = [(i, str(i), f"s{i}", 1) for i in (1, 2, 3)]
    tables.append("stocks", spark.createDataFrame(stocks, Tables.SCHEMAS["stocks"]))
    caps = "symbol string, cap long, at int"

    def stored():
        return {r.stock_id: r.cap for r in tables.read("market_caps").collect()}

    tables.upsert_market_caps(spark.createDataFrame([("A1", 10, 0), ("A2", 20, 0)], caps))
    assert stored() == {1: 10, 2: 20}
    rows = [("A2", 99, 1), ("A2", 22, 2), ("A3", 30, 1)]
    applied = tables.upsert_market_caps(spark.createDataFrame(rows, caps), order_by="at")
    assert stored() == {1: 10, 2: 22, 3: 30}
    assert applied.columns == ["symbol", "ticker", "stock_id", "cap"]
    with pytest.raises(lookup.UnknownKeys, match="9"):
        tables.upsert_market_caps(spark.createDataFrame([("A1", 1, 0), ("A9", 1, 0)], caps))
    assert stored() == {1: 10, 2: 22, 3: 30}


def test_broken_replacements_leave_the_old_rows(spark, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path))
    day, later = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    tables.append("latest_date", spark.createDataFrame([("charts", day)], Tables.SCHEMAS["latest_date"]))

    def mark():
        return [r.latest_date for r in tables.read("latest_date").collect()]

    with monkeypatch.context() as patch:
        patch.setattr(Commits, "_create", lambda *_: (_ for _ in ()).throw(OSError("broken off")))
        with pytest.raises(OSError):
            tables.set_latest_date("charts", later)
    assert mark() == [day]
    tables.set_latest_date("charts", later)
    tables.set_latest_date("charts", later + dt.timedelta(days=1))
    assert mark() == [later + dt.timedelta(days=1)]
    tables.append("latest_date", spark.createDataFrame([("x", day)], Tables.SCHEMAS["latest_date"]))
    assert sorted(mark()) == [day, later + dt.timedelta(days=1)]


def _stored(tables):
    """What a daily run leaves, as comparable rows."""
    return {name: sorted(map(tuple, tables.read(name).drop(MONTH).collect()), key=str)
            for name in ("charts", "pattern_records", "daily_indicators", "latest_date", "stored_lines")}


STEPS = ["insert_charts", "update_changes", "set_latest_date", "insert_patterns", "insert_wide_indicators"]


@pytest.fixture(scope="module")
def whole_run(spark, tmp_path_factory):
    start, end = dt.date(1991, 2, 27), dt.date(1991, 3, 3)
    tables, raw, listed = _loaded(spark, tmp_path_factory.mktemp("whole"), start - dt.timedelta(days=1))
    report = daily.run_daily(tables, raw, listed, start, end, FAMILIES)
    return _stored(tables), report


@pytest.mark.parametrize("broken", range(len(STEPS)))
def test_broken_runs_go_on_where_they_broke_off(spark, tmp_path, monkeypatch, whole_run, broken):
    """Breaks right after a step was committed; run again, the steps so far are left out."""
    start, end = dt.date(1991, 2, 27), dt.date(1991, 3, 3)
    tables, raw, listed = _loaded(spark, tmp_path, start - dt.timedelta(days=1))
    step, calls = getattr(Tables, STEPS[broken]), []

    def breaking(self, *args, **options):
        step(self, *args, **options)
        raise OSError("broken off")

    with monkeypatch.context() as patch:
        patch.setattr(Tables, STEPS[broken], breaking)
        with pytest.raises(OSError):
            daily.run_daily(tables, raw, listed, start, end, FAMILIES)
    assert len(tables.commits.latest().journal) == 1
    for name in STEPS[1:]:
        own = getattr(Tables, name)
        monkeypatch.setattr(Tables, name, lambda self, *a, _own=own, _name=name, **k: (calls.append(_name), _own(self, *a, **k))[1])
    report = daily.run_daily(tables, raw, listed, start, end, FAMILIES)
    assert report == whole_run[1] and _stored(tables) == whole_run[0]
    assert tables.commits.latest().journal == {}
    expected = STEPS[max(broken + 1, 1):]  # the last mark ends the run, always
    assert sorted(set(calls)) == sorted({*expected, "set_latest_date"})


def test_new_bars_start_a_broken_run_anew(spark, tmp_path, monkeypatch):
    start, end = dt.date(1991, 2, 27), dt.date(1991, 3, 3)
    tables, raw, listed = _loaded(spark, tmp_path, start - dt.timedelta(days=1))
    with monkeypatch.context() as patch:
        patch.setattr(daily, "store_indicators", lambda *a, **k: (_ for _ in ()).throw(OSError("broken off")))
        with pytest.raises(OSError):
            daily.run_daily(tables, raw.where("date <> 19910301"), listed, start, end, FAMILIES)
    report = daily.run_daily(tables, raw, listed, start, end, FAMILIES)
    assert report.charts.inserted > 0 and report.patterns.skipped > 0
    stored = tables.read("pattern_records").select("chart_id", "pattern_id")
    expected = detect.detect_patterns(tables.read("charts"), start, end)
    assert {*map(tuple, expected.collect())} <= {*map(tuple, stored.collect())}


def _raise(keep, *arrays):
    raise ArithmeticError("no lines")


@pytest.mark.parametrize("name", ["MACD", "A/D Line", "이동평균(라인3개)"])
def test_a_family_that_raises_goes_alone(spark, tmp_path, monkeypatch, name):
    start, end = dt.date(1991, 3, 1), dt.date(1991, 3, 2)
    tables, raw, listed = _loaded(spark, tmp_path, start - dt.timedelta(days=1))
    family = families.FAMILIES[name]
    broken = {"inputs": lambda t: 1 / 0} if family.framed else {"slice_lines": _raise}
    monkeypatch.setitem(families.FAMILIES, name, dataclasses.replace(family, **broken))
    report = daily.run_daily(tables, raw, listed, start, end, FAMILIES)
    assert report.failed == (name,)
    lines = {r[0] for r in tables.read("daily_indicators").join(
        tables.read("indicators_lines"), "indicator_line_id").select("indicator_line_name").distinct().collect()}
    assert lines == {line for n in FAMILIES if n != name for line in families.LINE_NAMES[n]}
    monkeypatch.setitem(families.FAMILIES, name, family)
    again = daily.run_daily(tables, raw, listed, start, end, FAMILIES)
    assert again.failed == () and again.indicators.inserted == report.charts.inserted * len(families.LINE_NAMES[name])


def test_lines_are_compared_before_the_melt(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    names = [f"line {i}" for i in range(130)]
    tables.register_lines(names)
    month = dt.date(2024, 1, 1)
    wide = spark.range(50).select(
        F.col("id").alias("chart_id"), F.lit(month).alias(MONTH),
        *(F.when(F.col("id") % 5 != i % 5, F.col("id") * i * 1.0).alias(n) for i, n in enumerate(names)),
        F.lit("3.5").alias("nobody's line"))
    some = wide.select("chart_id", MONTH, *names[:70]).where("chart_id < 30")
    first = tables.insert_wide_indicators(some)
    assert first.inserted == first.total == 30 * 70 * 4 / 5
    stats = tables.insert_wide_indicators(wide)
    assert stats.total == 50 * (104 + 1) and stats.inserted == 50 * 104 - first.inserted
    values = tables.read("daily_indicators")
    assert values.count() == values.select("chart_id", "indicator_line_id").distinct().count() == 50 * 104
    again = tables.insert_wide_indicators(wide)
    assert again.inserted == 0 and again.total == stats.total
    # the same values one by one
    long = wide.select("chart_id", MONTH, F.lit(" line 3").alias("indicator_line_name"),
                       F.col("line 3").alias("daily_indicator_value"))
    assert tables.insert_indicators(long).inserted == 0
    ids = {r.indicator_line_name: r.indicator_line_id for r in tables.read("indicators_lines").collect()}
    new = merge.new_line_values(tables.read("stored_lines"), wide, ids, (MONTH,))
    plan = merge.melted(new, wide, ids, (MONTH,))._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Generate")]
    assert "Exchange" not in above.replace("AdaptiveSparkPlan", "") and "SortAggregate" not in plan


def test_values_of_charts_that_carry_their_stored_lines(spark):
    """The same new values as by a join with the stored lines, and no filter on all lines."""
    ids = {f"line {i}": i + 1 for i in range(90)}
    charts = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "chart_id long")
    stored = spark.createDataFrame([(1, [6, 1]), (1, [8, 0]), (2, [0]), (4, [2, 2]), (None, [-1, -1])],
                                   "chart_id long, words array<long>")

    def with_lines(rows):
        value = F.coalesce("chart_id", F.lit(9)) * 1.0
        return rows.select("*", *(F.when(F.lit(i % 7 > 0), value + i).alias(name) for name, i in ids.items()),
                           F.lit("3.5").alias("nobody's line"))

    wide, carrying = with_lines(charts), with_lines(merge.with_stored_lines(charts, stored, ids.values()))
    expected, found = merge.new_line_values(stored, wide, ids), merge.new_line_values(None, carrying, ids)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    rows = [merge.melted(new, rows, ids) for new, rows in ((expected, wide), (found, carrying))]
    assert rows[0].count() == 5 * 78 - 2 * 4 and sorted(map(str, rows[0].collect())) == sorted(map(str, rows[1].collect()))
    assert all("size(" not in x._jdf.queryExecution().optimizedPlan().toString() for x in rows)


def test_new_indicators_shuffle_charts_and_not_their_lines(spark):
    """However large the bars are estimated to be, what is sorted by chart is narrow."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = catalogue.QUERIES["insert_ignore_indicators"].run(spark, SF_DIR)._jdf.queryExecution().sparkPlan()
    finally:
        spark.conf.set(key, before)

    def joined(node):
        children = [node.children().apply(i) for i in range(node.children().size())]
        found = [node.output().size()] if node.nodeName() == "SortMergeJoin" else []
        return found + [n for child in children for n in joined(child)]

    assert joined(plan) and max(joined(plan)) < 20


@pytest.mark.parametrize("anchor", ["bar", "range"])
def test_runs_compare_charts_before_their_lines_are_computed(spark, tmp_path, monkeypatch, anchor):
    """Anew after another load was first: what that one has stored is not stored again."""
    start, end = dt.date(1991, 2, 27), dt.date(1991, 3, 3)
    tables, *_ = _loaded(spark, tmp_path, end)
    own, given = merge.new_line_values, []

    def compared(stored, wide, *rest):
        given.append((stored, merge.STORED in wide.columns))
        if len(given) == 1:
            daily.store_indicators(Tables(spark, str(tmp_path)), start, end, FAMILIES[:1], anchor)
        return own(stored, wide, *rest)

    monkeypatch.setattr(merge, "new_line_values", compared)
    stats, failed = daily.store_indicators(tables, start, end, FAMILIES, anchor)
    assert given == [(None, True)] * 3 and failed == ()
    values = tables.read("daily_indicators")
    assert values.count() == values.select("chart_id", "indicator_line_id").distinct().count() == stats.total
    assert 0 < stats.inserted < stats.total
    charts = tables.read("charts").where(F.col("chart_date") <= end)
    expected = reshape.indicators_long(indicators(charts, FAMILIES, start, end, anchor=anchor))
    assert expected.count() == stats.total


def test_loads_read_raw_bars_that_are_derived_once(spark, monkeypatch):
    read = []
    for name in ("load_bars", "run_daily"):
        monkeypatch.setattr(daily, name, lambda tables, raw, *rest: read.append(raw.inputFiles()))
    monkeypatch.setattr(daily_queries, "_FILLED", {})
    daily_queries.filled(spark, SF_DIR)
    assert len(read) == 4 and all(files and not any("orders" in f for f in files) for files in read)


def test_runs_read_the_months_that_hold_the_last_bars(spark, tmp_path):
    """A new listing and a halted stock: only months with one of a stock's last 61 bars are read."""
    tables = Tables(spark, str(tmp_path))
    tables.append("stocks", spark.createDataFrame(
        [(i, str(i), f"s{i}", 1) for i in (1, 2, 3, 4)], Tables.SCHEMAS["stocks"]))
    kind = ("ticker string, chart_date date, chart_open long, chart_high long, chart_low long,"
            " chart_close long, chart_volume long, chart_turnover long")
    day, first = dt.date(2024, 6, 3), dt.date(2010, 1, 1)

    def rows(ticker, start, n):
        found = []
        for i in range(n):
            c = 100 + (i * 37 + int(ticker)) % 50
            found.append((ticker, start + dt.timedelta(days=i), c - 3, c + 5, c - 6, c, 10 + i % 9, c * 10))
        return found

    # 1: every day since 2023; 2: listed on the day; 3: 70 days of 2012, then halted; 4: ended in 2010
    old = [*rows("1", dt.date(2023, 1, 1), 519), *rows("3", dt.date(2012, 3, 1), 70), *rows("4", first, 90)]
    tables.insert_charts(spark.createDataFrame(old, kind))
    tables.insert_charts(spark.createDataFrame(
        [r for t in "123" for r in rows(t, day, 1)], kind), day, day)
    charts = tables.charts_in_reach(day, day)
    read = {f.split(f"{MONTH}=")[1][:7] for f in charts.inputFiles() if "/charts/" in f}
    assert read == {"2024-06", "2024-05", "2024-04", "2012-05", "2012-04", "2012-03"}
    assert charts.where("stock_id = 4").isEmpty() and charts.where("stock_id = 2").count() == 1
    whole = tables.read("charts")
    assert sorted(detect.detect_patterns(charts, day, day).collect()) == sorted(
        detect.detect_patterns(whole, day, day).collect())
    names = ["MACD", "Bollinger Band", "RSI"]
    found = sorted(indicators(charts, names, day, day).collect())
    assert len(found) == 2 and found == sorted(indicators(whole, names, day, day).collect())


def test_breadth_from_the_kept_table_after_a_correction(spark, tmp_path):
    start, end = dt.date(1991, 3, 1), dt.date(1991, 3, 3)
    tables, raw, listed = _loaded(spark, tmp_path, dt.date(1990, 1, 1))
    everything = (raw, listed, dt.date(1990, 1, 1), end)
    daily.load_bars(tables, raw.where("volume % 5 > 0"), *everything[1:])
    daily.load_bars(tables, *everything)
    names = ["A/D Line", "McCellan Oscillator"]
    charts = tables.read("charts")
    expected = indicators(charts, names, start, end)
    found = indicators(charts, names, start, end, breadth=tables.net_advances())
    assert sorted(found.collect()) == sorted(expected.collect()) and not found.isEmpty()


def test_unknown_mark_changes_nothing(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    day = dt.date(2024, 1, 2)
    tables.append("latest_date", spark.createDataFrame(
        [("charts", day)], Tables.SCHEMAS["latest_date"]))
    tables.set_latest_date("other", dt.date(2024, 5, 5))
    assert [tuple(r) for r in tables.read("latest_date").collect()] == [("charts", day)]


def test_duplicates_unknown_names_and_tickers_are_skipped(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.append("stocks", spark.createDataFrame([(7, "7", "s", 1)], Tables.SCHEMAS["stocks"]))
    day = dt.date(2024, 1, 2)
    kind = ("ticker string, chart_date date, chart_open long, chart_high long, chart_low long,"
            " chart_close long, chart_volume long, chart_turnover long")
    rows = [("7", day, 1, 2, 1, 2, 5, 10), ("7", day, 1, 2, 1, 2, 5, 10),
            ("8", day, 1, 2, 1, 2, 5, 10)]
    stats = tables.insert_charts(spark.createDataFrame(rows, kind))
    assert (stats.total, stats.inserted, stats.skipped) == (3, 1, 2)

    tables.register_lines(["MACD"])
    month = day.replace(day=1)
    values = [(1, "MACD ", "1.5", month), (1, "no line", "2", month), (2, "MACD", "n/a", month),
              (3, "MACD", None, month)]
    long = spark.createDataFrame(
        values, f"chart_id long, indicator_line_name string, daily_indicator_value string,"
                f" {MONTH} date")
    stats = tables.insert_indicators(long)
    assert (stats.total, stats.inserted, stats.skipped) == (2, 1, 1)
    empty = tables.insert_indicators(long.limit(0))
    assert (empty.total, empty.inserted) == (0, 0)


def test_symbol_sources(spark, tmp_path):
    path = tmp_path / "symbols.csv"
    path.write_text("A000001\nA000002\n")
    assert [r[0] for r in symbols.symbols_from_csv(spark, str(path)).collect()] == [
        "A000001", "A000002"]
    assert [r[0] for r in symbols.symbols_from_list(spark, ["A1", "A2"]).collect()] == ["A1", "A2"]
    stocks = spark.createDataFrame([("1",)], "ticker string")
    assert symbols.symbols_from_stocks(stocks).first()[0] == "A1"
