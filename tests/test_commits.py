import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from ohlcraft.plans import commits, tables as tables_module
from ohlcraft.plans.commits import Change, Commits, Conflict, State
from ohlcraft.plans.tables import MONTH, Tables

CHART_ROWS = ("ticker string, chart_date date, chart_open long, chart_high long, chart_low long,"
              " chart_close long, chart_volume long, chart_turnover long")


def _with_stock(spark, root, stocks=((7, "7"),)):
    tables = Tables(spark, str(root))
    tables.append("stocks", spark.createDataFrame([(i, t, f"s{t}", 1) for i, t in stocks], Tables.SCHEMAS["stocks"]))
    return tables


def _bars(spark, closes, ticker="7"):
    """Bars by date: a close each."""
    return spark.createDataFrame(
        [(ticker, day, c, c, c, c, 1, c) for day, c in closes.items()], CHART_ROWS)


def _changes(tables):
    return {r.chart_date: r.chart_change_percentage for r in tables.read("charts").collect()}


def _days(text, *days):
    year, month = map(int, text.split("-"))
    return [dt.date(year, month, d) for d in days]


def test_a_commit_names_all_or_nothing(spark, tmp_path):
    log = Commits(spark, str(tmp_path))
    assert log.latest() == State()
    first = log.publish(State(), [], Change(add={"a": ["a/1"], "b": ["b/1"]}))
    assert log.latest() == first and first.number == 1
    second = log.publish(first, ["a"], Change(add={"a": ["a/2"]}, drop={"a": ["a/1"]}))
    assert second.of("a") == ("a/2",) and second.of("b") == ("b/1",)
    # another table's commit is no conflict, one of the same table is
    third = log.publish(first, ["b"], Change(add={"b": ["b/2"]}))
    assert third.of("a") == ("a/2",) and third.of("b") == ("b/1", "b/2") and third.number == 3
    with pytest.raises(Conflict):
        log.publish(first, ["a"], Change(add={"a": ["a/3"]}))
    assert log.latest() == third


def test_a_number_is_taken_once(spark, tmp_path, monkeypatch):
    log = Commits(spark, str(tmp_path))
    seen = log.publish(State(), [], Change(add={"a": ["a/1"]}))
    assert log._create(State(2, {"a": ("a/1", "a/x")}))
    assert not log._create(State(2, {"a": ("a/1", "a/y")}))
    assert log.latest().of("a") == ("a/1", "a/x")
    # a load that saw the old state while the number was free goes on after the other
    states = iter([seen, log.latest()])
    monkeypatch.setattr(log, "latest", lambda: next(states))
    assert log.publish(seen, [], Change(add={"b": ["b/1"]})) == State(3, {"a": ("a/1", "a/x"), "b": ("b/1",)})
    assert not [n for n in os.listdir(tmp_path / commits.FOLDER) if n.startswith(".draft") and not n.endswith(".crc")]


def test_journal_holds_unfinished_runs(spark, tmp_path):
    log = Commits(spark, str(tmp_path))
    log.publish(State(), [], Change(step=("r", "load", [2, 1])))
    log.publish(State(), [], Change(step=("r", "changes", 4)))
    assert log.latest().journal == {"r": {"load": [2, 1], "changes": 4}}
    log.publish(State(), [], Change(step=("r", "load", [3, 3]), finished="r"))
    assert log.latest().journal == {"r": {"load": [3, 3]}}
    log.publish(State(), [], Change(finished="r"))
    assert log.latest().journal == {}


def test_old_folders_go_later_and_readers_keep_theirs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "KEPT_COMMITS", 2)
    tables = Tables(spark, str(tmp_path))
    kind = Tables.SCHEMAS["latest_date"]
    tables.append("latest_date", spark.createDataFrame([("charts", dt.date(2024, 1, 1))], kind))
    held = tables.read("latest_date")
    tables.set_latest_date("charts", dt.date(2024, 1, 2))
    tables.tidy()
    assert held.first().latest_date == dt.date(2024, 1, 1)
    for day in (3, 4):
        tables.set_latest_date("charts", dt.date(2024, 1, day))
    orphan, fresh = tmp_path / "latest_date" / "load=old", tmp_path / "latest_date" / "load=new"
    for folder in (orphan, fresh):
        folder.mkdir()
    os.utime(orphan, (time.time() - 90_000,) * 2)
    tables.tidy()
    assert tables.read("latest_date").first().latest_date == dt.date(2024, 1, 4)
    left = {n for n in os.listdir(tmp_path / "latest_date") if not n.startswith(".")}
    assert len(left) == 3 and "load=new" in left and "load=old" not in left
    assert len(Commits(spark, str(tmp_path)).numbers()) == 2


def test_breaks_leave_the_old_rows(spark, tmp_path, monkeypatch):
    """update_changes over two months, broken off before, while and after writing."""
    tables = _with_stock(spark, tmp_path)
    days = _days("2024-01", 30, 31) + _days("2024-02", 1, 2)
    tables.insert_charts(_bars(spark, dict(zip(days, (100, 110, 99, 99)))))
    right = _changes(tables)
    assert right == {days[0]: None, days[1]: 10.0, days[2]: -10.0, days[3]: 0.0}
    wrong = tables.read("charts", hidden=True).withColumn("chart_change_percentage", F.lit(5.0))
    tables.replace("charts", wrong, tables.commits.latest())
    five = dict.fromkeys(days, 5.0)
    for target, name in ((Tables, "_written"), (Commits, "publish"), (Commits, "_create")):
        with monkeypatch.context() as patch:
            patch.setattr(target, name, lambda *a, **k: (_ for _ in ()).throw(OSError("broken off")))
            with pytest.raises(OSError):
                tables.update_changes(days[0], days[-1])
        assert _changes(tables) == five
    assert tables.update_changes(days[1], days[2]) == 2
    assert _changes(tables) == {**right, days[0]: 5.0, days[3]: 5.0}
    before = tables.commits.latest()
    assert tables.update_changes(days[1], days[2]) == 2  # nothing differs, nothing is written
    assert tables.commits.latest() == before


def test_broken_loads_store_nothing_and_run_again(spark, tmp_path, monkeypatch):
    tables = _with_stock(spark, tmp_path)
    rows = _bars(spark, dict(zip(_days("2024-01", 2, 3), (10, 11))))
    for target, name in ((Tables, "_written"), (Tables, "_summed_up"), (Commits, "publish")):
        with monkeypatch.context() as patch:
            patch.setattr(target, name, lambda *a, **k: (_ for _ in ()).throw(OSError("broken off")))
            with pytest.raises(OSError):
                tables.insert_charts(rows)
        assert tables.read("charts").isEmpty() and tables.calendar().isEmpty()
    assert tables.insert_charts(rows).inserted == 2


def test_files_of_a_month_are_few_and_counts_are_right(spark, tmp_path):
    tables = _with_stock(spark, tmp_path, [(i, str(i)) for i in range(40)])
    rows = spark.range(40 * 59).select(
        (F.col("id") % 40).cast("string").alias("ticker"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), F.floor(F.col("id") / 40).cast("int")).alias("chart_date"),
        *(F.col("id").alias(f"chart_{x}") for x in ("open", "high", "low", "close", "volume", "turnover")))
    unknown = rows.limit(5).withColumn("ticker", F.lit("nobody"))
    batch = rows.unionByName(rows.where("ticker < '3'")).unionByName(unknown).repartition(200)
    twice = rows.where("ticker < '3'").count()
    stats = tables.insert_charts(batch)
    assert (stats.total, stats.inserted) == (40 * 59 + twice + 5, 40 * 59)
    files = tables.read("charts").inputFiles()
    assert len(files) == 2 and len({os.path.dirname(f) for f in files}) == 2
    assert tables.insert_charts(batch).inserted == 0
    assert tables.read("charts").count() == 40 * 59
    assert tables.read("charts").select("chart_id").distinct().count() == 40 * 59


def test_files_are_cut_by_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables_module, "ROWS_A_FILE", 10)
    tables = _with_stock(spark, tmp_path)
    tables.insert_charts(_bars(spark, {dt.date(2024, 1, d): d for d in range(1, 26)}))
    assert len(tables.read("charts").inputFiles()) == 3
    tables.insert_charts(_bars(spark, {dt.date(2024, 1, 30): 3}))
    monkeypatch.setattr(tables_module, "ROWS_A_FILE", 1000)
    assert len(tables.read("charts").inputFiles()) == 4
    before = sorted(tables.read("charts").collect())
    tables.compact("charts", dt.date(2024, 1, 5), dt.date(2024, 1, 5))
    assert len(tables.read("charts").inputFiles()) == 1
    assert sorted(tables.read("charts").collect()) == before


def test_ids_under_simultaneous_loads(spark, tmp_path, monkeypatch):
    """Another load adds names between this one's reading and its commit."""
    mine, other = Tables(spark, str(tmp_path)), Tables(spark, str(tmp_path))
    kind = "sector_name string"
    written, calls = Tables._written, []

    def interrupted(self, name, rows):
        folders = written(self, name, rows)
        if self is mine and not calls:
            calls.append(name)
            other.insert_sectors(spark.createDataFrame([("b",), ("c",)], kind))
        return folders

    monkeypatch.setattr(Tables, "_written", interrupted)
    added = mine.insert_sectors(spark.createDataFrame([("a",), ("b",)], kind))
    assert [r.sector_name for r in added.collect()] == ["a"]
    rows = mine.read("sectors").collect()
    assert sorted(r.sector_name for r in rows) == ["a", "b", "c"]
    assert sorted(r.sector_id for r in rows) == [1, 2, 3]


def test_simultaneous_loads_of_the_same_bars(spark, tmp_path, monkeypatch):
    mine = _with_stock(spark, tmp_path)
    other = Tables(spark, str(tmp_path))
    days = _days("2024-01", 2, 3, 4)
    written, calls = Tables._written, []

    def interrupted(self, name, rows):
        folders = written(self, name, rows)
        if self is mine and name == "charts" and not calls:
            calls.append(name)
            other.insert_charts(_bars(spark, {days[0]: 10, days[1]: 20}))
        return folders

    monkeypatch.setattr(Tables, "_written", interrupted)
    stats = mine.insert_charts(_bars(spark, {days[1]: 20, days[2]: 30}))
    assert (stats.total, stats.inserted) == (2, 1)
    assert _changes(mine) == {days[0]: None, days[1]: 100.0, days[2]: 50.0}
    assert mine.calendar().first().bars == 3


def test_gives_up_after_some_attempts(spark, tmp_path, monkeypatch):
    tables, calls = Tables(spark, str(tmp_path)), []

    def conflict(*_):
        calls.append(1)
        raise Conflict("always")

    monkeypatch.setattr(Commits, "publish", conflict)
    with pytest.raises(Conflict):
        tables.insert_sectors(spark.createDataFrame([("a",)], "sector_name string"))
    assert len(calls) == tables_module.ATTEMPTS


def test_late_bars_mend_the_changes_after_them(spark, tmp_path):
    tables = _with_stock(spark, tmp_path)
    days = _days("2023-12", 29) + _days("2024-01", 2, 3) + _days("2024-02", 1)
    tables.insert_charts(_bars(spark, {days[0]: 100, days[1]: 110, days[3]: 99}))
    assert _changes(tables)[days[3]] == pytest.approx(-10.0)
    tables.insert_charts(_bars(spark, {days[2]: 90}), days[2], days[2])
    assert _changes(tables) == {
        days[0]: None, days[1]: pytest.approx(10.0), days[2]: pytest.approx(-100 * 20 / 110), days[3]: pytest.approx(10.0)}
    net = {r.chart_date: r.net for r in tables.net_advances().collect()}
    assert net == {days[0]: 0, days[1]: 1, days[2]: -1, days[3]: 1}
    months = {r[MONTH]: (r.bars, r.first_date, r.last_date, r.last_close) for r in tables.calendar().collect()}
    assert months[dt.date(2024, 1, 1)] == (2, days[1], days[2], 90)


def test_zero_and_null_closes(spark, tmp_path):
    tables = _with_stock(spark, tmp_path)
    days = _days("2024-01", 2, 3, 4, 5)
    tables.insert_charts(_bars(spark, dict(zip(days, (0, 5, None, 6)))))
    assert _changes(tables) == {days[0]: None, days[1]: None, days[2]: None, days[3]: None}
    assert {r.chart_date: r.net for r in tables.net_advances().collect()} == dict(zip(days, (0, 1, 0, 0)))


def test_summaries_become_one_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables_module, "SUMMARY_FOLDERS", 3)
    tables = _with_stock(spark, tmp_path)
    for i, day in enumerate(_days("2024-01", 2, 3, 4, 5, 8), 1):
        tables.insert_charts(_bars(spark, {day: i}), day, day)
    state = tables.commits.latest()
    assert len(state.of("chart_calendar")) == len(state.of("net_advances")) == 2
    row = tables.calendar().first()
    assert (row.bars, row.first_date, row.last_date, row.last_close) == (5, dt.date(2024, 1, 2), dt.date(2024, 1, 8), 5)
    assert sorted(r.net for r in tables.net_advances().collect()) == [0, 1, 1, 1, 1]


def test_empty_loads(spark, tmp_path):
    tables = _with_stock(spark, tmp_path)
    before = tables.commits.latest()
    stats = tables.insert_charts(_bars(spark, {dt.date(2024, 1, 1): 1}).limit(0))
    assert (stats.total, stats.inserted) == (0, 0)
    stats = tables.insert_charts(_bars(spark, {dt.date(2024, 1, 1): 1}, "nobody"))
    assert (stats.total, stats.inserted) == (1, 0)
    assert tables.commits.latest() == before
