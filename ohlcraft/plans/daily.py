"""The once-a-day run and the refresh of the dimensions."""

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from ohlcraft.operators import detect, merge
from ohlcraft.operators.indicators.compute import chosen_families, failed_families, indicators
from ohlcraft.operators.indicators.families import FAMILIES, LINE_NAMES
from ohlcraft.plans.tables import MONTH, LoadStats, Step, Tables, month_of
from ohlcraft.sources import bars as bar_source, symbols as symbol_source

@dataclass(frozen=True)
class DailyReport:
    had_session: bool
    charts: LoadStats
    changes: int = 0
    patterns: LoadStats | None = None
    indicators: LoadStats | None = None
    #: Families that raised and were left out; the others' values are stored.
    failed: tuple[str, ...] = ()


def load_bars(
    tables: Tables, raw: DataFrame, symbols: DataFrame, start: dt.date, end: dt.date,
    step: Step | None = None,
) -> LoadStats:
    """Store the raw bars of the symbols in the range, with their changes."""
    rows = bar_source.chart_rows(bar_source.bars_in_range(raw, symbols, start, end))
    return tables.insert_charts(rows, start, end, step)


def store_patterns(
    tables: Tables, start: dt.date, end: dt.date, emit: str = "range", step: Step | None = None,
) -> LoadStats:
    hits = detect.detect_patterns(
        tables.charts_in_reach(start, end), start, end, emit=emit, keep=("chart_date",))
    hits = hits.select("pattern_id", "chart_id", month_of(F.col("chart_date")).alias(MONTH))
    earliest = start if emit == "range" else None
    return tables.insert_patterns(hits, earliest, end, step)


def store_indicators(
    tables: Tables, start: dt.date, end: dt.date, names: Iterable[str] | None = None,
    anchor: str = "bar", step: Step | None = None,
) -> tuple[LoadStats, tuple[str, ...]]:
    """Stores the lines of the families; also returns the families that raised."""
    names = [family.name for family in chosen_families(names)]
    tables.register_lines([line for name in names for line in LINE_NAMES[name]])
    breadth = tables.net_advances() if any(FAMILIES[name].by_date for name in names) else None
    charts, failed = tables.charts_in_reach(start, end), []

    def wide(with_stored_lines: Callable[[DataFrame], DataFrame]) -> DataFrame:
        failed.append(Observation())
        found = indicators(
            with_stored_lines(charts), names, start, end, anchor=anchor, keep=("chart_date", merge.STORED),
            breadth=breadth, failed=failed[-1])
        return found.withColumn(MONTH, month_of(F.col("chart_date"))).drop("chart_date")

    stats = tables.insert_wide_indicators(wide, start, end, step)
    return stats, tuple(failed_families(failed[-1]))


def run_name(start: dt.date, end: dt.date, names: Iterable[str] | None) -> str:
    """What a run is called in the journal: its range and families."""
    chosen = "all" if names is None else ",".join(sorted(set(names)))
    return f"{start}..{end} {chosen}"


def run_daily(
    tables: Tables, raw: DataFrame, symbols: DataFrame, start: dt.date, end: dt.date,
    names: Iterable[str] | None = None, session_symbol: str | None = None,
) -> DailyReport:
    """Load the bars of the range, then store changes, patterns and indicators.

    A closed market is reported and does not stop the run; a range without any chart does.

    The journal holds the steps of a run that broke off, each committed with its rows. Run again,
    it loads again; if that stores no new bars, the steps that were done are left out.
    """
    tables.tidy()
    names = None if names is None else list(names)
    run = run_name(start, end, names)
    if session_symbol is None:
        had_session = True
    else:
        had_session = bar_source.had_session(raw, session_symbol, end).first()[0]
    charts = load_bars(tables, raw, symbols, start, end, (run, "load"))
    done = dict(tables.commits.latest().journal.get(run, {}))
    in_range = tables.read("charts", start, end).where(F.col("chart_date").between(start, end))
    if in_range.isEmpty():
        tables.finish(run)
        return DailyReport(had_session, charts)

    def step(name: str, work: Callable[[Step], object]):
        return done[name] if name in done else work((run, name))

    def stats(found) -> LoadStats:
        return found if isinstance(found, LoadStats) else LoadStats(*found)

    charts = stats(done["load"])
    changes = step("changes", lambda s: tables.update_changes(start, end, s))
    step("charts mark", lambda s: tables.set_latest_date("charts", end, s))
    patterns = stats(step("patterns", lambda s: store_patterns(tables, start, end, step=s)))
    failed = ()
    values = done.get("indicators")
    if values is None:
        values, failed = store_indicators(tables, start, end, names, step=(run, "indicators"))
    tables.set_latest_date("daily_indicators", end, finished=run)
    return DailyReport(had_session, charts, changes, patterns, stats(values), failed)


def refresh_dimensions(
    tables: Tables, symbols: DataFrame, listing: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """Add new sectors, then new stocks; returns both."""
    sectors = tables.insert_sectors(symbol_source.listed_sectors(symbols, listing))
    stocks = tables.insert_stocks(symbol_source.listed_stocks(symbols, listing))
    return sectors, stocks
