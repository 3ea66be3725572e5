"""The result tables as Parquet folders, and the loads that keep them free of duplicates.

A load writes its rows once, into a folder of its own, and a commit makes them part of the table
(see ``plans.commits``). A break at any step leaves the tables as they were; a load that broke
off can be run again. If another load has changed what this one compared its rows with, it
compares and writes again. Nothing is written into folders that a reader may have open.

Tables with a chart per row are partitioned by month, and a load looks only at the months it may
touch. Beside the tables loads keep a calendar of each stock's bars by month, the net advances
of each date and the lines stored for each chart; they are committed together with the rows that
they sum up.
"""

import datetime as dt
import functools
import logging
import tempfile
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ohlcraft import schema
from ohlcraft.functions import frames
from ohlcraft.operators import history, lookup, merge
from ohlcraft.plans.commits import Change, Commits, Conflict, State

log = logging.getLogger(__name__)

MONTH = "chart_month"
# a stock's charts are numbered by the day, counted from year 1: fewer than 2^22 days
DAYS_PER_STOCK = 1 << 22
#: Most rows of a file of a table by month.
ROWS_A_FILE = 4_000_000
#: Folders of a summary that one load makes one of.
SUMMARY_FOLDERS = 32
#: How often a load compares and writes again because others were first.
ATTEMPTS = 5
#: A run's step: the names of the run and the step.
Step = tuple[str, str]


@dataclass(frozen=True)
class LoadStats:
    total: int
    inserted: int

    @property
    def skipped(self) -> int:
        return self.total - self.inserted


def shared_folder(spark: SparkSession) -> str:
    """The folder all nodes share. Only a local session without one gets its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all nodes share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ohlcraft-"))
    return context.getCheckpointDir()


def month_of(date: Column) -> Column:
    return F.trunc(date, "month")


def chart_id_of(stock_id: Column, date: Column) -> Column:
    """Id of a chart from its natural key: the same for every run, without coordination."""
    return stock_id * DAYS_PER_STOCK + F.datediff(date, F.lit("0001-01-01").cast("date"))


def _month_in(folder: str) -> dt.date:
    return dt.date.fromisoformat(folder.rsplit("=", 1)[1])


def _again_on_conflict(load: Callable) -> Callable:
    @functools.wraps(load)
    def run(*args, **options):
        for attempt in range(1, ATTEMPTS):
            try:
                return load(*args, **options)
            except Conflict as conflict:
                log.warning("%s, attempt %d: %s", load.__name__, attempt, conflict)
        return load(*args, **options)
    return run


class Tables:
    """The eight tables under one root folder, and what loads keep beside them."""

    SCHEMAS = {
        "sectors": schema.SECTORS,
        "stocks": schema.STOCKS,
        "charts": schema.CHARTS,
        "market_caps": schema.MARKET_CAPS,
        "pattern_records": schema.PATTERN_RECORDS,
        "indicators_lines": schema.INDICATOR_LINES,
        "daily_indicators": schema.DAILY_INDICATORS,
        "latest_date": schema.LATEST_DATE,
        "chart_calendar": schema.CHART_CALENDAR,
        "net_advances": schema.NET_ADVANCES,
        "stored_lines": schema.STORED_LINES,
    }
    BY_MONTH = ("charts", "pattern_records", "daily_indicators", "stored_lines")
    #: Columns that files have beside those of the table.
    HIDDEN = {"charts": schema._schema(chart_direction=schema.INT)}

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.commits = Commits(spark, self.root)

    # -- reading ----------------------------------------------------------------------

    def read(
        self, name: str, start: dt.date | None = None, end: dt.date | None = None, *,
        seen: State | None = None, months: Iterable[dt.date] | None = None, hidden: bool = False,
    ) -> DataFrame:
        """A table as the last commit has it, or as ``seen`` has; of a table by month only the
        months from ``start`` to ``end``, or the given ones. Other folders are not even listed."""
        folders = (seen or self.commits.latest()).of(name)
        if name in self.BY_MONTH:
            wanted = None if months is None else set(months)
            folders = [
                f for f in folders if (wanted is None or _month_in(f) in wanted)
                and (start is None or _month_in(f) >= start.replace(day=1))
                and (end is None or _month_in(f) <= end)]
        return self._folders(name, folders, hidden)

    def _folders(self, name: str, folders: Iterable[str], hidden: bool = False) -> DataFrame:
        more = self.HIDDEN[name].fields if hidden else []
        month = [T.StructField(MONTH, T.DateType())] if name in self.BY_MONTH else []
        kind = T.StructType([*self.SCHEMAS[name].fields, *more, *month])
        folders = list(folders)
        if not folders:
            return self.spark.createDataFrame([], kind)
        # the load is a partition column, too, as its folder lies above the month's
        kinds = T.StructType([*kind.fields, T.StructField("load", T.StringType())])
        rows = self.spark.read.schema(kinds).option("basePath", f"{self.root}/{name}")
        return rows.parquet(*(f"{self.root}/{f}" for f in folders)).select(*kind.names)

    def calendar(self, seen: State | None = None) -> DataFrame:
        """Per stock and month its bars, first and last date and last close."""
        return history.calendar(self.read("chart_calendar", seen=seen))

    def net_advances(self, seen: State | None = None) -> DataFrame:
        """Per date ``net``, the stocks that rose less those that fell."""
        return self.read("net_advances", seen=seen).groupBy("chart_date").agg(
            F.sum("net").cast("double").alias("net"))

    def charts_in_reach(self, start: dt.date, end: dt.date, n: int = history.WARMUP) -> DataFrame:
        """The charts up to ``end`` of the stocks with charts in the range, from the month on that
        holds a stock's ``n``-th bar before it.

        Only months that some stock needs are read: their names come to the driver, one a month
        at most. The join that leaves a stock's earlier months out keeps the charts by stock.
        """
        seen = self.commits.latest()
        needed = history.reach(self.calendar(seen), start, end, n)
        since = needed.groupBy("stock_id").agg(F.min(MONTH).alias("_since"))
        months = [row[0] for row in needed.select(MONTH).distinct().collect()]
        charts = self.read("charts", end=end, seen=seen, months=months)
        return (
            charts.where(F.col("chart_date") <= end).join(since, "stock_id")
            .where(F.col(MONTH) >= F.col("_since")).drop("_since"))

    # -- writing ----------------------------------------------------------------------

    def _written(self, name: str, rows: DataFrame) -> list[str]:
        """Writes rows into a folder of their own; the folders that a commit has to name."""
        load = f"{name}/load={uuid.uuid4().hex}"
        writer = rows.write
        if name in self.BY_MONTH:
            writer = writer.partitionBy(MONTH).option("maxRecordsPerFile", ROWS_A_FILE)
        writer.parquet(f"{self.root}/{load}")
        if name not in self.BY_MONTH:
            return [load]
        names = sorted(status.getPath().getName() for status in self.commits.listed(load))
        folders = [f"{load}/{month}" for month in names if month.startswith(f"{MONTH}=")]
        if not folders:
            self.commits.delete(load)
        return folders

    def _written_new(self, name: str, marked: DataFrame, explode=None) -> tuple[list[str], LoadStats]:
        """Writes the rows marked ``_new`` (or those that ``explode`` makes of all rows) and counts.

        Rows of a month meet in few tasks, which Spark sizes; skipped ones come along as nulls,
        so that all are counted in the tasks that write, where a task run again counts once.
        """
        counts = Observation()
        if explode is None:
            marked = marked.withColumn("_inserted", F.col("_new").cast("long"))
            columns = [c for c in self._stored(name) if c != MONTH]
            marked = marked.select(MONTH, "_new", "_rows", "_inserted", *(
                F.when(F.col("_new"), F.col(c)).alias(c) for c in columns))
        dealt = marked.hint("rebalance", MONTH).observe(
            counts, F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"),
            F.coalesce(F.sum("_inserted"), F.lit(0)).alias("inserted"))
        rows = dealt.where("_new") if explode is None else explode(dealt)
        folders = self._written(name, rows.select(*self._stored(name)))
        return folders, LoadStats(counts.get["total"], counts.get["inserted"])

    def _stored(self, name: str) -> list[str]:
        hidden = self.HIDDEN.get(name, T.StructType()).names
        return [*self.SCHEMAS[name].names, *hidden, *([MONTH] if name in self.BY_MONTH else [])]

    def _summed_up(self, seen: State, name: str, added: DataFrame, joined: Callable) -> Change:
        """Adds rows to a summary; many small folders become one."""
        old = seen.of(name)
        if len(old) < SUMMARY_FOLDERS:
            return Change(add={name: self._written(name, added)})
        rows = joined(self.read(name, seen=seen).unionByName(added))
        return Change(add={name: self._written(name, rows)}, drop={name: list(old)})

    def append(self, name: str, rows: DataFrame) -> None:
        """Adds rows to a table without summaries, as they are."""
        self.commits.publish(self.commits.latest(), [], Change(add={name: self._written(name, rows)}))

    def replace(self, name: str, rows: DataFrame, seen: State, finished: str | None = None,
                step: Step | None = None) -> None:
        """Replace a table, as ``seen`` had it, by rows that may be derived from it."""
        self.commits.publish(seen, [name], Change(
            add={name: self._written(name, rows)}, drop={name: list(seen.of(name))},
            step=(*step, True) if step else None, finished=finished))

    @_again_on_conflict
    def compact(self, name: str, start: dt.date, end: dt.date) -> None:
        """Makes one folder of each month's, as loads of few rows leave many."""
        seen = self.commits.latest()
        rows = self.read(name, start, end, seen=seen, hidden=name in self.HIDDEN)
        added = self._written(name, rows.hint("rebalance", MONTH))
        months = {_month_in(f) for f in added}
        self.commits.publish(seen, [name], Change(
            add={name: added}, drop={name: [f for f in seen.of(name) if _month_in(f) in months]}))

    def tidy(self) -> None:
        """Removes folders that no recent commit names."""
        self.commits.tidy(self.SCHEMAS)

    # -- loads ------------------------------------------------------------------------

    @_again_on_conflict
    def insert_charts(
        self, rows: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
        step: Step | None = None,
    ) -> LoadStats:
        """Bars as ``sources.bars.chart_rows`` gives them, all between ``start`` and ``end``,
        with their changes; those of unknown tickers are counted as skipped, see
        ``lookup.mapped_and_rejected``.

        Bars that come after later ones of their stock also set the changes of those. ``step``:
        a run that begins with this load, if it stores anything or is not in the journal.
        """
        seen = self.commits.latest()
        mapped = lookup.with_stock_ids(rows, self.read("stocks", seen=seen))
        charts = mapped.select(
            chart_id_of(F.col("stock_id"), F.col("chart_date")).alias("chart_id"),
            *(c for c in schema.CHARTS.names if c in mapped.columns),
            month_of(F.col("chart_date")).alias(MONTH))
        calendar = self.calendar(seen)
        known = self.read("charts", start, end, seen=seen).select("stock_id", "chart_date", "chart_close")
        if start is not None:
            known = known.unionByName(history.previous_closes(calendar, start))
        folders, stats = self._written_new("charts", merge.new_charts(known, charts))
        change, late = Change(), None
        if folders:
            added = self._folders("charts", folders, hidden=True)
            months = history.month_calendar(added)
            change = self._summed_up(seen, "chart_calendar", months, history.calendar)
            net = self._summed_up(seen, "net_advances", _net_of(added), _net_of)
            change = Change({**change.add, **net.add, "charts": folders}, {**change.drop, **net.drop})
            late = (
                months.groupBy("stock_id").agg(F.min("first_date").alias("first"))
                .join(calendar.groupBy("stock_id").agg(F.max("last_date").alias("last")), "stock_id")
                .where("first < last").agg(F.min("first")).first()[0])
        if step and (stats.inserted or step[0] not in seen.journal):
            change.finished, change.step = step[0], (*step, [stats.total, stats.inserted])
        if folders or change.step:
            self.commits.publish(seen, ["charts"], change)
        if late:
            self.update_changes(late)
        return stats

    @_again_on_conflict
    def insert_patterns(
        self, hits: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
        step: Step | None = None,
    ) -> LoadStats:
        """Hits ``(pattern_id, chart_id, chart_month)``."""
        seen = self.commits.latest()
        marked = merge.marked_new(
            self.read("pattern_records", start, end, seen=seen), hits, ["pattern_id", "chart_id"])
        folders, stats = self._written_new("pattern_records", marked)
        return self._inserted(seen, "pattern_records", Change({"pattern_records": folders}), stats, step)

    def _inserted(self, seen: State, name: str, change: Change, stats: LoadStats, step: Step | None) -> LoadStats:
        if step:
            change.step = (*step, [stats.total, stats.inserted])
        if stats.inserted or step:
            self.commits.publish(seen, [name], change)
        return stats

    def _line_ids(self, seen: State) -> dict[str, int]:
        """Ids of the registered line names: a row per line comes to the driver."""
        lines = self.read("indicators_lines", seen=seen).collect()
        return {row.indicator_line_name: row.indicator_line_id for row in lines}

    def _values_inserted(self, seen: State, ids: dict[str, int], folders: list[str], stats, step) -> LoadStats:
        change = Change({"daily_indicators": folders})
        if folders:
            added = self._folders("daily_indicators", folders)
            change.add["stored_lines"] = self._written(
                "stored_lines", merge.stored_lines(added, ids.values(), (MONTH,)).hint("rebalance", MONTH))
        return self._inserted(seen, "stored_lines", change, stats, step)

    @_again_on_conflict
    def insert_indicators(
        self, long: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
    ) -> LoadStats:
        """Values ``(chart_id, indicator_line_name, daily_indicator_value, chart_month)`` in any
        order, compared one by one. Values of unknown line names are skipped."""
        seen = self.commits.latest()
        values = lookup.with_line_ids(long, self.read("indicators_lines", seen=seen), "left", MONTH)
        marked = merge.marked_new(
            self.read("daily_indicators", start, end, seen=seen), values, ["indicator_line_id", "chart_id"])
        folders, stats = self._written_new("daily_indicators", marked)
        return self._values_inserted(seen, self._line_ids(seen), folders, stats, None)

    @_again_on_conflict
    def insert_wide_indicators(
        self, wide: DataFrame | Callable[[Callable], DataFrame], start: dt.date | None = None,
        end: dt.date | None = None, step: Step | None = None,
    ) -> LoadStats:
        """Values of many lines, a row per chart: ``chart_id``, ``chart_month``, a column per
        line. They are compared with the lines stored for the chart, before the melt.

        ``wide`` may also be a function that computes them, anew for each attempt: it is given one
        that adds their stored lines to charts, and keeps these (``merge.STORED``). Then charts
        are shuffled to be compared, not their values."""
        seen = self.commits.latest()
        ids = self._line_ids(seen)
        stored = self.read("stored_lines", start, end, seen=seen)
        if not isinstance(wide, DataFrame):
            told = functools.partial(merge.with_stored_lines, stored=stored, line_ids=ids.values())
            wide, stored = wide(told), None
        new = merge.new_line_values(stored, wide, ids, (MONTH,))
        folders, stats = self._written_new(
            "daily_indicators", new, lambda rows: merge.melted(rows, wide, ids, (MONTH,)))
        return self._values_inserted(seen, ids, folders, stats, step)

    @_again_on_conflict
    def upsert_market_caps(self, caps: DataFrame, order_by: str | None = None) -> DataFrame:
        """Set the cap of each stock; raises for unknown tickers before anything changes.

        Of several rows of a stock the last in ``order_by`` counts. Returns the rows applied.
        """
        seen = self.commits.latest()
        mapped = lookup.market_caps_by_stock(caps, self.read("stocks", seen=seen), order_by)
        lookup.require_known(mapped, "stock_id", "ticker")
        new = mapped.select("stock_id", "cap", *([order_by] if order_by else []))
        self.replace("market_caps", merge.upserted(
            self.read("market_caps", seen=seen), new, ["stock_id"], order_by), seen)
        return mapped.select("symbol", "ticker", "stock_id", "cap")

    @_again_on_conflict
    def insert_sectors(self, listed: DataFrame) -> DataFrame:
        """Add sector names that are not there yet and return them."""
        seen = self.commits.latest()
        return self._add_with_ids(
            seen, "sectors", merge.new_sectors(self.read("sectors", seen=seen), listed),
            "sector_id", ["sector_name"])

    @_again_on_conflict
    def insert_stocks(self, listed: DataFrame) -> DataFrame:
        """Add stocks whose name is not there yet and return them; raises for unknown
        sectors before anything changes."""
        seen = self.commits.latest()
        new = merge.new_stocks(self.read("stocks", seen=seen), listed)
        named = lookup.stocks_with_sector_ids(new, self.read("sectors", seen=seen))
        lookup.require_known(named, "sector_id", "sector_name")
        return self._add_with_ids(
            seen, "stocks", named.select("ticker", "stock_name", "sector_id"), "stock_id",
            ["ticker", "stock_name", "sector_id"])

    @_again_on_conflict
    def register_lines(self, names: list[str]) -> None:
        """Add indicator line names that are not there yet."""
        seen = self.commits.latest()
        new = sorted(set(names) - self._line_ids(seen).keys())
        if new:
            rows = self.spark.createDataFrame([(n,) for n in new], "indicator_line_name string")
            self._add_with_ids(seen, "indicators_lines", rows, "indicator_line_id", ["indicator_line_name"])

    def _add_with_ids(
        self, seen: State, name: str, new: DataFrame, id_column: str, keys: list[str],
    ) -> DataFrame:
        """Adds rows with the ids after the last one that ``seen`` has: if another load has
        added some meanwhile, the commit fails."""
        last = self.read(name, seen=seen).agg(F.coalesce(F.max(id_column), F.lit(0))).first()[0]
        numbered = merge.with_new_ids(new, id_column, keys, last)
        folders = self._written(name, numbered.select(
            *(F.col(f.name).cast(f.dataType) for f in self.SCHEMAS[name].fields)))
        self.commits.publish(seen, [name], Change({name: folders}))
        return self._folders(name, folders)

    @_again_on_conflict
    def set_latest_date(
        self, name: str, day: dt.date, step: Step | None = None, finished: str | None = None,
    ) -> None:
        """Move the mark of a data set; an unknown name changes nothing."""
        seen = self.commits.latest()
        self.replace("latest_date", merge.high_water_mark(
            self.read("latest_date", seen=seen), name, day), seen, finished, step)

    def finish(self, run: str) -> None:
        """Takes a run out of the journal."""
        self.commits.publish(self.commits.latest(), [], Change(finished=run))

    @_again_on_conflict
    def update_changes(
        self, start: dt.date, end: dt.date | None = None, step: Step | None = None,
    ) -> int:
        """Recompute the change percentage of the charts from ``start`` to ``end``, or to the
        last; returns how many have one.

        Only months with a change that differs are written, all of them in one commit.
        """
        seen = self.commits.latest()
        charts = self.read("charts", start, end, seen=seen, hidden=True)
        before = history.previous_closes(self.calendar(seen), start)
        both = charts.unionByName(before, allowMissingColumns=True)
        in_range = F.col("chart_date") >= start
        if end is not None:
            in_range &= F.col("chart_date") <= end
        ratio = F.try_divide(F.col("chart_close").cast("double") - F.col("_previous").cast("double"),
                             F.col("_previous").cast("double")) * 100
        computed = both.withColumn("_previous", frames.back("chart_close", 1)).where(F.col("chart_id").isNotNull() & in_range).select(
            "chart_id", "chart_date", MONTH, "chart_change_percentage", "chart_direction",
            F.when(F.col("_previous") != 0, ratio).otherwise(F.col("chart_change_percentage")).alias("_change"),
            merge.direction(F.col("chart_close"), F.col("_previous")).alias("_direction"))
        differs = ~(F.col("_change").eqNullSafe(F.col("chart_change_percentage"))
                    & F.col("_direction").eqNullSafe(F.col("chart_direction")))
        # a name a month at most comes to the driver
        told = computed.agg(
            F.count_if(F.col("_change").isNotNull()).alias("n"),
            F.collect_set(F.when(differs, F.col(MONTH))).alias("months")).first()
        change = Change()
        if told.months:
            new = computed.where(differs)
            rows = self.read("charts", seen=seen, months=told.months, hidden=True).join(
                new.select("chart_id", "_change", "_direction"), "chart_id", "left")
            rows = rows.withColumns({
                "chart_change_percentage": F.coalesce("_change", "chart_change_percentage"),
                "chart_direction": F.coalesce("_direction", "chart_direction")})
            moved = new.select("chart_date", (F.col("_direction") - F.coalesce(
                "chart_direction", F.lit(0))).alias("chart_direction"))
            change = self._summed_up(seen, "net_advances", _net_of(moved), _net_of)
            change.add["charts"] = self._written(
                "charts", rows.select(*self._stored("charts")).hint("rebalance", MONTH))
            months = set(told.months)
            change.drop["charts"] = [f for f in seen.of("charts") if _month_in(f) in months]
        if step:
            change.step = (*step, told.n)
        if told.months or step:
            self.commits.publish(seen, ["charts"], change)
        return told.n


def _net_of(rows: DataFrame) -> DataFrame:
    """Net advances by date, of charts or of summary rows."""
    value = "chart_direction" if "chart_direction" in rows.columns else "net"
    return rows.groupBy("chart_date").agg(F.sum(value).cast("long").alias("net"))
