"""Compute indicator families for all stocks."""

import datetime as dt
import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, functions as F

from ohlcraft.functions import frames
from ohlcraft.operators import history
from ohlcraft.operators.history import WARMUP
from ohlcraft.operators.indicators import slices
from ohlcraft.operators.indicators.columns import Columns
from ohlcraft.operators.indicators.families import FAMILIES, LINE_NAMES, Family

log = logging.getLogger(__name__)


def chosen_families(names: Iterable[str] | None) -> list[Family]:
    """Families by name; an unknown name is logged and left out, a repeated one kept once."""
    if names is None:
        return list(FAMILIES.values())
    known = []
    for name in dict.fromkeys(names):
        if name in FAMILIES:
            known.append(FAMILIES[name])
        else:
            log.warning("no indicator family %r, skipped", name)
    return known


def _with_lines(
    bars: DataFrame, families: list[Family], ids: list[str], anchor: str, strict: bool,
) -> DataFrame:
    """Columns ``ids``, the families' lines and the bits of those that failed, for the rows
    flagged ``_emit``.

    One Arrow pass over the sorted partitions computes all families, so together they cost one
    shuffle and one sort.
    """
    table, inputs, failed = Columns(), {}, 0
    for family in families:
        try:
            inputs[family.name] = family.inputs(table)
        except Exception as error:
            if strict:
                raise RuntimeError(f"indicator family {family.name!r} failed") from error
            log.exception("indicator family %r left out", family.name)
            failed |= slices.family_bit(family.name)
    column_of = dict(zip(
        (name for family in inputs for name in LINE_NAMES[family]), slices.slice_columns(inputs)))
    order = [name for family in families for name in LINE_NAMES[family.name]]
    bars = table.add_to(bars).withColumn("_position", F.row_number().over(frames.in_order()))
    by_anchor = slices.lines_by_bar if anchor == "bar" else slices.lines_by_range
    return by_anchor(bars, inputs, ids, strict).select(
        *ids, *((F.col(column_of[name]) if name in column_of else F.lit(None).cast("double")).alias(name)
                for name in order),
        F.col(slices.FAILED).bitwiseOR(F.lit(failed).cast("long")).alias(slices.FAILED))


def failed_families(failed: Observation) -> list[str]:
    """The families that :func:`indicators` had to leave out, once its rows have been used."""
    bits = failed.get.get("failed") or 0
    return [name for name in FAMILIES if bits & slices.family_bit(name)]


def indicators(
    bars: DataFrame, names: Iterable[str] | None = None,
    start: dt.date | None = None, end: dt.date | None = None, *,
    anchor: str = "bar", keep: tuple[str, ...] = (), breadth_bars: DataFrame | None = None,
    breadth: DataFrame | None = None, failed: Observation | None = None, strict: bool = False,
) -> DataFrame:
    """Wide frame: ``chart_id``, the bars' columns named in ``keep``, and one column per
    indicator line.

    A bar has a row if 60 bars of its stock precede it and it lies in the range.
    ``anchor="bar"`` computes a bar's recursive lines from the 61 bars that end with it.
    ``anchor="range"`` starts them once, 60 bars ahead of the stock's first bar in the
    range, for the stocks that have these 60; without ``start`` at the stock's first bar.
    ``breadth_bars`` are the bars whose net advances count for the families of the whole
    market (see ``history.market_bars``); the given ones unless said. ``breadth`` gives these
    net advances themselves, by date.

    A family that raises has empty lines, and the others go on; ``failed`` observes which ones
    did (:func:`failed_families`). ``strict`` is for results that cannot name them: one that raises
    then fails the whole.
    """
    if anchor not in ("bar", "range"):
        raise ValueError(f"anchor must be 'bar' or 'range', not {anchor!r}")
    families = chosen_families(names)
    own = [f for f in families if not f.by_date]
    shared = [f for f in families if f.by_date]

    ids = ["chart_id", *keep]
    market = (bars if breadth_bars is None else breadth_bars).select(
        "stock_id", "chart_date", F.col("chart_close").alias("c"))
    bars = bars.select(
        *dict.fromkeys(("chart_id", "stock_id", "chart_date", *keep)), F.col("chart_open").alias("o"),
        F.col("chart_high").alias("h"), F.col("chart_low").alias("l"),
        F.col("chart_close").alias("c"), F.col("chart_volume").alias("v"))
    if end is not None:
        bars, market = (x.where(F.col("chart_date") <= end) for x in (bars, market))
    sliced = history.numbered(bars)
    emitted = F.col("bar_no") > WARMUP
    if start is not None:
        emitted = emitted & (F.col("chart_date") >= start)
        if anchor == "range":
            sliced = history.range_slice(sliced, start)
        else:  # no frame reaches further back
            sliced = history.in_reach(sliced, start)
    wide = _with_lines(
        sliced.withColumn("_emit", emitted), own,
        list(dict.fromkeys([*ids, *(["chart_date"] if shared else [])])), anchor, strict)
    if shared:
        if breadth is None:
            breadth = net_advances(market)
        elif end is not None:
            breadth = breadth.where(F.col("chart_date") <= end)
        by_date = _breadth(breadth, shared, start, anchor, strict).withColumnRenamed(slices.FAILED, "_failed_by_date")
        bits = F.col(slices.FAILED).bitwiseOR(F.coalesce("_failed_by_date", F.lit(0).cast("long")))
        # one row per calendar date meets the wide rows where they are: they are not shuffled
        wide = wide.join(F.broadcast(by_date), "chart_date", "left").select(
            *ids, *(F.col(frames.quoted(name)) for f in own + shared for name in LINE_NAMES[f.name]),
            bits.alias(slices.FAILED))
    if failed is not None:
        wide = wide.observe(failed, F.bit_or(slices.FAILED).alias("failed"))
    return wide.drop(slices.FAILED)


def net_advances(bars: DataFrame) -> DataFrame:
    """Per date, the number of stocks that rose minus those that fell."""
    return (
        bars.withColumn("_change", F.col("c") - frames.back("c", 1))
        .groupBy("chart_date")
        .agg(F.coalesce(F.sum(F.signum("_change")), F.lit(0.0)).alias("net")))


def _breadth(
    net: DataFrame, families: list[Family], start: dt.date | None, anchor: str, strict: bool,
) -> DataFrame:
    # One row per calendar date: small however many stocks there are.
    dates = history.numbered(net.withColumn("stock_id", F.lit(0)))
    if anchor == "range" and start is not None:
        dates = history.range_slice(dates, start)
    dates = dates.withColumn("_emit", F.col("bar_no") > WARMUP)
    return _with_lines(dates, families, ["chart_date"], anchor, strict)
