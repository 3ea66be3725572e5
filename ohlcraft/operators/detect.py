"""Detect candlestick patterns over all stocks in one pass."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ohlcraft.operators import candles, history
from ohlcraft.operators.patterns import PATTERNS, STRICT_PRIOR


def detect_patterns(
    bars: DataFrame, start=None, end=None, *, only: Iterable[int] | None = None,
    emit: str = "range", strict_prior: bool = False, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Hits as ``(chart_id, pattern_id)`` and the bars' columns named in ``keep``.

    With ``start``, a stock is looked at only if 60 bars precede its first bar in the
    range. ``emit="range"`` gives the hits of bars in the range, ``emit="slice"`` also
    those of the 60 bars before it, judged on nothing older. Without ``start`` every bar
    is in the range and no stock is left out.
    """
    if emit not in ("range", "slice"):
        raise ValueError(f"emit must be 'range' or 'slice', not {emit!r}")
    if emit == "slice" and start is None:
        raise ValueError("emit='slice' needs a start date")
    chosen = dict(PATTERNS)
    if strict_prior:
        chosen.update(STRICT_PRIOR)
    if only is not None:
        chosen = {pattern_id: chosen[pattern_id] for pattern_id in only}

    ids = ("chart_id", *keep)
    bars = bars.select(
        *dict.fromkeys(("chart_id", "stock_id", "chart_date", *keep)), "chart_open",
        "chart_high", "chart_low", "chart_close")
    if end is not None:
        bars = bars.where(F.col("chart_date") <= end)
    emitted = F.lit(True)
    if start is not None:
        bars = history.range_slice(history.numbered(bars), start)
        if emit == "range":
            emitted = F.col("chart_date") >= start
    hits = [F.expr(f"CASE WHEN {p.condition} THEN {p.pattern_id} END") for p in chosen.values()]
    return (
        candles.measured(bars)
        .where(emitted)
        .select(*ids, F.explode(F.array_compact(F.array(*hits))).alias("pattern_id")))


def trend_flags(bars: DataFrame) -> DataFrame:
    """Trend, gap and doji flags of each bar, with the doji count of its last 20 rows."""
    return (
        candles.measured(bars)
        .select("chart_id", "up", "down", "rising", "falling", "doji", "dojis"))
