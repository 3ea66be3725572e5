"""Per-bar quantities the candlestick patterns are written in."""

from pyspark.sql import DataFrame, functions as F

from ohlcraft.functions import frames
from ohlcraft.functions.logic import holds

LAGS = 8
BODY_AVERAGE = 20
DOJI_ROWS = 20


def with_shapes(bars: DataFrame) -> DataFrame:
    """Adds ``o h l c``, body, range, body ends and the doji flag of each bar."""
    o, h, l, c = (F.col(x) for x in "ohlc")
    return (
        bars.withColumnsRenamed({
            "chart_open": "o", "chart_high": "h", "chart_low": "l", "chart_close": "c"})
        .withColumns({
            "body": F.abs(o - c),
            "range": h - l,
            "top": F.greatest(o, c),
            "bottom": F.least(o, c),
        })
        .withColumn("doji", holds(F.col("body") < F.col("range") * 0.05)))


def with_trends(shaped: DataFrame) -> DataFrame:
    """Adds ``up`` and ``down``: 5-row mean beyond the 10-row mean, and none of the last
    five closes on the wrong side of the close nine rows ago.

    Closes are integers, so the means are compared exactly by their sums. Both flags need
    ten closes.
    """
    five, ten = frames.rows_back(5), frames.rows_back(10)
    sums = shaped.withColumns({
        "_sum5": F.sum("c").over(five),
        "_sum10": F.sum("c").over(ten),
        "_closes": F.count("c").over(ten),
        "_min5": F.min("c").over(five),
        "_max5": F.max("c").over(five),
        "_c9": frames.back("c", 9),
    })
    full = F.col("_closes") == 10
    return sums.withColumns({
        "up": holds(full & (2 * F.col("_sum5") > F.col("_sum10")) & (F.col("_min5") >= F.col("_c9"))),
        "down": holds(full & (2 * F.col("_sum5") < F.col("_sum10")) & (F.col("_max5") <= F.col("_c9"))),
    }).drop("_sum5", "_sum10", "_closes", "_min5", "_max5", "_c9")


def with_lags(trended: DataFrame) -> DataFrame:
    """Adds earlier rows as ``o1``, ``c2``, ``up1`` … and the frames over earlier rows.

    Only what a query uses is computed: Catalyst prunes the other window columns.
    """
    lagged = {f"{x}{k}": frames.back(x, k) for x in "ohlc" for k in range(1, LAGS + 1)}
    flags = {f"{x}{k}": holds(frames.back(x, k)) for x in ("up", "down", "doji") for k in (1, 2)}
    twenty = frames.rows_back(DOJI_ROWS)
    prior_twenty = frames.rows_back(DOJI_ROWS, skip=1)
    return trended.withColumns({
        **lagged,
        **flags,
        # mean body of the 20 bars that end two bars ago
        "usual_body": frames.mean("body", BODY_AVERAGE, skip=2),
        "dojis": F.count_if("doji").over(twenty),
        "low20": F.min("l").over(twenty),
        "high20": F.max("h").over(twenty),
        "prior_low20": F.min("l").over(prior_twenty),
        "prior_high20": F.max("h").over(prior_twenty),
    })


def with_windows(lagged: DataFrame) -> DataFrame:
    """Adds the gap flags ``rising`` and ``falling`` and their values up to two rows ago,
    the earlier bodies, and the 20-row extremes as of one and two rows ago."""
    gaps = {}
    for k in range(3):
        at, before = ("" if k == 0 else str(k)), str(k + 1)
        gaps[f"rising{at}"] = holds(F.col(f"l{at}") > F.col(f"h{before}"))
        gaps[f"falling{at}"] = holds(F.col(f"h{at}") < F.col(f"l{before}"))
    bodies = {}
    for k in range(1, LAGS + 1):
        o, c = F.col(f"o{k}"), F.col(f"c{k}")
        bodies |= {f"body{k}": F.abs(o - c), f"top{k}": F.greatest(o, c),
                   f"bottom{k}": F.least(o, c)}
    extremes = {f"{x}_{k}": frames.back(x, k)
                for x in ("low20", "high20", "prior_low20", "prior_high20") for k in (1, 2)}
    return lagged.withColumns(extremes).withColumns({**gaps, **bodies})


def measured(bars: DataFrame) -> DataFrame:
    """All quantities of each bar."""
    return with_windows(with_lags(with_trends(with_shapes(bars))))
