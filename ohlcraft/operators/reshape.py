"""Wide indicator rows to long ones."""

from pyspark.sql import Column, DataFrame, functions as F

from ohlcraft.functions import scalar
from ohlcraft.functions.frames import quoted


def indicators_long(
    wide: DataFrame, keep: tuple[str, ...] = (), ordered: bool = False,
) -> DataFrame:
    """``(chart_id, daily_indicator_value, indicator_line_name)`` without empty values.

    Every column but ``chart_id`` and those in ``keep`` is a line; text that is no number
    counts as empty.
    """
    ids = ["chart_id", *keep]
    lines = [c for c in wide.columns if c not in ids]
    # One array and one pass over it: an unpivot would project the whole row once per line.
    kinds = dict(wide.dtypes)

    def number(name: str) -> Column:
        value = F.col(quoted(name))
        if kinds[name] == "double":
            return F.nullif(value, F.lit(float("nan")))
        return scalar.number_or_null(value)

    values = F.array(*(number(c) for c in lines))
    names = F.array(*(F.lit(c) for c in lines))
    long = (
        wide.select(*ids, F.posexplode(values).alias("_line", "daily_indicator_value"))
        .where(F.col("daily_indicator_value").isNotNull())
        .select(*ids, "daily_indicator_value",
                names[F.col("_line")].alias("indicator_line_name")))
    return long.orderBy("chart_id", "indicator_line_name") if ordered else long
