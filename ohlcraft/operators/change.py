"""Percentage change against the previous bar."""

from pyspark.sql import DataFrame, functions as F

from ohlcraft.functions import frames


def change_percentage(bars: DataFrame, start=None, end=None) -> DataFrame:
    """Sets ``chart_change_percentage`` of every bar in the range that has a previous bar.

    The previous close comes from the whole history given. Bars outside the range, first
    bars and bars after a zero close keep the value they had (null where there was none).
    """
    columns = [c for c in bars.columns if c != "chart_change_percentage"]
    if "chart_change_percentage" not in bars.columns:
        bars = bars.withColumn("chart_change_percentage", F.lit(None).cast("double"))
    in_range = F.lit(True)
    if start is not None:
        in_range = in_range & (F.col("chart_date") >= start)
    if end is not None:
        in_range = in_range & (F.col("chart_date") <= end)
    previous = F.col("_previous").cast("double")
    change = F.try_divide(F.col("chart_close").cast("double") - previous, previous) * 100
    return (
        bars.withColumn("_previous", frames.back("chart_close", 1))
        .withColumn(
            "chart_change_percentage",
            F.when(in_range & F.col("_previous").isNotNull() & (F.col("_previous") != 0), change)
            .otherwise(F.col("chart_change_percentage")))
        .select(*columns, "chart_change_percentage"))
