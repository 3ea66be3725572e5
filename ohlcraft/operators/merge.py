"""What a load adds to or changes in a table, as DataFrames."""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

from ohlcraft.functions import scalar
from ohlcraft.functions.frames import quoted

NUMBERING_BUCKETS = 1024
#: The bits of the lines stored for a chart, see :func:`with_stored_lines`.
STORED = "_words"


def one_per_key(
    rows: DataFrame, keys: list[str], order_by: str | None = None, last: bool = False,
) -> DataFrame:
    """One row per key, the first (or last) in ``order_by``, and in ``_rows`` how many there
    were.

    Without an order it is the smallest (largest) row, so that a task run again picks the
    same one. Rows of a key are combined before the shuffle, however many there are.
    """
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    if len(others) == 1:
        picked = F.max(others[0]) if last else F.min(others[0])
        return rows.groupBy(*keys).agg(picked.alias(others[0]), F.count("*").alias("_rows")).select(
            *rows.columns, "_rows")
    first = [order_by] if order_by else []
    ranked = F.struct(*first, *(c for c in others if c not in first))
    picked = rows.groupBy(*keys).agg(
        (F.max(ranked) if last else F.min(ranked)).alias("_row"), F.count("*").alias("_rows"))
    return picked.select(*(c if c in keys else F.col("_row")[c].alias(c) for c in rows.columns),
                         "_rows")


def marked_new(
    target: DataFrame, incoming: DataFrame, keys: list[str], order_by: str | None = None,
) -> DataFrame:
    """One incoming row per key with ``_rows`` and, in ``_new``, whether the target lacks it.

    A row with a null key is not new: it can not be identified.
    """
    known = target.select(*keys).withColumn("_known", F.lit(True))
    identified = F.lit(True)
    for key in keys:
        identified = identified & F.col(key).isNotNull()
    return (
        one_per_key(incoming, keys, order_by).join(known, keys, "left")
        .withColumn("_new", identified & F.col("_known").isNull())
        .drop("_known"))


def new_rows(
    target: DataFrame, incoming: DataFrame, keys: list[str], order_by: str | None = None,
) -> DataFrame:
    """Incoming rows whose key the target lacks, one per key."""
    return (
        one_per_key(incoming, keys, order_by)
        .join(target.select(*keys), keys, "left_anti")
        .dropna(subset=keys)
        .select(*incoming.columns))


def with_inserts(
    target: DataFrame, incoming: DataFrame, keys: list[str], order_by: str | None = None,
) -> DataFrame:
    """The target after an insert that ignores keys it already has."""
    added = new_rows(target, incoming, keys, order_by)
    return target.unionByName(added.select(*target.columns))


def load_stats(marked: DataFrame) -> DataFrame:
    """One row ``(total, inserted, skipped)`` of a load, from :func:`marked_new`."""
    return marked.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"),
        F.count_if("_new").alias("inserted"),
    ).withColumn("skipped", F.col("total") - F.col("inserted"))


def upserted(
    target: DataFrame, incoming: DataFrame, keys: list[str], order_by: str | None = None,
) -> DataFrame:
    """Target rows replaced by the incoming ones of equal key, and the other incoming rows.

    Of several incoming rows of a key the last in ``order_by`` counts.
    """
    latest = one_per_key(incoming, keys, order_by, last=True).select(*target.columns)
    return target.join(latest.select(*keys), keys, "left_anti").unionByName(latest)


def with_new_ids(rows: DataFrame, id_column: str, keys: list[str], after: int) -> DataFrame:
    """Consecutive ids after ``after`` for rows that differ in ``keys``.

    Rows are numbered inside hash buckets, and the buckets' offsets come from their counts,
    so no task sees all rows.
    """
    bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(NUMBERING_BUCKETS)))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n")).select(
        "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    number = F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys))
    return (
        bucketed.join(F.broadcast(offsets), "_bucket")
        .withColumn(id_column, (F.lit(after) + F.col("_offset") + number).cast("long"))
        .drop("_bucket", "_offset"))


def high_water_mark(marks: DataFrame, name: str, day) -> DataFrame:
    """The marks with the date of ``name`` set; an unknown name changes nothing."""
    return marks.withColumn(
        "latest_date",
        F.when(F.col("latest_date_name") == name, F.lit(day).cast("date"))
        .otherwise(F.col("latest_date")))


def new_sectors(existing: DataFrame, listed: DataFrame) -> DataFrame:
    """Sector names that are not in the table yet."""
    return (
        listed.select("sector_name").distinct()
        .join(existing.select("sector_name"), "sector_name", "left_anti"))


def new_stocks(existing: DataFrame, listed: DataFrame) -> DataFrame:
    """Distinct ``(ticker, stock_name, sector_name)`` whose stock name is not there yet."""
    return (
        listed.select("ticker", "stock_name", "sector_name").distinct()
        .join(existing.select("stock_name"), "stock_name", "left_anti")
        .select("ticker", "stock_name", "sector_name"))


def new_charts(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming charts with ``_new``, true for one row per stock and date that is not known;
    these have the change from the stock's previous bar, known or new, and its direction.

    ``known`` holds (stock_id, chart_date, chart_close) of the range and of each stock's last
    bar before it. One shuffle and one sort by stock do it all: a known row comes before incoming
    ones of its date, and of these the smallest counts, so that a task run again picks
    the same. Rows without stock or date are not new, and are spread over the tasks.
    """
    others = [c for c in incoming.columns if c not in ("stock_id", "chart_date", "chart_change_percentage")]
    given = incoming.select("stock_id", "chart_date", *others).withColumn("_known", F.lit(False))
    both = given.unionByName(
        known.select("stock_id", "chart_date", "chart_close").withColumn("_known", F.lit(True)),
        allowMissingColumns=True)
    nameless = F.col("stock_id").isNull() | F.col("chart_date").isNull()
    both = both.withColumn("_spread", F.when(nameless, F.pmod(F.xxhash64(*others), F.lit(NUMBERING_BUCKETS))).otherwise(0))
    history = Window.partitionBy("stock_id", "_spread").orderBy("chart_date", F.desc("_known"), *others)
    both = both.withColumn("_first", ~F.col("chart_date").eqNullSafe(F.lag("chart_date").over(history)))
    earlier = history.rowsBetween(Window.unboundedPreceding, -1)
    # in a struct, as a null close is a previous one, too
    close = F.last(F.when(F.col("_first"), F.struct("chart_close")), ignorenulls=True).over(earlier)
    both = both.withColumns({
        "_new": F.col("_first") & ~F.col("_known") & ~nameless, "_previous": close["chart_close"]})
    previous = F.col("_previous").cast("double")
    change = F.try_divide(F.col("chart_close").cast("double") - previous, previous) * 100
    return (
        both.where(~F.col("_known"))
        .select(
            "stock_id", "chart_date", *others,
            F.when(F.col("_previous") != 0, change).alias("chart_change_percentage"),
            direction(F.col("chart_close"), F.col("_previous")).alias("chart_direction"), "_new",
            F.lit(1).cast("long").alias("_rows")))


def direction(close: Column, previous: Column) -> Column:
    """1, 0 or -1 as the close rose, stayed or fell; 0 without a previous one."""
    return F.coalesce(F.signum(close.cast("double") - previous.cast("double")), F.lit(0)).cast("int")


# -- lines stored per chart, as bits ---------------------------------------------------

def word_count(line_ids) -> int:
    return max(line_ids, default=0) // 64 + 1


def stored_lines(values: DataFrame, line_ids, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per chart the ids of its lines with a value, as bits: ``chart_id``, the columns of
    ``keep``, ``words``."""
    line = F.col("indicator_line_id")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (line % 64).cast("int"))
    words = [F.bit_or(F.when(F.floor(line / 64) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"_word{w}")
             for w in range(word_count(line_ids))]
    return values.groupBy("chart_id", *keep).agg(*words).select(
        "chart_id", *keep, F.array(*(f"_word{w}" for w in range(len(words)))).alias("words"))


def joined_lines(stored: DataFrame, line_ids) -> DataFrame:
    """Per chart the lines of all its loads."""
    words = [F.bit_or(F.coalesce(F.get("words", F.lit(w)), F.lit(0).cast("long"))).alias(f"_word{w}")
             for w in range(word_count(line_ids))]
    return stored.groupBy("chart_id").agg(*words).select(
        "chart_id", F.array(*(f"_word{w}" for w in range(len(words)))).alias(STORED))


def with_stored_lines(charts: DataFrame, stored: DataFrame, line_ids) -> DataFrame:
    """Charts with the lines stored for them, null where there are none.

    Kept by ``indicators``, this column spares :func:`new_line_values` its join: what is shuffled
    by chart is then the chart, not the values of all its lines.
    """
    return charts.join(joined_lines(stored, line_ids), "chart_id", "left")


def new_line_values(
    stored: DataFrame | None, wide: DataFrame, line_ids: dict[str, int], keep: tuple[str, ...] = (),
) -> DataFrame:
    """Charts with the values of the lines that are not stored for them yet, before the melt:
    ``chart_id``, the columns of ``keep``, ``_values`` (by line in the order of
    ``line_ids``, null unless new), ``_rows`` (all values) and ``_inserted`` (the new ones).

    ``wide`` has a row per chart; its other columns are lines. Lines without an id are not
    new. Nothing is shuffled or sorted by line or value. Without ``stored`` the rows of ``wide``
    carry their stored lines (:func:`with_stored_lines`), and are not shuffled at all.
    """
    kinds = dict(wide.dtypes)

    def number(name: str) -> Column:
        value = F.col(quoted(name))
        return F.nullif(value, F.lit(float("nan"))) if kinds[name] == "double" else scalar.number_or_null(value)

    def some(columns: list[Column]) -> Column:
        return reduce(add, (F.when(c.isNotNull(), 1).otherwise(0) for c in columns), F.lit(0)).cast("long")

    def unstored(name: str) -> Column:
        word = F.coalesce(F.get(STORED, F.lit(line_ids[name] // 64)), F.lit(0).cast("long"))
        return F.shiftrightunsigned(word, line_ids[name] % 64).bitwiseAND(F.lit(1).cast("long")) == 0

    carried = [] if stored is not None else [STORED]
    names = [c for c in wide.columns if c not in ("chart_id", *keep, *carried)]
    told = [name for name in line_ids if name in names]
    ids = ["chart_id", *keep]
    numbers = wide.select(*ids, *carried, *(number(c).alias(f"_line{i}") for i, c in enumerate(names)))
    at = {name: F.col(f"_line{i}") for i, name in enumerate(names)}
    if stored is not None:
        numbers = with_stored_lines(numbers, stored, line_ids.values())
    fresh = numbers.select(
        *ids, some(list(at.values())).alias("_rows"),
        *(F.when(unstored(name), at[name]).alias(f"_new{i}") for i, name in enumerate(told)))
    values = [F.col(f"_new{i}") for i in range(len(told))]
    return fresh.select(
        *ids, F.array(*values).cast("array<double>").alias("_values"), "_rows", some(values).alias("_inserted"))


def melted(new: DataFrame, wide: DataFrame, line_ids: dict[str, int], keep: tuple[str, ...] = ()) -> DataFrame:
    """The new values of :func:`new_line_values`, a row each."""
    told = [i for name, i in line_ids.items() if name in wide.columns and name not in ("chart_id", *keep)]
    ids = F.array(*(F.lit(i).cast("int") for i in told))
    # outer: of others the planner infers a filter on all lines, whose variants are 2 ^ lines
    return (
        new.select("chart_id", *keep, F.posexplode_outer("_values").alias("_line", "daily_indicator_value"))
        .where(F.col("daily_indicator_value").isNotNull())
        .select("chart_id", ids[F.col("_line")].alias("indicator_line_id"), "daily_indicator_value", *keep))
