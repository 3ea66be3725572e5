"""Indicator families on sorted bars: Arrow batches in, one array call per family and chunk.

Only the 60 rows before a batch are held over to the next one, so memory does not depend
on how many bars a stock has.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ohlcraft.functions.frames import HISTORY
from ohlcraft.operators.history import WARMUP
from ohlcraft.operators.indicators.families import FAMILIES, LINE_NAMES, Run

CHUNK = 2048
#: Rows ahead of the look-back that frames inside a recursion's input need.
EDGE = 10
_EMIT, _POSITION, _DATE = "_emit", "_position", "chart_date"
#: A bit for each family that raised on a row's batch; its lines are empty there.
FAILED = "_failed"


@dataclass(frozen=True)
class Call:
    """A family's lines: the function, its inputs, how many lines it gives, its bit if it fails,
    or whether it must not."""
    name: str
    lines: Callable
    inputs: list[str]
    count: int
    bit: int
    strict: bool


@dataclass(frozen=True)
class _Held:
    """Of a slice that goes on: its last rows, and each family's recursions before the last 60."""
    table: pa.Table
    states: list[list[np.ndarray]]


def family_bit(name: str) -> int:
    return 1 << list(FAMILIES).index(name)


def _values(table: pa.Table, name: str) -> np.ndarray:
    return table[name].cast(pa.float64()).to_numpy()


def _finite(values: np.ndarray) -> pa.Array:
    return pa.array(values, from_pandas=True)


def _call(call: Call, arrays: list[np.ndarray], run: Run) -> tuple[list[np.ndarray], int]:
    """The lines and 0, or empty lines and the family's bit: one that fails leaves the others be,
    unless the call is strict."""
    keep = int(run)
    try:
        with np.errstate(invalid="ignore"):
            found = [line[-keep:] for line in call.lines(run, *arrays)]
        if len(found) != call.count:
            raise ValueError(f"{len(found)} lines instead of {call.count}")
        return found, 0
    except Exception as error:
        if call.strict:
            raise RuntimeError(f"indicator family {call.name!r} failed") from error
        return [np.full((keep, arrays[0].shape[1]), np.nan)] * call.count, call.bit


def _bar_slices(calls: list[Call]) -> Callable:
    """Per batch: a slice of 61 rows for every bar to emit; the lines and the bits of what failed."""
    back = np.arange(-WARMUP, 1)[:, None]

    def lines(table: pa.Table, ends: np.ndarray) -> tuple[list[np.ndarray], int]:
        position = table[_POSITION].to_numpy()
        if not (position[ends - WARMUP] == position[ends] - WARMUP).all():
            raise ValueError("bars are not sorted by stock, part and date")
        columns = {name: _values(table, name) for call in calls for name in call.inputs}
        parts, failed = [], 0
        for at in range(0, len(ends), CHUNK):
            rows = ends[at:at + CHUNK] + back
            gathered = {name: values[rows] for name, values in columns.items()}
            part = []
            for call in calls:
                found, bit = _call(call, [gathered[name] for name in call.inputs], Run(1))
                part += [line[0] for line in found]
                failed |= bit
            parts.append(part)
        return [np.concatenate(line) for line in zip(*parts)], failed

    return lines


def slice_columns(inputs: dict[str, list[str]]) -> list[str]:
    """Plain column names, one per line of each family; Python tasks take no dotted ones."""
    count = sum(len(LINE_NAMES[family]) for family in inputs)
    return [f"_slice_{i}" for i in range(count)]


def _prepared(bars: DataFrame, inputs: dict[str, list[str]], carry_on: list[str], strict: bool, *more: str):
    """The columns to hand over, the inputs under names that cannot clash, and the schema
    of the result."""
    needed = dict.fromkeys(name for names in inputs.values() for name in names)
    source = bars.select(
        *(F.col(name) for name in carry_on), _EMIT, *more,
        *(F.col(name).cast("double").alias(f"_in_{name}") for name in needed))
    schema = T.StructType(
        [source.schema[name] for name in carry_on]
        + [T.StructField(name, T.DoubleType()) for name in slice_columns(inputs)]
        + [T.StructField(FAILED, T.LongType())])
    calls = [Call(family, FAMILIES[family].slice_lines, [f"_in_{n}" for n in names], len(LINE_NAMES[family]),
                  family_bit(family), strict) for family, names in inputs.items()]
    return source, calls, schema


def _with_lines(table, carry_on, rows, names, lines, failed) -> pa.Table:
    out = table.select(carry_on).take(pa.array(rows))
    for name, values in zip(names, lines):
        out = out.append_column(name, _finite(values))
    return out.append_column(FAILED, pa.array(np.full(len(rows), failed, np.int64))).combine_chunks()


def lines_by_bar(
    bars: DataFrame, inputs: dict[str, list[str]], carry_on: list[str], strict: bool = False,
) -> DataFrame:
    """Columns ``carry_on`` and the families' lines of the bars flagged ``_emit``, each
    computed from the 61 bars that end with it.

    ``bars`` must come out of a window over the parts of the stocks; ``_position`` counts the
    rows of a part from 1.
    """
    ordered = bars.sortWithinPartitions(*HISTORY, _DATE)
    source, calls, schema = _prepared(ordered, inputs, carry_on, strict, _POSITION)
    names = slice_columns(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines_of = _bar_slices(calls)
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            seen = 0
            if held is not None:
                seen, table = held.num_rows, pa.concat_tables([held, table])
            emit = table[_EMIT].to_numpy() & (table[_POSITION].to_numpy() > WARMUP)
            emit[:seen] = False
            ends = np.flatnonzero(emit)
            if len(ends):
                out = _with_lines(table, carry_on, ends, names, *lines_of(table, ends))
                yield from out.to_batches()
            held = table.slice(max(0, table.num_rows - WARMUP)).combine_chunks()

    return source.mapInArrow(run, schema)


def _alike(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """The slices in groups whose longest is at most twice as long as the shortest."""
    order = np.argsort(lengths, kind="stable")
    while len(order):
        n = np.searchsorted(lengths[order], 2 * lengths[order[0]], "right")
        yield order[:n]
        order = order[n:]


def lines_by_range(
    bars: DataFrame, inputs: dict[str, list[str]], carry_on: list[str], strict: bool = False,
) -> DataFrame:
    """Like :func:`lines_by_bar`, but each stock is one slice from its first row on.

    A batch holds many slices; those of similar length are computed side by side, so that
    padding at most doubles them. Of the last one, which the batch may have cut, the look-back
    and the state of its recursions are held over, however long it is.
    """
    ordered = bars.sortWithinPartitions(*HISTORY, _DATE)
    source, calls, schema = _prepared(ordered, inputs, carry_on, strict, _POSITION)
    names = slice_columns(inputs)

    def finished(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Slices that begin and end in the table."""
        position = table[_POSITION].to_numpy()
        starts = np.flatnonzero(position == 1)
        of = np.cumsum(position == 1) - 1
        emit = np.flatnonzero(table[_EMIT].to_numpy() & (position > WARMUP))
        if not len(emit):
            return
        lines, failed = [np.full(len(emit), np.nan) for _ in names], 0
        lengths = np.diff([*starts, table.num_rows])
        for alike in _alike(lengths):
            place = np.full(len(starts), -1)
            place[alike] = np.arange(len(alike))
            mine = np.flatnonzero(place[of[emit]] >= 0)
            if not len(mine):
                continue
            steps = np.arange(lengths[alike].max())[:, None]
            rows = np.minimum(starts[alike] + steps, table.num_rows - 1)
            outside = steps >= lengths[alike]

            def side_by_side(column: str) -> np.ndarray:
                return np.where(outside, np.nan, _values(table, column)[rows])

            at = (position[emit[mine]] - 1 - WARMUP, place[of[emit[mine]]])
            found = []
            for call in calls:
                own, bit = _call(call, [side_by_side(c) for c in call.inputs], Run(len(steps) - WARMUP))
                found += own
                failed |= bit
            for line, values in zip(lines, found):
                line[mine] = values[at]
        yield from _with_lines(table, carry_on, emit, names, lines, failed).to_batches()

    def part(table: pa.Table, before: _Held | None) -> tuple[pa.Table, _Held]:
        """The lines of a part of one slice, which begins with what was held of it, and what to
        hold of it now."""
        seen = before.table.num_rows if before else WARMUP
        keep = table.num_rows - seen
        position = table[_POSITION].to_numpy()
        lines, failed, left = [], 0, []
        for i, call in enumerate(calls):
            run = Run(keep, tail=WARMUP) if not before else Run(
                keep, before.states[i], before.table.num_rows - WARMUP, int(position[0]) - 1, WARMUP)
            # a family that failed on an earlier part has no state to go on from
            own, bit = _call(call, [_values(table, c)[:, None] for c in call.inputs], run)
            lines += [line[:, 0] for line in own]
            failed |= bit
            left.append([] if bit else run.left)
        emit = np.flatnonzero(table[_EMIT].to_numpy()[seen:])
        out = _with_lines(table, carry_on, emit + seen, names, [line[emit] for line in lines], failed)
        return out, _Held(table.slice(max(0, table.num_rows - WARMUP - EDGE)).combine_chunks(), left)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: pa.Table | None = None  # of a slice of which nothing was computed yet
        held: _Held | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held or rows is not None:
                table = pa.concat_tables([held.table if held else rows, table])
            starts = np.flatnonzero(table[_POSITION].to_numpy() == 1).tolist()
            if held:
                # held rows may begin the slice, too
                end = next((start for start in starts if start), table.num_rows)
                if end > held.table.num_rows:
                    out, held = part(table.slice(0, end), held)
                    yield from out.to_batches()
                if end == table.num_rows:
                    continue
                table, starts, held = table.slice(end), [s - end for s in starts if s >= end], None
            if not starts:
                continue
            yield from finished(table.slice(0, starts[-1]))
            rows = table.slice(starts[-1]).combine_chunks()
            if rows.num_rows > WARMUP:
                out, held = part(rows, None)
                rows = None
                yield from out.to_batches()

    return source.mapInArrow(run, schema)
