"""Named columns of an indicator run: expressions over a bar and the ones before it.

An indicator adds the columns it needs by name; equal ones are computed once. Columns
built on other columns go to a later ``withColumns``. All share one partitioning and order.
"""

import re

from pyspark.sql import DataFrame, functions as F

from ohlcraft.functions.frames import HISTORY

_ORDER = f"PARTITION BY {', '.join(HISTORY)} ORDER BY chart_date"


class Columns:
    def __init__(self) -> None:
        self._steps: list[dict[str, str]] = []
        self._step_of: dict[str, int] = {}

    def let(self, name: str, sql: str) -> str:
        if name not in self._step_of:
            needs = [self._step_of[word] for word in re.findall(r"\w+", sql)
                     if word in self._step_of]
            step = 1 + max(needs, default=-1)
            if step == len(self._steps):
                self._steps.append({})
            self._steps[step][name] = sql
            self._step_of[name] = step
        return name

    def lag(self, x: str, k: int = 1) -> str:
        return self.let(f"{x}_lag{k}", f"lag({x}, {k}) OVER ({_ORDER})")

    def add_to(self, bars: DataFrame) -> DataFrame:
        for step in self._steps:
            bars = bars.withColumns({name: F.expr(sql) for name, sql in step.items()})
        return bars
