"""Mixing sources to target weights by subset-sum fitting.

Each source's words are fitted to its target without looking at single documents: its whole
documents are taken as often as the target allows, and the rest of the budget is a bounded
subset sum over its counts of documents by exact length. Every length first gives its
share of all but a reserve of a few longest documents; the reserve and what rounding leaves
are fitted by dynamic programming over the lengths and their remaining counts. Which documents of a length are taken follows
from a seeded order.
"""

import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ohlcraft.llm.common import n_words, new_name, numbered, stage

SEED = 20_011
#: Words left to the dynamic programme, in longest documents of the source.
RESERVE = 8


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Rows (key, source, source_size) with their target.

    The sources by code point, null last, have the weights in turn. Together they get ``share``
    of all sizes; none gets more than ``cap`` of its own, and what it can't take goes to the
    others by weight. In order of size per weight, a source is capped if the level of
    water, once all before it are capped, reaches its cap. One row per source.
    """
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (place % len(weights) + 1).cast("int")))
    rows = rows.withColumns({
        "cap": cap * F.col("source_size").cast("double"),
        "budget": share * F.sum("source_size").over(everything).cast("double"),
        "all_weights": F.sum("weight").over(everything)})
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    none = F.lit(0.0)
    rows = rows.withColumn(
        "level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), none))
        / (F.col("all_weights") - F.coalesce(F.sum("weight").over(before), none)))
    capped = F.col("level") * F.col("weight") >= F.col("cap")
    level = F.max(F.when(~capped, F.col("level"))).over(everything)
    return rows.select(
        "key", "source", "source_size",
        F.when(capped, F.col("cap")).otherwise(F.col("weight") * level).alias("target"))


def fit_counts(sizes: list[int], counts: list[int], budget: float) -> list[int]:
    """How many documents of each size to take so that their words come to the budget.

    All but RESERVE times the longest document is shared out by length; the rest is fitted.
    """
    total = sum(s * c for s, c in zip(sizes, counts))
    taken = [0] * len(sizes)
    if not total:
        return taken
    order = [i for i, s in enumerate(sizes) if s]
    longest, owed = max(sizes), 0.0
    share = max(0.0, min(1.0, (budget - RESERVE * longest) / total))
    for i in order:
        owed += sizes[i] * counts[i] * share
        taken[i] = min(counts[i], int(owed / sizes[i]))
        owed -= sizes[i] * taken[i]
    goal = round(budget - sum(s * t for s, t in zip(sizes, taken)))
    random.Random(SEED).shuffle(order)  # else short documents would fill the rest
    steps, kept, final = _reached(sizes, [c - t for c, t in zip(counts, taken)], order, goal, goal + longest)
    below = (final & ((1 << (goal + 1)) - 1)).bit_length() - 1
    above = final >> goal
    above = goal + (above & -above).bit_length() - 1 if above else 2 * goal + 1
    at = below if goal - below <= above - goal else above
    for i, times in _way_back(sizes, steps, kept, at, goal + longest):
        taken[i] += times
    return taken


def _reached(
    sizes: list[int], left: list[int], order: list[int], goal: int, most: int,
) -> tuple[list[tuple[int, int]], dict[int, int], int]:
    """The programme's steps (which size, how many), the sums that could be reached before some of
    the steps, and after all: bit b says that some of the documents have b words together.

    Sums are kept before every k-th step, k growing with the steps so that about as many are kept
    as lie between two; the others are formed again on the way back. So memory grows with the
    square root of the steps.
    """
    mask, sums, steps, kept, stride = (1 << (most + 1)) - 1, 1, [], {}, 1
    for i in order:
        rest, times = min(left[i], most // sizes[i]), 1
        while rest and not sums >> goal & 1:
            times = min(times, rest)
            if len(steps) % stride == 0:
                kept[len(steps)] = sums
                if len(kept) > 2 * stride:
                    stride *= 2
                    kept = {n: s for n, s in kept.items() if n % stride == 0}
            steps.append((i, times))
            sums |= (sums << (times * sizes[i])) & mask
            rest, times = rest - times, 2 * times
    return steps, kept, sums


def _way_back(
    sizes: list[int], steps: list[tuple[int, int]], kept: dict[int, int], at: int, most: int,
) -> Iterator[tuple[int, int]]:
    """The steps that make up the sum ``at``, last first: those without which it can't be reached."""
    mask, end = (1 << (most + 1)) - 1, len(steps)
    for first in sorted(kept, reverse=True):
        before = [kept[first]]
        for i, times in steps[first:end - 1]:
            before.append(before[-1] | (before[-1] << (times * sizes[i])) & mask)
        for n in range(end - 1, first - 1, -1):
            i, times = steps[n]
            if not before[n - first] >> at & 1:
                yield i, times
                at -= times * sizes[i]
        end = first


def _fit_source(cap: float):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ignore_index=True)
        sizes, counts = rows["size"].tolist(), rows["n"].tolist()
        total, target = int(rows["source_size"][0]), float(rows["target"][0])
        whole = min(math.floor(target / total), math.floor(cap)) if total else 0
        more = fit_counts(sizes, counts, target - whole * total) if whole < math.floor(cap) else [0] * len(sizes)
        return pd.DataFrame({
            "key": rows["key"], "size": rows["size"], "source_size": rows["source_size"], "target": rows["target"],
            "whole": np.int64(whole), "more": np.array(more, dtype=np.int64)})
    return fit


def unit_hash(*columns: Column) -> Column:
    """From 0 to below 1, by the columns' hash."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / float(1 << 53)


def mix_counts(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
    seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, copies, taken (size * copies), and
    ``row_col`` of ``docs`` as row, if given.

    Null text: no words, never taken. Null source: a source of its own, the last one. Rows with
    equal ids stand side by side in the seeded order and are taken one by one. Empty table: no
    rows. Other columns are not read. A source's table of lengths, not its documents,
    is what one task fits; the documents are numbered over many tasks.
    """
    row = [F.col(row_col).alias("row")] if row_col else []
    rows = docs.select(
        *row, F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
    rows = stage(rows.withColumns({
        "key": F.coalesce(F.concat(F.lit("source "), F.col("source").cast("string")), F.lit("none")),
        "draw": unit_hash(F.lit(seed), F.col("doc_id"))}), "sizes")
    targets = source_targets(
        rows.groupBy("key", "source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    lengths = rows.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n"))
    fitted = lengths.join(targets.drop("source"), "key").groupBy("key").applyInPandas(
        _fit_source(cap), "key string, size long, source_size long, target double, whole long, more long")
    ranked = numbered(rows.drop("source"), ["key", "size"], ["draw", "doc_id"], "rank")
    copies = F.col("whole") + (F.col("rank") < F.col("more")).cast("long")
    return ranked.join(fitted, ["key", "size"]).select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"),
        (F.col("size") * copies).alias("taken"), *(["row"] if row_col else []))


def mixed_documents(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
    seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix itself: each row of ``docs``, all columns as they are, as often as it is taken."""
    name = new_name(docs)
    numbered_docs = stage(docs.withColumn(name, F.monotonically_increasing_id()), "to-mix")
    taken = mix_counts(numbered_docs, weights, share, cap, seed, id_col, text_col, source_col, name)
    times = new_name(numbered_docs)
    taken = taken.where("copies > 0").select(F.col("row").alias(name), F.col("copies").cast("int").alias(times))
    rows = numbered_docs.join(taken, name)
    again = rows.withColumn(times, F.explode(F.array_repeat(F.lit(0), F.col(times))))
    return again.select(docs.columns)
