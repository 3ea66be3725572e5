"""Mixing against a loop over the sources."""

import re
import tracemalloc
from collections import defaultdict
from itertools import product

from ohlcraft.llm import common, mixing, queries
from tests.conftest import SF_DIR


def _targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, left, target = share * sum(sizes.values()), set(names), {}
    while left:
        unit = budget / sum(weight[s] for s in left)
        over = {s for s in left if unit * weight[s] >= cap * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in left}
        target |= {s: cap * sizes[s] for s in over}
        budget -= sum(cap * sizes[s] for s in over)
        left -= over
    return target


def _check(rows, docs, tolerance):
    assert len(rows) == len(docs)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    words = {i: len(re.findall(common.WORD, text or "")) for i, text, _ in docs}
    source = {i: s for i, _, s in docs}
    for row in rows:
        assert row["size"] == words[row.doc_id] and row.taken in (0, row["size"], 2 * row["size"])
        sizes[source[row.doc_id]] += row["size"]
        taken[source[row.doc_id]] += row.taken
        target[source[row.doc_id]] = row.target
    for row in rows:
        assert row.source_size == sizes[source[row.doc_id]]
    expected = _targets(sizes)
    for name in sizes:
        assert abs(target[name] - expected[name]) <= 1e-9 * max(1, expected[name])
        assert abs(taken[name] - target[name]) <= tolerance


def test_whole_table_meets_its_targets_and_reruns_agree(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = queries.op2_subset_sum_mixing(spark, SF_DIR).collect()
    _check(rows, docs, 40)
    again = queries.op2_subset_sum_mixing(spark, SF_DIR).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_odd_rows(spark):
    docs = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (4, "x", "ä"), (5, "x\x0by z", "z"), (6, "w " * 90, "b"),
            *((i, "same size", "hot") for i in range(10, 90))]
    frame = spark.createDataFrame([(*d, 0, 0) for d in docs], "doc_id long, text string, source string, size int, rank int")
    _check(mixing.mix_counts(frame).collect(), docs, 90)
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_counts(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None), (None, "", "a")], "doc_id long, text string, source string")
    assert {(r.taken, r.target) for r in mixing.mix_counts(blank).collect()} == {(0, 0.0)}


def test_fit_is_a_subset_near_the_budget():
    for sizes, counts in (([3, 5, 7], [2, 1, 2]), ([4], [3]), ([10, 11], [5, 5]), ([0, 2], [4, 1])):
        sums = {sum(s * n for s, n in zip(sizes, ns)) for ns in product(*(range(c + 1) for c in counts))}
        for budget in range(max(sums) + 1):
            taken = mixing.fit_counts(sizes, counts, budget)
            assert all(0 <= t <= c for t, c in zip(taken, counts))
            got = sum(s * t for s, t in zip(sizes, taken))
            assert got in sums and abs(budget - got) == min(abs(budget - x) for x in sums)
    many = mixing.fit_counts(list(range(1, 400)), [30] * 399, 1_000_003)
    assert sum(s * n for s, n in zip(range(1, 400), many)) == 1_000_003


def test_one_very_long_text_needs_little_memory():
    """2000 lengths of 500 documents, and a text of 5 million words."""
    sizes, counts = [*range(1, 2001), 5_000_000], [500] * 2000 + [1]
    budget = 0.7 * sum(s * c for s, c in zip(sizes, counts))
    tracemalloc.start()
    try:
        taken = mixing.fit_counts(sizes, counts, budget)
        assert tracemalloc.get_traced_memory()[1] < 500_000_000
    finally:
        tracemalloc.stop()
    assert sum(s * t for s, t in zip(sizes, taken)) == round(budget)
    assert all(0 <= t <= c for t, c in zip(taken, counts))
