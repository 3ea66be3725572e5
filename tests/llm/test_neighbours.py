"""Nearest neighbours against all inner products."""

import numpy as np
import pytest

from ohlcraft.llm import neighbours


def _expected(rows, k, every):
    valid = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v
             and np.isfinite(np.array(v, float)).all() and any(v)}
    found = {}
    for query in valid:
        if query % every == 0:
            scores = sorted((-float(np.dot(valid[query], v)), i) for i, v in valid.items() if i != query)
            found[query] = [i for _, i in scores[:k]]
    return found


def _found(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append(r.vec_id)
    return found


def test_recall_and_copies(spark):
    draw = np.random.default_rng(6)
    base = draw.standard_normal((500, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    base[100:200] = base[100]  # a hot vector
    rows = [(i, v.astype(np.float32).astype(float).tolist()) for i, v in enumerate(base)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = neighbours.nearest(frame).collect()
    expected, got = _expected(rows, 20, 20), _found(found)
    assert got.keys() == expected.keys() and all(len(v) == 20 for v in got.values())
    hits = [len(set(got[q]) & set(expected[q])) / 20 for q in expected]
    assert np.mean(hits) >= 0.97 and got[120][:19] == [i for i in range(100, 119)]
    vectors = dict(rows)
    for r in found:
        assert abs(r.score - float(np.dot(vectors[r.query_id], vectors[r.vec_id]))) < 1e-12


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (None, [1.0, 1.0]), (20, [1.0, 0.0]), (21, [-1.0, 3.0]), (21, [-1.0, 3.0])]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, node int")
    assert _found(neighbours.nearest(frame, k=3).collect()) == _expected(rows, 3, 20)
    assert neighbours.nearest(frame.limit(0)).count() == 0
    one = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")
    assert neighbours.nearest(one).count() == 0


@pytest.mark.parametrize("partitions", [1, 64, 211])
def test_small_tables_on_many_partitions(spark, partitions):
    """Nothing is lost where partitions hold one vector or none."""
    draw = np.random.default_rng(8)
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(partitions)}
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        for n in (2, 15):
            rows = [(i, v.astype(np.float32).astype(float).tolist()) for i, v in enumerate(draw.standard_normal((n, 6)))]
            frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(partitions)
            settings = neighbours.Settings(passes=2, rounds=1)
            assert _found(neighbours.nearest(frame, settings=settings).collect()) == _expected(rows, 20, 20)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_first_graph_has_even_blocks(spark):
    draw = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.standard_normal((300, 8)))]
    settings = neighbours.Settings(passes=1, block=32, neighbours=5)
    nodes = neighbours._nodes(spark.createDataFrame(rows, "vec_id long, vector array<double>"), 3)
    codes = neighbours.stage(neighbours._rounded(nodes, settings), "codes")
    edges = [neighbours._first_graph(codes.repartition(n), settings).collect() for n in (1, 50)]
    assert sorted(edges[0]) == sorted(edges[1]) and len(edges[0]) == 300 * 5
