"""Nearest neighbours by NN-descent (Dong, Moses and Li, 2011) and greedy graph search.

The graph has an edge from each vector to its best neighbours found so far. A round joins every
vector's neighbours and those that it is a neighbour of, and compares them with one another:
neighbours of neighbours are likely neighbours. Only pairs with an edge that is new since the
last round are compared, and only scores above the worst of a neighbour list travel on. The
rounds run on vectors rounded to a byte per component; results are scored on the originals.

Queries start at nodes near them and walk the graph both ways: in each step a query's best
nodes that aren't expanded yet are, until its beam holds none.

Equal vectors are one node of the graph. A node stands for its smallest ids, as many as
a result may name, so that any number of copies costs no more.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ohlcraft.llm.common import numbered, stage


@dataclass(frozen=True)
class Settings:
    neighbours: int = 40
    #: Of those that a node is a neighbour of, so many take part in a round.
    back: int = 20
    #: Sorted passes that make the first graph, members of a block, and bits of a sort key.
    passes: int = 5
    block: int = 128
    bits: int = 16
    rounds: int = 8
    #: The rounds end when fewer than this share of the edges are new.
    settled: float = 0.02
    #: Nodes a query keeps and expands.
    beam: int = 96
    seed: int = 20_013


def _scored(spark_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("node", spark_type), T.StructField("near", spark_type), T.StructField("score", T.FloatType())])


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
        & F.exists("vector", lambda v: v != 0))
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    length = lengths.orderBy(F.desc("rows"), "n").limit(1)  # the commonest; one row
    return rows.join(F.broadcast(length), F.size("vector") == F.col("n")).select("vec_id", "vector")


def _nodes(rows: DataFrame, most: int) -> DataFrame:
    """A node per distinct vector: node (its smallest id), ids (its smallest ``most``), vector."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.distinct().withColumn("place", place).where(F.col("place") <= most)
    return few.groupBy("vector").agg(
        F.min("vec_id").alias("node"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _rounded(nodes: DataFrame, settings: Settings) -> DataFrame:
    """node, code (a float scale, then a byte per component), keys (a sort key for each pass)."""
    out = T.StructType([
        nodes.schema["node"], T.StructField("code", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(len(batch), -1)
            rng = np.random.Generator(np.random.PCG64(settings.seed))
            planes = rng.standard_normal((x.shape[1], settings.passes, settings.bits))
            signs = np.einsum("nd,dpb->npb", x, planes, optimize=True) > 0
            keys = signs @ (1 << np.arange(settings.bits))
            scale = np.abs(x).max(axis=1, keepdims=True) / 127
            raw = np.concatenate([
                scale.astype("<f4").view(np.int8), np.rint(x / scale).astype(np.int8)], axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([r.tobytes() for r in raw], pa.binary()),
                pa.array(keys.tolist(), pa.list_(pa.int64()))], names=out.names)

    return nodes.select("node", "vector").mapInArrow(code, out)


def _decoded(codes: pa.Array) -> np.ndarray:
    raw = np.frombuffer(b"".join(codes.to_pylist()), np.int8).reshape(len(codes), -1)
    return raw[:, 4:].astype(np.float32) * raw[:, :4].copy().view("<f4")


def _best(node: np.ndarray, near: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Places of each node's best ``most`` distinct candidates."""
    order = np.lexsort((near, -score, node))
    node, near = node[order], near[order]
    # a pair scores alike wherever it meets, so its repeats are neighbours
    first = np.ones(len(order), bool)
    first[1:] = (node[1:] != node[:-1]) | (near[1:] != near[:-1])
    order, node = order[first], node[first]
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.empty(0, int)
    place = np.arange(len(node)) - np.repeat(starts, np.diff([*starts, len(node)]))
    return order[place < most]


def _emit(node, near, score, kind: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(node), pa.array(near), pa.array(score.astype(np.float32))], names=kind.names)


def _first_graph(codes: DataFrame, settings: Settings) -> DataFrame:
    """Candidates from blocks of vectors that stand together by random planes' signs.

    Blocks are cut by the place in the whole order, whatever the partitions; they are of even size,
    from ``block`` members to less than twice as many, or one if there are fewer vectors.
    """
    kind = _scored(codes.schema["node"].dataType)
    blocks = max(1, codes.count() // settings.block)

    def compare(rows: pa.Table) -> pa.Table:
        ids, x = rows["node"].to_numpy(), _decoded(rows["code"].combine_chunks())
        most = min(settings.neighbours, len(ids) - 1)
        if most < 1:
            return pa.Table.from_batches([_emit(ids[:0], ids[:0], np.empty(0), kind)])
        order = np.argsort(ids)  # rows come in any order
        ids, x = ids[order], x[order]
        scores = x @ x.T
        np.fill_diagonal(scores, -np.inf)
        near = np.argpartition(-scores, most - 1, axis=1)[:, :most]
        return pa.Table.from_batches([_emit(
            np.repeat(ids, most), ids[near].ravel(), np.take_along_axis(scores, near, 1).ravel(), kind)])

    found = None
    for i in range(settings.passes):
        keyed = codes.select("node", "code", F.element_at("keys", i + 1).alias("key"))
        placed = numbered(keyed, [], ["key", "node"], "place", few=True)
        # the last block takes what is left over
        block = F.least(F.floor(F.col("place") / settings.block), F.lit(blocks - 1))
        near = placed.select("node", "code", block.alias("block")).groupBy("block").applyInArrow(compare, kind)
        found = near if found is None else found.union(near)
    return found


def _top(edges: DataFrame, most: int, group: str, *order: Column) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return edges.withColumn("place", place).where(F.col("place") <= most).drop("place")


def _candidates(edges: DataFrame, codes: DataFrame, turn: int, settings: Settings) -> DataFrame:
    """Scores between the neighbours of each node, both ways, that beat a list they'd join."""
    kind = _scored(codes.schema["node"].dataType)
    draw = F.xxhash64("node", "near", F.lit(turn))
    ahead = edges.select(F.col("node").alias("at"), F.col("near").alias("member"), "fresh")
    back = _top(edges, settings.back, "near", F.desc("fresh"), draw).select(
        F.col("near").alias("at"), F.col("node").alias("member"), "fresh")
    members = ahead.union(back).groupBy("at", "member").agg(F.max("fresh").alias("fresh"))
    worst = edges.groupBy(F.col("node").alias("member")).agg(
        F.when(F.count(F.lit(1)) >= settings.neighbours, F.min("score")).otherwise(float("-inf")).alias("worst"))
    known = codes.select(F.col("node").alias("member"), "code").join(worst, "member")
    groups = members.join(known, "member").groupBy("at").agg(
        F.collect_list(F.struct("member", "fresh", "worst", "code")).alias("members"), F.max("fresh").alias("any"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 200):
                lists = batch.column(0).slice(a, 200)
                flat = lists.flatten()
                ids, fresh, worst = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                x = _decoded(flat.field(3))
                bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                parts = []
                for first, last in zip(bounds[:-1], bounds[1:]):
                    own, new = x[first:last], fresh[first:last]
                    scores = own @ own.T
                    np.fill_diagonal(scores, -np.inf)
                    i, j = np.nonzero((scores > worst[first:last, None]) & (new[:, None] | new))
                    parts.append((ids[first + i], ids[first + j], scores[i, j]))
                node, near, score = (np.concatenate(p) for p in zip(*parts))
                on = _best(node, near, score, settings.neighbours)
                yield _emit(node[on], near[on], score[on], kind)

    return groups.where("any").select("members").mapInArrow(compare, kind)


def neighbour_graph(codes: DataFrame, settings: Settings) -> DataFrame:
    """Edges (node, near, score), at most ``neighbours`` of a node."""
    best = lambda e: _top(e, settings.neighbours, "node", F.desc("score"), F.col("near"))
    first = _first_graph(codes, settings).groupBy("node", "near").agg(F.max("score").alias("score"))
    edges = stage(best(first).withColumn("fresh", F.lit(True)), "graph")
    for turn in range(settings.rounds):
        found = _candidates(edges, codes, turn, settings).withColumn("fresh", F.lit(True))
        old = edges.withColumn("fresh", F.lit(False))
        merged = old.union(found.select(edges.columns)).groupBy("node", "near").agg(
            F.max("score").alias("score"), F.min("fresh").alias("fresh"))
        edges = stage(best(merged), "graph")
        new, count = edges.agg(F.sum(F.col("fresh").cast("long")), F.count(F.lit(1))).first()
        if not count or new < settings.settled * count:
            break
    return edges.drop("fresh")


def graph_search(
    queries: DataFrame, starts: DataFrame, edges: DataFrame, codes: DataFrame, settings: Settings,
) -> DataFrame:
    """Nodes (query, node, score) in the beam of each query when it holds none to expand.

    queries: query, query_code. starts: query, node. Scores are those of the rounded vectors.
    """
    both = edges.select("node", "near").union(
        _top(edges.select("node", "near"), settings.neighbours, "near", F.xxhash64("node", "near")).select(
            F.col("near").alias("node"), F.col("node").alias("near"))).distinct()
    links = stage(both.groupBy("node").agg(F.collect_list("near").alias("near")), "links")
    kind = T.StructType([
        queries.schema["query"], T.StructField("node", codes.schema["node"].dataType),
        T.StructField("score", T.FloatType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.einsum("nd,nd->n", _decoded(batch.column(2)), _decoded(batch.column(3)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores.astype(np.float32))], names=kind.names)

    def scored(pairs: DataFrame) -> DataFrame:
        rows = pairs.join(codes.select("node", "code"), "node").join(queries, "query")
        return rows.select("query", "node", "code", "query_code").mapInArrow(score, kind)

    beam = stage(scored(starts.distinct()).withColumn("step", F.lit(0)), "beam")
    step = 0
    while True:
        # what a beam lost scores below all it holds, so that it can't return
        ahead = beam.where(F.col("step") == step).select("query", "node")
        reached = ahead.join(links, "node").select("query", F.explode("near").alias("node")).distinct()
        new = reached.join(beam.select("query", "node"), ["query", "node"], "left_anti")
        step += 1
        found = scored(new).withColumn("step", F.lit(step))
        beam = stage(_top(beam.union(found), settings.beam, "query", F.desc("score"), F.col("node")), "beam")
        if beam.where(F.col("step") == step).isEmpty():
            return beam.select("query", "node", "score")


def nearest(
    vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by ``every``, the ``k`` rows of
    largest inner product found, ties to the smaller id, itself left out.

    All rows are indexed and none is dropped from the search. Vectors that are null, zero, hold
    null or non-finite components, or are of another length than most take no part, nor do null
    ids. Rows that repeat an id and its vector count once. Fewer candidates than ``k``: all that
    are found. Empty table: no rows.
    """
    rows = stage(_valid(vectors, id_col, vector_col), "vectors")
    nodes = stage(_nodes(rows, k + 1), "nodes")
    codes = stage(_rounded(nodes, settings), "codes")
    edges = neighbour_graph(codes, settings)
    # a query is a row, so that its vector's node is in the graph: the walk begins there
    asked = stage(
        rows.where(F.col("vec_id") % every == 0).distinct().join(nodes.select("node", "vector"), "vector")
        .select(F.col("vec_id").alias("query"), F.col("node"), "vector"), "queries")
    walkers = asked.select("node").distinct()  # queries of one node walk together
    queries = walkers.join(codes, "node").select(F.col("node").alias("query"), F.col("code").alias("query_code"))
    starts = walkers.select(F.col("node").alias("query"), "node")
    beam = stage(graph_search(queries, starts, edges, codes, settings), "found")

    # a node's ids share a score; by it and the smallest id, more nodes than k are never needed
    exact = F.aggregate(
        F.zip_with("own", "vector", lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v)
    known = nodes.select("node", "ids", "vector")
    own = nodes.select(F.col("node").alias("query"), F.col("vector").alias("own"))
    scored = beam.select("query", "node").join(known, "node").join(own, "query").select(
        "query", "node", "ids", exact.alias("score"))
    few = _top(scored, k + 1, "query", F.desc("score"), F.col("node"))
    named = asked.select(F.col("query").alias("query_id"), F.col("node").alias("query")).join(few, "query").select(
        "query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return named.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
