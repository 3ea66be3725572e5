"""Ranked lexical search by an index in strata of equal length.

A document's normaliser depends on its number of terms alone, so documents with an equal one form
a stratum, in which a term's share of the score (its impact, before the term's weight) depends on
nothing but how often it occurs. The index has a row per block of a stratum: the documents, the
terms, and per term its postings grouped by occurrences, with the impact computed once for
each number of occurrences. Numbers are kept as bytes, terms with blanks between them.

A search takes the items in blocks of bounded size. The highest impacts of a block bound
the scores of its documents for each item. The blocks of the highest bounds are visited first;
their best documents give a score to beat, and of the others only those whose bound reaches it
are visited. Sums are of whole numbers below 2^53, so doubles hold them exactly.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ohlcraft.llm.common import rows_a_batch, stage
from ohlcraft.llm.tokens import slices

#: Most documents and postings of a block; a document with more postings is a block of its own.
BLOCK_DOCUMENTS, BLOCK_POSTINGS = 1024, 65_536
#: Most pairs of an item and a term, and most items, that are searched at once, on average.
QUERY_PAIRS, QUERY_ITEMS = 200_000, 2_000
#: Blocks visited first, per item and result asked for.
FIRST_VISITS = 2
#: Bytes of documents' terms that stand together in the order of strata.
STRETCH_BYTES = 4_000_000
#: Rows of 24 bytes that are broadcast; more strata are joined by a shuffle.
BROADCAST_STRATA = 1_000_000
#: Documents and blocks handed to a Python task at once.
DOCUMENTS_A_BATCH, BLOCKS_A_BATCH = 200, 8
#: Bytes of text counted at once.
SLICE_BYTES = 4_000_000
#: Sums formed at once.
AT_ONCE = 250_000

_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
#: What a byte becomes: letters small, digits and bytes of other characters themselves, else blank.
_AS_TERMS = bytes(
    _LOWER[_UPPER.index(b)] if b in _UPPER else b if b in _LOWER or 48 <= b <= 57 or b > 127 else 32
    for b in range(256))


@dataclass
class Index:
    """``blocks``: a row per block. ``n_documents``: those with a term; ``n_terms``: all theirs."""
    blocks: DataFrame
    n_documents: int
    n_terms: int
    id_type: T.DataType


def _numbers(column: pa.Array) -> np.ndarray:
    """The numbers of the rows in turn, which are kept as bytes of 4 each."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4")


def term_counts(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of each whole text: id, n (its terms), terms (distinct ones with blanks between), tfs (the
    occurrences of each, 4 bytes each): compact rows, as they are shuffled."""
    kind = T.StructType([
        T.StructField("id", rows.schema[id_col].dataType), T.StructField("n", T.LongType()),
        T.StructField("terms", T.StringType()), T.StructField("tfs", T.BinaryType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                texts = pc.fill_null(batch.column(1).slice(a, b - a).cast(pa.string()), "").cast(pa.binary())
                terms, tfs, lengths = [], [], []
                for text in texts:
                    words = text.as_py().translate(_AS_TERMS).split()
                    counts = Counter(words)
                    terms.append(b" ".join(counts))
                    tfs.append(np.fromiter(counts.values(), "<i4", len(counts)).tobytes())
                    lengths.append(len(words))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(lengths, pa.int64()),
                    pa.array(terms, pa.binary()).cast(pa.string()), pa.array(tfs, pa.binary())], names=kind.names)

    return rows.select(id_col, text_col).mapInArrow(count, kind)


def _cuts(m: np.ndarray, sizes: np.ndarray) -> list[int]:
    """Where blocks begin, and the end."""
    found, documents, postings = [0], 0, 0
    lengths, strata = sizes.tolist(), m.tolist()
    for i, (own, size) in enumerate(zip(strata, lengths)):
        if i and (own != strata[i - 1] or documents == BLOCK_DOCUMENTS or postings + size > BLOCK_POSTINGS):
            found.append(i)
            documents = postings = 0
        documents, postings = documents + 1, postings + size
    return [*found, len(strata)]


def _sizes(rows: pa.RecordBatch) -> np.ndarray:
    """Distinct terms of each document."""
    return pc.binary_length(rows.column("tfs")).to_numpy() // 4


def _block(rows: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    """One block of documents with an equal normaliser."""
    m, sizes = rows.column("m")[0].as_py(), _sizes(rows)
    coded = pc.split_pattern(rows.column("terms"), " ").flatten().dictionary_encode()
    codes, tfs = coded.indices.to_numpy(), _numbers(rows.column("tfs")).astype(np.int64)
    documents = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    order = np.lexsort((documents, tfs, codes))
    codes, tfs, documents = codes[order], tfs[order], documents[order]
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(codes) != 0) | (np.diff(tfs) != 0)]))
    levels, level = np.unique(tfs[starts], return_inverse=True)
    impacts = (1_000_000_000 * levels // (1000 * levels + 8 * m))[level]  # once per number of occurrences
    of_term = codes[starts]
    group_counts = np.bincount(of_term, minlength=len(coded.dictionary))
    # groups are sorted by occurrences, and impacts grow with them
    tops = impacts[np.cumsum(group_counts) - 1]
    dfs, sizes_of = np.bincount(codes, minlength=len(coded.dictionary)), np.diff([*starts, len(codes)])
    numbers = [pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in (
        tops, dfs, group_counts, tfs[starts], impacts, sizes_of, documents)]
    ids = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows.column("id"))
    return pa.RecordBatch.from_arrays([
        pa.array([m]), pa.array([len(rows)], pa.int32()), ids,
        pa.array([" ".join(coded.dictionary.to_pylist())], pa.string()), *numbers], names=names)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt to tasks in stretches of the order of ``m`` that hold about as many bytes each:
    long documents are few, but large. A large stratum is cut by hash."""
    size = F.length("terms") + F.length("tfs")
    strata = rows.groupBy("m").agg(F.sum(size).alias("bytes"))
    before = Window.orderBy("m").rowsBetween(Window.unboundedPreceding, -1)  # a row per stratum
    strata = stage(strata.withColumn("ahead", F.coalesce(F.sum("bytes").over(before), F.lit(0))), "strata")
    if strata.count() <= BROADCAST_STRATA:
        strata = F.broadcast(strata)
    within = F.pmod(F.xxhash64("_tie"), F.col("bytes"))
    stretch = F.floor((F.col("ahead") + within) / F.lit(STRETCH_BYTES))
    return rows.join(strata, "m").withColumn("_stretch", stretch).drop("ahead", "bytes").repartition(
        "_stretch").drop("_stretch")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of all terms of all documents, written to the shared folder.

    Null and empty texts and those without terms are not in it. Rows are documents, whatever ids
    repeat or are null; other columns are not read.
    """
    spark = docs.sparkSession
    with rows_a_batch(spark, DOCUMENTS_A_BATCH):
        counts = stage(term_counts(docs, id_col, text_col), "terms").where("n > 0")
    n_documents, n_terms = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # in decimals: the product exceeds 64 bits on large corpora
    m = F.expr(f"10L + CAST(CAST(90 AS DECIMAL(20,0)) * n * CAST({n_documents} AS DECIMAL(18,0)) div {max(n_terms, 1)} AS BIGINT)")
    dealt = _dealt(counts.select("id", m.alias("m"), "terms", "tfs", F.monotonically_increasing_id().alias("_tie")))
    dealt = dealt.sortWithinPartitions("m", F.asc_nulls_last("id"), "_tie").drop("_tie")
    id_type = docs.schema[id_col].dataType
    kind = T.StructType([
        T.StructField("m", T.LongType()), T.StructField("n_documents", T.IntegerType()),
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("terms", T.StringType()),
        *(T.StructField(name, T.BinaryType()) for name in ("tops", "dfs", "group_counts", "tfs", "impacts", "sizes", "documents"))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.concat_batches([held, batch])
            if not len(batch):
                continue
            cuts = _cuts(batch.column("m").to_numpy(), _sizes(batch))
            for a, b in zip(cuts[:-2], cuts[1:-1]):
                yield _block(batch.slice(a, b - a), kind.names)
            held = batch.slice(cuts[-2])
        if held is not None:
            yield _block(held, kind.names)

    with rows_a_batch(spark, DOCUMENTS_A_BATCH):
        blocks = stage(dealt.mapInArrow(cut, kind).withColumn("block", F.monotonically_increasing_id()), "blocks")
    return Index(blocks, n_documents, n_terms, id_type)


class _Asked:
    """Some items: their distinct terms, and for each term the items that hold it."""

    def __init__(self, pairs: pa.Table) -> None:
        items, terms = pairs["id"].combine_chunks().dictionary_encode("encode"), pairs["term"].combine_chunks().dictionary_encode()
        self.items, self.terms = items.dictionary, terms.dictionary
        item, term = items.indices.to_numpy(), terms.indices.to_numpy()
        order = np.argsort(term, kind="stable")
        self.item = item[order].astype(np.int64)
        self.counts = np.bincount(term, minlength=len(self.terms))
        self.starts = np.cumsum(self.counts) - self.counts
        self.weights = np.zeros(len(self.terms), np.int64)

    def expanded(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each entry and each item of its term: the entry's place, and the item."""
        n = self.counts[term]
        place = np.repeat(np.arange(len(term)), n)
        within = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
        return place, self.item[self.starts[term][place] + within]

    def known(self, terms: pa.Array) -> np.ndarray:
        """Numbers of terms, -1 for those that no item holds."""
        return pc.fill_null(pc.index_in(terms, value_set=self.terms), -1).to_numpy()

    def bounds(self, batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        """Runs of rows, first and last, with the bounds of each row and item."""
        lists = pc.split_pattern(batch.column("terms"), " ")
        known = self.known(lists.flatten())
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        tops = _numbers(batch.column("tops")).astype(np.int64)
        hits = np.flatnonzero(known >= 0)
        row = np.searchsorted(ends, hits, "right") - 1
        pairs = np.concatenate([[0], np.cumsum(np.bincount(row, self.counts[known[hits]], minlength=len(batch)))])
        first = 0
        while first < len(batch):
            last = int(np.searchsorted(pairs, pairs[first] + AT_ONCE, "right")) - 1
            last = min(max(last, first + 1), first + max(1, AT_ONCE // len(self.items)), len(batch))
            own = slice(*np.searchsorted(row, [first, last]))
            term = known[hits[own]]
            place, item = self.expanded(term)
            shares = (self.weights[term] * tops[hits[own]])[place]
            at = (row[own][place] - first) * len(self.items) + item
            sums = np.bincount(at, shares, minlength=(last - first) * len(self.items))
            yield first, last, sums.reshape(last - first, -1)
            first = last

    def scores(self, row: dict[str, np.ndarray], known: np.ndarray, items: np.ndarray, n_documents: int) -> np.ndarray:
        """Scores of a block's documents for some items, a row per item."""
        number = np.full(len(self.items), -1)
        number[items] = np.arange(len(items))
        of_group = np.repeat(known, row["group_counts"])
        hits = np.flatnonzero(of_group >= 0)
        place, item = self.expanded(of_group[hits])
        wanted = number[item] >= 0
        group, item = hits[place[wanted]], number[item[wanted]]
        shares = (self.weights[of_group[group]] * row["impacts"][group]).astype(np.float64)
        sizes = row["sizes"].astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        total = np.zeros(len(items) * n_documents)
        steps = np.cumsum(sizes[group])
        first = 0
        while first < len(group):
            done = steps[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(steps, done + AT_ONCE, "right")))
            n = sizes[group[first:last]]
            each = np.repeat(np.arange(first, last), n)
            within = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            document = row["documents"][starts[group[each]] + within]
            total += np.bincount(item[each] * n_documents + document, shares[each], minlength=len(total))
            first = last
        return total.reshape(len(items), n_documents)


_PARTS = ("group_counts", "impacts", "sizes", "documents")


def _weigh(asked: _Asked, index: Index) -> None:
    """Sets the weights of the terms by the documents that hold each; a row per term at most
    comes to the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(asked.terms), np.int64)
        for batch in batches:
            known = asked.known(pc.split_pattern(batch.column(0), " ").flatten())
            hit = known >= 0
            np.add.at(total, known[hit], _numbers(batch.column(1))[hit])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["term", "df"])

    counted = index.blocks.select("terms", "dfs").mapInArrow(count, "term long, df long")
    for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
        asked.weights[row.term] = math.floor(1000 * math.log((2 * index.n_documents + 2) / (2 * row.df + 1)))


def _first_visits(asked: _Asked, index: Index, k: int) -> DataFrame:
    """Rows (block, items): for each item the blocks of the highest bounds."""
    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((0, len(asked.items)))
        block = np.zeros((0, len(asked.items)), np.int64)
        for batch in batches:
            numbers = batch.column("block").to_numpy()
            for first, last, bounds in asked.bounds(batch):
                best = np.concatenate([best, bounds])
                block = np.concatenate([block, np.repeat(numbers[first:last, None], bounds.shape[1], axis=1)])
                order = np.argsort(-best, axis=0, kind="stable")[:k]
                best, block = np.take_along_axis(best, order, 0), np.take_along_axis(block, order, 0)
        row, item = np.nonzero(best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block[row, item]), pa.array(item), pa.array(best[row, item])], names=["block", "item", "bound"])

    found = index.blocks.select("block", "terms", "tops").mapInArrow(highest, "block long, item long, bound double")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "block")
    return found.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k).groupBy("block").agg(
        F.collect_list("item").alias("items"))


def _visited(asked: _Asked, index: Index, rows: DataFrame, k: int, beat: np.ndarray) -> DataFrame:
    """Rows (item, id, score): of each block the k best documents that reach the score to beat.
    Blocks come with the ``items`` to score, or else those whose bound reaches it are."""
    kind = T.StructType([T.StructField("item", T.LongType()), T.StructField("id", index.id_type),
                         T.StructField("score", T.LongType())])
    given = "items" in rows.columns

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, best = beat.copy(), np.zeros((len(asked.items), k))

        def visited(batch: pa.RecordBatch, i: int, items: np.ndarray) -> pa.RecordBatch:
            row = {name: np.frombuffer(batch.column(name)[i].as_py(), "<i4") for name in _PARTS}
            ids = batch.column("ids")[i].values
            known = asked.known(pc.split_pattern(batch.column("terms").slice(i, 1), " ").flatten())
            scores = asked.scores(row, known, items, len(ids))
            which, document = np.nonzero(scores >= least[items][:, None])
            score = scores[which, document]
            order = np.lexsort((document, -score, which))
            which, document, score = which[order], document[order], score[order]
            first = np.searchsorted(which, which)
            kept = np.arange(len(which)) - first < k
            which, document, score = which[kept], document[kept], score[kept]
            # the task's own k-th best score is one to beat, too
            best_of = np.zeros((len(items), k))
            best_of[which, (np.arange(len(order)) - first)[kept]] = score
            best[items] = -np.sort(-np.concatenate([best[items], best_of], axis=1), axis=1)[:, :k]
            least[items] = np.maximum(least[items], best[items][:, -1])
            return pa.RecordBatch.from_arrays([
                pa.array(items[which]), ids.take(pa.array(document)), pa.array(score.astype(np.int64))], names=kind.names)

        for batch in batches:
            if given:
                for i in range(len(batch)):
                    yield visited(batch, i, np.unique(batch.column("items")[i].values.to_numpy()))
                continue
            for first, last, bounds in asked.bounds(batch):
                for i in (np.argsort(-bounds.max(axis=1), kind="stable") + first).tolist():
                    items = np.flatnonzero(bounds[i - first] >= least)
                    if len(items):
                        yield visited(batch, i, items)

    columns = ["terms", "tops", "ids", *_PARTS, *(["items"] if given else [])]
    return rows.select(*columns).mapInArrow(visit, kind)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _found(asked: _Asked, index: Index, k: int) -> DataFrame:
    """Rows (item, id, score, rank) of some items."""
    _weigh(asked, index)
    beat = np.ones(len(asked.items))
    visits = _first_visits(asked, index, FIRST_VISITS * k)
    first = _visited(asked, index, index.blocks.join(F.broadcast(visits), "block"), k, beat)
    for row in _ranked(first, k).where(F.col("rank") == k).collect():
        beat[row.item] = row.score
    return _ranked(_visited(asked, index, index.blocks, k, beat), k)


def search(
    index: Index, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text",
) -> DataFrame:
    """Each item's k best documents: item_id, rank (from 1), doc_id, score.

    Only scores above 0 count; equal ones go by ascending id, null ids last. Texts of one item id
    are one item, a null id too. Null and empty texts, those without terms and those whose
    terms no document holds get no rows; nor does anything from an empty index.
    """
    spark = items.sparkSession
    pairs = term_counts(items, id_col, text_col).where("n > 0").select(
        "id", F.explode(F.split("terms", " ")).alias("term")).distinct()
    pairs = stage(pairs, "asked")
    n_pairs, n_items = pairs.agg(F.count(F.lit(1)), F.approx_count_distinct("id")).first()
    turns = max(1, math.ceil(n_pairs / QUERY_PAIRS), math.ceil(n_items / QUERY_ITEMS))
    kind = T.StructType([
        T.StructField("item_id", items.schema[id_col].dataType), T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", index.id_type), T.StructField("score", T.LongType())])
    result = spark.createDataFrame([], kind)
    if not index.n_documents:
        return result
    for turn in range(turns):
        some = pairs.where(F.pmod(F.xxhash64("id"), F.lit(turns)) == turn).toArrow()
        if not len(some):
            continue
        asked = _Asked(some)
        with rows_a_batch(spark, BLOCKS_A_BATCH):
            found = stage(_found(asked, index, k), "found")

        def named(batches: Iterator[pa.RecordBatch], ids: pa.Array = asked.items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [ids.take(batch.column(0)), *batch.columns[1:]], names=kind.names)

        result = result.unionByName(found.select("item", "rank", "id", "score").mapInArrow(named, kind))
    return result
