"""Best-fit decreasing in groups of pieces, certified by dual-feasible functions (Fekete and
Schepers, 2001).

A dual-feasible function gives lengths weights that sum to at most 1 in any sequence, so the
weights of all pieces bound the number of sequences from below. The function that bounds the whole
table best measures every sequence: 1 less its weights is its gap, and the gaps add up to the
number of sequences above the bound. Groups whose gaps are negligible are certified; the others
give their sequences of the largest gaps away, and what they gave is dealt anew among fewer groups
and packed again, as long as that saves sequences.
"""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ohlcraft.llm import tokens
from ohlcraft.llm.common import stage

END_ID = 0
#: Pieces a group holds on average; they are dealt by a hash of their row, so groups are even.
GROUP = 50_000
#: Sequences that all groups together may keep above the bound.
KEPT_GAP = 0.5
#: Denominators of the stepwise functions.
STEPS = range(2, 65)
#: At most so many rounds; each must save a sequence.
ROUNDS = 16


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length by best-fit decreasing; of bins with equal room the last
    one used."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, count = 0, 0  # a bit for each room that a bin has
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> n
        if fitting:
            left = n + (fitting & -fitting).bit_length() - 1
            at = room[left].pop()
            if not room[left]:
                rooms ^= 1 << left
        else:
            left, at, count = capacity, count, count + 1
        bins[i], offsets[i] = at, capacity - left
        left -= n
        if left:
            if not room[left]:
                rooms |= 1 << left
            room[left].append(at)
    return bins, offsets


def dual_feasible(capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A row per function: the weights of the lengths 0 to ``capacity``, in whole numbers, and
    what stands for 1.

    One family rounds short lengths to nothing and their complements to a whole sequence; the
    other rounds down to fractions with a common denominator, one more of which fit in.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    short = np.arange(capacity // 2 + 1, dtype=np.int64)[:, None]
    rounded = np.where(x > capacity - short, capacity, np.where(x < short, 0, x))
    steps = np.array(STEPS, dtype=np.int64)[:, None]
    stepped = np.where((steps + 1) * x % capacity, (steps + 1) * x // capacity * capacity, steps * x)
    ones = np.concatenate([np.full(len(rounded), capacity, np.int64), steps[:, 0] * capacity])
    return np.concatenate([rounded, stepped]), ones


def lower_bound(counts: np.ndarray, capacity: int) -> tuple[int, np.ndarray, int]:
    """Least sequences for so many pieces of each length, the weights that prove it, and what
    stands for 1."""
    weights, ones = dual_feasible(capacity)
    # sums beyond 2^53 are rounded in doubles: these only choose, the bound is in whole numbers
    best = int(np.argmax((weights @ counts.astype(np.float64)) / ones))
    total = sum(int(n) * int(w) for n, w in zip(counts.tolist(), weights[best].tolist()) if n)
    return -(-total // int(ones[best])), weights[best], int(ones[best])


def length_counts(pieces: DataFrame, capacity: int) -> np.ndarray:
    """How many pieces have each length: at most ``capacity`` rows come to the driver."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    return counts


def certificate(packed: DataFrame, capacity: int = 2048) -> tuple[int, int]:
    """The number of sequences of packed pieces, and a proven lower bound of it."""
    return (packed.where("offset = 0").count(),
            lower_bound(length_counts(packed, capacity), capacity)[0])


def token_pieces(
    docs: DataFrame, capacity: int, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
) -> DataFrame:
    """Documents as pieces of ``capacity`` token ids, the last one shorter, with an end id after
    each document: doc_id, piece, start, length, ids_crc32.

    Null or empty text: the end id alone. Long texts are encoded whole, by themselves. Rows with
    the same or a null id are cut one by one; other columns are not read.
    """
    path = tokenizer or public_tokenizers.path(tokens.WORD_BPE)
    out = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
        *(T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32"))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = tokens.word_encoder(path), np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            for a, b in tokens.slices(batch.column(1)):
                rows, pieces, lengths, sums = [], [], [], []
                for row, ids in enumerate(encoder.encode(batch.column(1).slice(a, b - a)), a):
                    raw = memoryview(ids.tobytes() + end)
                    for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[at:at + 4 * capacity]
                        rows.append(row)
                        pieces.append(piece)
                        lengths.append(len(part) // 4)
                        sums.append(zlib.crc32(part))
                places = np.array(pieces, np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array(places),
                    pa.array(places.astype(np.int64) * capacity), pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64())], names=out.names)

    return docs.select(id_col, text_col).mapInArrow(cut, out)


def _packed_group(capacity: int, weights: np.ndarray, one: int, kept_gap: float, names: list[str]):
    def pack(group: pa.Table) -> pa.Table:
        lengths = group["length"].to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        gaps = one - np.bincount(bins, weights[lengths]).astype(np.int64)
        order = np.argsort(gaps, kind="stable")
        keeps = np.zeros(len(gaps), bool)
        keeps[order] = np.cumsum(gaps[order]) <= kept_gap * one
        group = group.append_column("_bin", pa.array(bins)).append_column("offset", pa.array(offsets))
        return group.append_column("_kept", pa.array(keeps[bins])).select(names)
    return pack


def certified_best_fit(pieces: DataFrame, capacity: int) -> DataFrame:
    """Pieces with a ``length`` of less than ``capacity`` and a unique ``_key``, with
    sequence_id (not negative) and offset.

    Of the groups only counts come to the driver; a group holds about ``GROUP`` pieces, however
    long or alike. The rounds end when nothing was given away, when one group held all, or when
    dealing anew saved no sequence; then the former packing stays.
    """
    _, weights, one = lower_bound(length_counts(pieces, capacity), capacity)
    todo, done, given, count = pieces, [], None, None
    kind = T.StructType([*pieces.schema.fields, T.StructField("_part", T.LongType()), *(
        T.StructField(name, T.LongType()) for name in ("_bin", "offset")), T.StructField("_kept", T.BooleanType())])
    pieces_left = pieces.count()
    for turn in range(ROUNDS):
        groups = max(1, math.ceil(pieces_left / GROUP))
        dealt = todo.withColumn("_part", F.pmod(F.xxhash64("_key", F.lit(turn)), F.lit(groups)).cast("long"))
        pack = _packed_group(capacity, weights, one, KEPT_GAP / groups, kind.names)
        packed = stage(dealt.groupBy("_part").applyInArrow(pack, kind), "best-fit").withColumn(
            "sequence_id", F.shiftleft(F.lit(turn).cast("long"), 56) + F.shiftleft("_part", 20) + F.col("_bin"))
        packed = packed.select(*pieces.columns, "sequence_id", "offset", "_kept")
        sequences, released, pieces_left = packed.agg(
            F.count_if(F.col("offset") == 0), F.count_if((F.col("offset") == 0) & ~F.col("_kept")), F.count_if(~F.col("_kept"))).first()
        if count is not None and sequences >= count:
            break
        done.append(packed.where("_kept"))
        given, count = packed.where("NOT _kept"), released
        if groups == 1 or not released:
            break
        todo = given.select(*pieces.columns)
    result = given
    for part in done:
        result = result.unionByName(part)
    return result.drop("_kept")


def pack_documents(
    docs: DataFrame, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str | None = None,
) -> DataFrame:
    """All documents in as few sequences of at most ``capacity`` tokens as certified best-fit
    decreasing finds: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A full piece is a sequence of its own, with a negative number. An empty table gives none.
    """
    pieces = stage(token_pieces(docs, capacity, id_col, text_col, tokenizer).withColumn(
        "_key", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == capacity).select(
        *pieces.columns, (-1 - F.col("_key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rests = certified_best_fit(pieces.where(F.col("length") < capacity), capacity)
    return full.unionByName(rests).drop("_key")
