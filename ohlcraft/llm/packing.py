"""Harmonic packing (Lee and Lee, 1985) of token pieces into sequences of a fixed capacity.

A piece of length n belongs to class ``capacity // n``, the reciprocal of the share of a
sequence it needs; a bin of class k holds k pieces, so that a piece's bin follows from its place
among the pieces of its class, and workers fill their bins without looking at others'. The
padding of a class is what its lengths fall short of ``capacity / k``; so documents are cut
into pieces that do not: whole sequences first, then the longest ``capacity // k`` that fits
what is left. Below the square root of the capacity each length has a class of its own and
is not cut further.
"""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ohlcraft.llm import tokens
from ohlcraft.llm.common import numbered, stage

END_ID = 0


def cuts(rest: int, capacity: int) -> list[int]:
    """Lengths of the pieces of less than a sequence of tokens."""
    found = []
    while rest > math.isqrt(capacity):
        found.append(capacity // (capacity // (rest + 1) + 1))
        rest -= found[-1]
    return [*found, rest] if rest else found


def token_pieces(
    docs: DataFrame, capacity: int, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str | None = None,
) -> DataFrame:
    """Documents as pieces of token ids, an end id after each document.

    Columns: the id, start (ids before it), length, ids_crc32, doc_tokens (with the end id).
    Null or empty text: the end id alone. Special tokens in a text get their own ids. Long texts
    are encoded whole, by themselves. Rows with the same or a null id are cut one by one.
    """
    path = tokenizer or tokens.default_path()
    kind = docs.schema[id_col].dataType
    out = T.StructType([T.StructField("doc_id", kind), *(
        T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32", "doc_tokens"))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = tokens.encoder(path, plain=False), np.array([END_ID], dtype="<u4").tobytes()
        rests = [cuts(rest, capacity) for rest in range(capacity)]
        for batch in batches:
            for a, b in tokens.slices(batch.column(1)):
                rows, starts, lengths, sums, totals = [], [], [], [], []
                for row, ids in enumerate(encoder.encode(batch.column(1).slice(a, b - a)), a):
                    raw = memoryview(ids.tobytes() + end)
                    total, at = len(raw) // 4, 0
                    for length in [capacity] * (total // capacity) + rests[total % capacity]:
                        rows.append(row)
                        starts.append(at)
                        lengths.append(length)
                        sums.append(zlib.crc32(raw[4 * at:4 * (at + length)]))
                        totals.append(total)
                        at += length
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), *(
                        pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))],
                    names=out.names)

    return docs.select(id_col, text_col).mapInArrow(cut, out)


def _fill_rests(capacity: int):
    """First fit, longest first, for the few pieces of incomplete bins."""
    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_class", "_place"], ascending=[False, True, True])
        used: list[int] = []
        bins, offsets = [], []
        for length in rows["length"]:
            at = next((i for i, u in enumerate(used) if u + length <= capacity), len(used))
            if at == len(used):
                used.append(0)
            bins.append(at)
            offsets.append(used[at])
            used[at] += int(length)
        return rows.assign(_bin=np.array(bins, dtype=np.int64), offset=np.array(offsets, dtype=np.int64))
    return fill


def harmonic_pack(pieces: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """The pieces with sequence_id (gapless from 0) and offset (where they start in it).

    ``length`` must be from 1 to ``capacity``; ``order`` settles the places within a class.
    Each class leaves one incomplete bin; what those hold, fewer than k pieces of each class
    and at most 2 * sqrt(capacity) classes of several lengths, is packed by first fit.
    Null or repeated values in other columns are carried along; an empty table gives no rows.
    """
    places = numbered(
        pieces.withColumn("_class", F.floor(F.lit(capacity) / F.col("length")).cast("long")),
        ["_class"], order, "_place", few=True)
    classes = places.groupBy("_class").agg(F.count(F.lit(1)).alias("_n"))
    full = F.floor(F.col("_n") / F.col("_class")).cast("long")
    before = Window.orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    # at most 2 * sqrt(capacity) rows
    classes = classes.withColumn("_full", full).withColumns({
        "_base": F.coalesce(F.sum("_full").over(before), F.lit(0)),
        "_all": F.sum("_full").over(Window.partitionBy())})
    bins = places.withColumn("_bin", F.floor(F.col("_place") / F.col("_class")).cast("long"))
    bins = bins.join(F.broadcast(classes.drop("_n")), "_class")
    done = bins.where("_bin < _full")
    within = Window.partitionBy("_class", "_bin").orderBy("_place").rowsBetween(
        Window.unboundedPreceding, -1)
    done = done.withColumns({
        "offset": F.coalesce(F.sum("length").over(within), F.lit(0)),
        "sequence_id": F.col("_base") + F.col("_bin")})
    rests = bins.where("_bin = _full")
    kind = T.StructType([*rests.schema.fields, T.StructField("offset", T.LongType())])
    rests = rests.groupBy().applyInPandas(_fill_rests(capacity), kind).withColumn(
        "sequence_id", F.col("_all") + F.col("_bin"))
    wanted = [*pieces.columns, "sequence_id", "offset"]
    return done.select(wanted).unionByName(rests.select(wanted))


def pack_documents(
    docs: DataFrame, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str | None = None,
) -> DataFrame:
    """All documents, encoded whole and cut, in sequences of at most ``capacity`` tokens."""
    pieces = stage(token_pieces(docs, capacity, id_col, text_col, tokenizer), "pieces")
    packed = harmonic_pack(pieces, capacity, ["doc_id", "start"])
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
