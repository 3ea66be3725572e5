"""Shards by jump consistent hashing (Lamping and Veach, 2014), in built-in functions only.

A key's shard is the last of a sequence of jumps below the number of shards. The jumps depend
on the key alone, so that a shard that is added takes rows only into itself: a key moves to it
if its sequence hits it, and stays where it is otherwise.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ohlcraft.llm.common import numbered

# Fixed value: the multiplier of the published generator.
MULTIPLIER = 2862933555777941757
LOW, HALF = 0xFFFFFFFF, 0xFFFF


def _low_product(x: Column, y: int) -> Column:
    """x * y modulo 2^32 for numbers below 2^32, without leaving 63 bits."""
    return (x * (y & HALF) + F.shiftleft((x * (y >> 16)).bitwiseAND(HALF), 16)).bitwiseAND(LOW)


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """high, low: halves of an unsigned 64-bit number; those of it times MULTIPLIER, plus 1."""
    by_high, by_low = MULTIPLIER >> 32, MULTIPLIER & LOW
    upper = low * (by_low >> 16)
    full = low * (by_low & HALF) + F.shiftleft(upper.bitwiseAND(HALF), 16) + 1
    carry = F.shiftright(full, 32) + F.shiftright(upper, 16)
    high = (carry + _low_product(high, by_low) + _low_product(low, by_high)).bitwiseAND(LOW)
    return high, full.bitwiseAND(LOW)


def jump_shards(key: Column, shards: int) -> tuple[Column, Column]:
    """The shard of a long key among ``shards``, and among one more. A null key counts as 0."""
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    long = lambda v: F.lit(v).cast("long")
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(LOW).alias("low"),
        long(-1).alias("at"), long(-1).alias("before"), long(0).alias("jump"))

    def step(state: Column, _: Column) -> Column:
        high, low = _next_state(state["high"], state["low"])
        jump = ((state["jump"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1))).cast("long")
        return F.when(state["jump"] > shards, state).otherwise(F.struct(
            high.alias("high"), low.alias("low"), state["jump"].alias("at"),
            state["at"].alias("before"), jump.alias("jump")))

    # each step jumps ahead by one shard at least
    end = F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step)
    grown = end["at"].cast("int")
    return F.when(end["at"] < shards, grown).otherwise(end["before"].cast("int")), grown


def jump_sharding(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    The shard depends on the id and the number of shards only (law ``key``). ``slot`` numbers a
    shard's documents by id, from 0 without gaps. ``size`` is the text's UTF-8 bytes plus 8.

    Null text: size 8, checksum 0. Null id: hashed as 0 and first among its shard's slots.
    Repeated ids share a shard and get slots of their own, in input order. Empty table: no rows.
    Other columns of ``docs`` are not read. The hottest key is dealt over several tasks.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    key, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(key.alias("doc_id"), text.alias("_text"))
    shard, grown = jump_shards(F.col("doc_id"), shards)
    rows = rows.select(
        "doc_id", (F.octet_length("_text").cast("long") + 8).alias("size"),
        F.crc32(F.encode("_text", "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"),
        shard.alias("shard"), grown.alias("grown_shard"))
    rows = numbered(rows, ["shard"], ["doc_id"], "slot", few=True)
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
