"""A blocked Bloom filter built from plain DataFrame operators.

The filter has ``blocks`` words of 64 bits, made with a ``bit_or`` aggregate that combines on the map
side and packed ``PACK`` to a row, so that a broadcast of it takes little more than its bits. It is probed by a
broadcast hash join on the row's number. Its size follows the number of keys (16 bits a key) up to
``MAX_BLOCKS``, the most that a broadcast should carry: beyond 67 million keys it lets more through, 2 % of the
others at twice as many, a sixth at four times as many. It never says "absent" of a key that is there, so results don't depend on that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.runtime import power_of_two

#: At most 2**24 words of 64 bits: 128 MB.
MAX_BLOCKS = 1 << 24
KEYS_PER_BLOCK = 4
PACK = 64


def blocks_for(keys: int) -> int:
    return power_of_two(keys // KEYS_PER_BLOCK, 1 << 10, MAX_BLOCKS)


def _block(h: Column, blocks: int) -> Column:
    return h.bitwiseAND(F.lit(blocks - 1))


def _mask(h: Column) -> Column:
    """Four of 64 bits, from parts of the hash that the block number doesn't use."""
    bits = None
    for shift in (24, 30, 36, 42):
        place = F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return bits


def build(keys: DataFrame, key: Column, blocks: int) -> DataFrame:
    """The filter of all non-null ``key`` values as a table (bf_row, bf_words)."""
    h = keys.filter(key.isNotNull()).select(F.xxhash64(key).alias("h"))
    words = h.select(_block(F.col("h"), blocks).alias("block"), _mask(F.col("h")).alias("m")).groupBy("block").agg(F.bit_or("m").alias("word"))
    slots = words.groupBy(F.shiftright("block", 6).alias("bf_row")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("block").bitwiseAND(F.lit(PACK - 1)).cast("int").alias("slot"), "word"))).alias("words")  # PACK at most
    )
    return slots.select("bf_row", F.transform(F.sequence(F.lit(0), F.lit(PACK - 1)), lambda i: F.coalesce(F.element_at("words", i), F.lit(0).cast("bigint"))).alias("bf_words"))


def probe(rows: DataFrame, key: Column, bloom: DataFrame, blocks: int, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: false proves that ``key`` is not among the filter's keys."""
    mask, block = _mask(F.xxhash64(key)), _block(F.xxhash64(key), blocks)
    word = F.get("bf_words", block.bitwiseAND(F.lit(PACK - 1)).cast("int"))
    return (
        rows.withColumn("bf_row", F.shiftright(block, 6))
        .join(F.broadcast(bloom), "bf_row", "left")
        .withColumn(flag, F.coalesce(word.bitwiseAND(mask) == mask, F.lit(False)))
        .drop("bf_row", "bf_words")
    )
