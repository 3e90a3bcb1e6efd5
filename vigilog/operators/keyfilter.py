"""A bitmap of hashed keys that drops rows without a partner before they are shuffled.

For a list of keys too large to send out, its bitmap still is small: BITS_PER_KEY bits for
each key, never more than MAP_BYTES in all. Keys are hashed to a block of bits and to a few
places inside it; the blocks are broadcast and joined by their number, so a row meets one block.
A row whose places aren't all set is in no case listed. The rows that remain are those
listed and a small share of the others (some 0.3 % at 16 bits), which the exact join drops.

All of it is built-in expressions: `bit_or` over shifted longs makes the map, `getbit`
reads it, inside generated code at the scan.
"""

from __future__ import annotations

from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
# Below this the map would let most rows through; then there is none.
LEAST_BITS_PER_KEY = 3
MAP_BYTES = 64 * 1024 * 1024
BLOCK_BITS = 1 << 16
WORD_BITS = 64
PROBES = 4


class KeyMap(NamedTuple):
    """One row per block (number, its words), and what was hashed."""

    blocks: DataFrame
    count: int
    keys: list[str]


def block_count(distinct_keys: int, map_bytes: int = MAP_BYTES) -> int:
    """Blocks of the map for so many keys; 0 where it would be too full to be of use."""
    most = map_bytes * 8 // BLOCK_BITS
    blocks = min(most, max(1, ceil(distinct_keys * BITS_PER_KEY / BLOCK_BITS)))
    return blocks if blocks * BLOCK_BITS >= LEAST_BITS_PER_KEY * distinct_keys else 0


def _block(keys: list[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")


def _places(keys: list[str]) -> list[Column]:
    """Places in a block from the parts of a second hash, each below BLOCK_BITS."""
    second = F.xxhash64(F.lit("place"), *keys)
    width = BLOCK_BITS.bit_length() - 1
    return [F.shiftrightunsigned(second, width * probe).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for probe in range(PROBES)]


def key_map(rows: DataFrame, keys: list[str], distinct_keys: int, map_bytes: int = MAP_BYTES) -> KeyMap | None:
    """The map of the keys of ``rows``; None where it would be too full.

    ``distinct_keys`` only sets its size. Words are added up before they are shuffled, so a
    key listed very often is one word per task.
    """
    count = block_count(distinct_keys, map_bytes)
    if not count:
        return None
    per_block = BLOCK_BITS // WORD_BITS
    listed = rows.select(_block(keys, count).alias("_block"), F.explode(F.array(*_places(keys))).alias("_place"))
    word = F.floor(F.col("_place") / WORD_BITS).cast("int").alias("_word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_place") % WORD_BITS).alias("_bits")
    set_words = listed.select("_block", word, bit)
    # Words without a key, so that every block is complete.
    empty = rows.sparkSession.range(count * per_block).select(
        F.floor(F.col("id") / per_block).cast("int").alias("_block"), (F.col("id") % per_block).cast("int").alias("_word"), F.lit(0).cast("long").alias("_bits")
    )
    words = set_words.unionByName(empty).groupBy("_block", "_word").agg(F.bit_or("_bits").alias("_bits"))
    ordered = F.array_sort(F.collect_list(F.struct("_word", "_bits")))
    blocks = words.groupBy("_block").agg(F.transform(ordered, lambda w: w["_bits"]).alias("_words"))
    return KeyMap(blocks, count, list(keys))


def maybe_listed(df: DataFrame, listed: KeyMap | None, keys: list[str] | None = None) -> DataFrame:
    """Rows whose key may be in the map: all that are, and few others. Rows with a null key go.

    ``keys`` names the columns of ``df`` in the order of the map's keys, if named differently.
    """
    if listed is None:
        return df
    own = keys or listed.keys
    known = df.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in own]))
    hit = [F.getbit(F.get(F.col("_words"), F.floor(p / WORD_BITS).cast("int")), p % WORD_BITS) == 1 for p in _places(own)]
    same_block = _block(own, listed.count) == F.col("_block")
    return known.join(F.broadcast(listed.blocks), reduce(Column.__and__, hit, same_block), "leftsemi")
