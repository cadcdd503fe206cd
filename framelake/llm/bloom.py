"""A blocked Bloom filter as a DataFrame.

The filter is a table of 512-bit blocks, eight 64-bit words, one bit set in
each word per key. It has a fixed number of blocks, of 72 bytes each, however
many keys there are (2.4 MB for ``BLOCKS``), so broadcasting it is safe; more
keys only raise the share of false positives, which the caller's exact join
removes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 1 << 15
WORDS = 8


def block_of(key: Column, blocks: int) -> Column:
    """The block of a key, by which rows can be dealt before ``bloom_blocks``."""
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """The bit each word of the key's block must have set: six bits of a second hash per word."""
    h = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("long")
    bits = [F.shiftrightunsigned(h, 6 * word).bitwiseAND(F.lit(63)).cast("int") for word in range(WORDS)]
    return [F.call_function("shiftleft", one, bit) for bit in bits]


def bloom_blocks(keys: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The filter of column ``key``: ``block`` and its words ``w0`` to ``w7``.
    ``keys`` may have their ``block`` already."""
    block = F.col("block") if "block" in keys.columns else block_of(F.col("key"), blocks)
    masked = keys.select(block.alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(_masks(F.col("key")))])
    return masked.groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])


def _held(key: Column) -> Column:
    hit = F.lit(True)
    for i, mask in enumerate(_masks(key)):
        hit = hit & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    return hit


def possible_hits(candidates: DataFrame, bloom: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Rows of ``candidates`` whose ``key`` the filter may hold: all that it
    does, and a few that it does not."""
    probe = candidates.withColumn("block", block_of(F.col("key"), blocks)).join(F.broadcast(bloom), "block")
    return probe.where(_held(F.col("key"))).select(*candidates.columns)


def marked_hits(candidates: DataFrame, bloom: DataFrame, name: str, blocks: int = BLOCKS) -> DataFrame:
    """All rows of ``candidates``, with whether the filter may hold their
    ``key`` as the column ``name``."""
    probe = candidates.withColumn("block", block_of(F.col("key"), blocks)).join(F.broadcast(bloom), "block", "left")
    return probe.select(*candidates.columns, F.coalesce(_held(F.col("key")), F.lit(False)).alias(name))
