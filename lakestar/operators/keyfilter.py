"""Filters of keys as tables: blocks of 256 bits in which every key sets eight.

A filter is a table of blocks, so it is built, stored and probed by Spark whatever its size. A key that is in the
filtered rows always hits; another one hits by chance, rarely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = ("w0", "w1", "w2", "w3")
BLOCK_BITS = 256
FILTER = "append int, blocks long, block long, " + ", ".join(f"{w} long" for w in WORDS)


def block_count(rows: int, bits_per_key: int) -> int:
    """Blocks of a filter, a power of two."""
    return 1 << max(0, (rows * bits_per_key // BLOCK_BITS).bit_length())


def _hash(keys: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *keys)


def _words(keys: Sequence[str]) -> list[Column]:
    """The bits that a key sets, two in each word."""
    places = _hash(keys, 1)

    def bit(at: int) -> Column:
        place = F.shiftrightunsigned(places, 6 * at).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)).alias(w) for i, w in enumerate(WORDS)]


def key_filter(rows: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """``block`` and its words over the keys of the rows; repeated keys are combined before the shuffle."""
    block = F.pmod(_hash(keys, 0), F.lit(blocks)).alias("block")
    return rows.select(block, *_words(keys)).groupBy("block").agg(*(F.bit_or(w).alias(w) for w in WORDS))


def filter_hits(rows: DataFrame, keys: Sequence[str], filters: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Distinct keys of the rows with the ``append`` of each filter that they hit.

    ``filters`` has the columns of `FILTER`; ``sizes`` are the distinct numbers of blocks in it. A key is looked
    up once per size, not once per filter.
    """
    distinct = rows.select(*keys).distinct()
    mine = [w.alias(f"__{name}") for name, w in zip(WORDS, _words(keys))]
    probes = distinct.select(
        *keys, *mine, _hash(keys, 0).alias("__hash"),
        F.explode(F.array(*(F.lit(s).cast("long") for s in sizes))).alias("__blocks"))
    on = (probes["__blocks"] == filters["blocks"]) & (F.pmod("__hash", "__blocks") == filters["block"])
    for name in WORDS:
        on &= F.col(name).bitwiseAND(F.col(f"__{name}")) == F.col(f"__{name}")
    return probes.join(filters, on).select(*keys, F.col("append").alias("__append"))
