"""Pairs of rows with equal keys, where one key may have a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of either side that meet in one place.
BLOCK = 2_000


def _blocks(side: DataFrame, key: str, name: str, block: int) -> DataFrame:
    """(key, name): the number of blocks of the keys that need more than one."""
    return side.groupBy(key).agg(F.ceil(F.count("*") / block).alias(name)).where(F.col(name) > 1)


def _many(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(1).cast("bigint"))


def _range(first: Column, last: Column, name: str) -> Column:
    return F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias(name)


def equal_pairs(left: DataFrame, right: DataFrame, x: str, y: str, key: str = "k", block: int = BLOCK, blocks: str | None = None) -> DataFrame:
    """(x, y) for all rows of `left` (key, x) and `right` (key, y) with the same key; nulls match nothing.

    Rows of a key with more than `block` on a side are dealt to blocks, and every block of one side meets every
    block of the other in a place of its own: n * m pairs are made in places of about block * block, at the price of
    n * m / block rows shuffled for each side. Only such keys are looked up; the others pass as they are.
    Where both sides have a column `blocks` with the blocks of the key, that is taken and nothing is counted.
    """
    crowded = None if blocks else _blocks(left, key, "_l", block).join(_blocks(right, key, "_r", block), key, "full")

    def dealt(side: DataFrame, value: str, own: tuple[str, str], other: tuple[str, str]) -> DataFrame:
        sized = side.withColumns({"_l": F.col(blocks), "_r": F.col(blocks)}) if blocks else side.join(crowded, key, "left")
        return sized.select(key, value, F.pmod(F.xxhash64(value), _many(own[0])).alias(own[1]), _range(F.lit(0), _many(other[0]) - 1, other[1]))

    i, j = ("_l", "_i"), ("_r", "_j")
    return dealt(left, x, i, j).join(dealt(right, y, j, i), [key, "_i", "_j"]).select(x, y)


def self_pairs(rows: DataFrame, x: str, key: str = "k", once: str | None = None, block: int = BLOCK) -> DataFrame:
    """(a, b), a < b, for all different values x of `rows` (key, x) that share a key; a pair comes once for each of these.

    once: an array of the keys of the row's x that come before this one; a pair for which these overlap is left out, so it
    comes once, at the first key that it shares. Blocks as in `equal_pairs`, each two of them meet once.
    """
    dealt = rows.join(_blocks(rows, key, "_n", block), key, "left").select(key, x, *([once] if once else []), _many("_n").alias("_n")).withColumn("_own", F.pmod(F.xxhash64(x), F.col("_n")))
    more = lambda side: [F.col(once).alias(f"_{side}")] if once else []
    left = dealt.select(key, F.col(x).alias("a"), *more("a"), F.col("_own").alias("_i"), _range(F.col("_own"), F.col("_n") - 1, "_j"))
    right = dealt.select(key, F.col(x).alias("b"), *more("b"), F.col("_own").alias("_j"), _range(F.lit(0), F.col("_own"), "_i"))
    met = left.join(right, [key, "_i", "_j"]).where("a < b or _i < _j and a <> b")
    if once:
        met = met.where(~F.arrays_overlap("_a", "_b"))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
