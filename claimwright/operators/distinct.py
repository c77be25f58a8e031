"""Exact distinct counts that roll up.

The distinct count of a month says nothing about its quarter; the set does.
Values get dense numbers from 1 up (:func:`number_values`), and sets are kept
by block of :data:`BITS` numbers, in one of two forms:

* *cells* (:func:`cells`): per group and block the sorted positions that occur.
  For fine groups, which hold few numbers of a block; all cells together have at
  most one entry for each distinct pair of group and value.
* *bitmaps* (:func:`bitmaps`): per group and block one bitmap of 4 KB.  For
  coarse groups, which hold many numbers of a block: a month of a large table
  takes one bit a member, where ``count(distinct)`` shuffles a row for each.
  Bitmaps of finer groups merge into coarser ones (:func:`merged`) without the
  rows or the cells.

Groups that hold few numbers of a block (a provider's members) are counted from
the cells by Spark's two-step distinct count (:func:`counted`): 4 KB would be
larger than what they hold.

Every aggregate combines map-side, and a buffer holds one block at most, so a
key with a third of all rows is as small as any other.  Null values are not
counted; a group with nulls only counts 0; null group keys are a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.operators.ranking import global_row_number

#: Bits of one of Spark's bitmaps: numbers in a block.
BITS = 32_768


def number_values(df: DataFrame, column: str, number: str) -> DataFrame:
    """(column, number): the distinct values that are not null, numbered from 1 in their order."""
    return global_row_number(df.select(column).filter(F.col(column).isNotNull()).distinct(), [F.col(column)], number)


def with_number(df: DataFrame, column: str, numbers: DataFrame, number: str) -> DataFrame:
    """``df`` with each value's number; null for a null value."""
    found = numbers.select(F.col(column).alias("__value"), number)
    return df.join(found, df[column] == found["__value"], "left").drop("__value")


def cells(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """(keys, block, positions) of the numbers that occur in each group."""
    position = F.bitmap_bit_position(number).cast("int")
    return df.groupBy(*keys, F.bitmap_bucket_number(number).alias("block")).agg(
        F.sort_array(F.collect_set(position)).alias("positions"))


def numbers_of(fine: DataFrame, keys: list[str], number: str) -> DataFrame:
    """(keys, number): the cells' numbers one by one; null where a group has none."""
    each = fine.select(*keys, "block", F.explode_outer("positions").alias("position"))
    return each.select(*keys, ((F.col("block") - 1) * BITS + F.col("position") + 1).alias(number))


def counted(fine: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct count of each group, from the cells."""
    return numbers_of(fine, keys, "__number").groupBy(*keys).agg(F.count_distinct("__number").alias(name))


def bitmaps(fine: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, block, bits) of coarser groups, from the cells."""
    each = fine.select(*keys, "block", F.explode_outer("positions").alias("position"))
    return each.groupBy(*keys, "block").agg(F.bitmap_construct_agg(F.col("position").cast("bigint")).alias("bits"))


def merged(bits: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of coarser groups, from those of finer ones."""
    return bits.groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def cardinality(bits: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct count of each group, from its bitmaps."""
    return bits.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))
