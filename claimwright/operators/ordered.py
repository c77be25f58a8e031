"""Tables stored in order: sorted files of disjoint ranges, and a table of their ranges.

:func:`store_ordered` pays for the order once, when it writes: a range shuffle
on the order columns, a sort inside each partition, one file (or a few in
sequence) for each, and a small range table with the first and last key of
every file, its rows, and how many rows lie before it.  After that

* :meth:`OrderedTable.between` opens only the files whose range meets the wanted
  one and gives their rows in order, without a sort or an exchange;
* :meth:`OrderedTable.positions` numbers all rows in order without a window: a
  row's number is the rows before its file plus its place in the file.

Rows with equal keys always lie in one range partition.  The order is ascending,
nulls first; rows that are equal in all order columns keep the order in which
they were written.  The range table has a row for each file, never for each
row of data, so its look-up may pass through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimwright.operators.materialize import materialize
from claimwright.session import scratch_path


@dataclass(frozen=True)
class OrderedTable:
    spark: SparkSession
    path: str
    order: tuple[str, ...]
    ranges: DataFrame  # file, low, high (structs of the order columns), rows, before

    def rows(self) -> DataFrame:
        """All rows, read in whatever order the scan likes."""
        return self.spark.read.parquet(self.path)

    def files_between(self, first: object = None, last: object = None) -> list[str]:
        """Files that can hold rows with ``first <= order[0] <= last``, in order (None: no bound)."""
        lead = self.order[0]
        wanted = self.ranges
        if first is not None:
            wanted = wanted.filter(F.col(f"high.{lead}") >= F.lit(first))
        if last is not None:  # a file that begins with nulls may hold more than nulls
            wanted = wanted.filter(F.col(f"low.{lead}").isNull() | (F.col(f"low.{lead}") <= F.lit(last)))
        return [r.file for r in wanted.orderBy("before", "high", "file").select("file").collect()]

    def between(self, first: object = None, last: object = None) -> DataFrame:
        """Rows with ``first <= order[0] <= last`` in order; without bounds all rows, nulls too."""
        schema = self.rows().schema
        files = self.files_between(first, last)
        if not files:
            return self.spark.createDataFrame([], schema)
        # The partitions of a union follow one another as its parts do.
        rows = reduce(DataFrame.union, [self.spark.read.schema(schema).parquet(f) for f in files])
        lead = F.col(self.order[0])
        bounds: list[Column] = [*([lead >= F.lit(first)] if first is not None else []),
                                *([lead <= F.lit(last)] if last is not None else [])]
        return reduce(lambda df, bound: df.filter(bound), bounds, rows)

    def positions(self, name: str = "position") -> DataFrame:
        """All rows with their number in the order, from 1; neither sorted nor shuffled."""
        # One row for each file of this table: bounded by the number of range partitions.
        starts = self.ranges.select(F.col("file").alias("__file"), "before")
        placed = self.rows().select("*", F.col("_metadata.file_path").alias("__of"), F.col("_metadata.row_index").alias("__at"))
        return (placed.join(F.broadcast(starts), F.col("__of") == F.col("__file"), "inner")
                .withColumn(name, F.col("before") + F.col("__at") + F.lit(1)).drop("__file", "__of", "__at", "before"))


def store_ordered(df: DataFrame, order: Sequence[str], name: str, num_partitions: int | None = None) -> OrderedTable:
    """Write ``df`` in ascending order of the columns ``order`` and record the range of each file.

    Without ``num_partitions`` the shuffle is sized from the data.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"ordered-{name}")
    keys = [F.col(c) for c in order]
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("errorifexists").parquet(path)
    stored = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"),
                                             F.struct(*order).alias("key"))
    ranges = stored.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("rows"))
    # A row for each file; only files that one task wrote in sequence can share a key.
    earlier = Window.orderBy("low", "high", "file").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    return OrderedTable(spark, path, tuple(order), materialize(ranges, f"ranges-{name}"))
