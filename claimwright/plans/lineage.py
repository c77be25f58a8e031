"""File-level audit: do the bronze rows account for every raw file, once?

The manifest is taken from the raw files themselves: their names and sizes from
a listing (no contents are read for that) and their rows from an independent
scan.  Reconciled with the rows of a bronze table, which name the file they came
from, it tells four cases apart: ``ok``, ``missing`` (a file has rows that bronze
lacks), ``doubled`` (bronze has more rows than the file) and ``unknown`` (bronze
names a file that is not there).  Both sides are aggregated to one row per file
before they meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.sources.files import read_raw


def _name(path: Column) -> Column:
    """A file's path as both sides write it: decoded, without scheme and authority."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^[a-z0-9+.-]+:(//[^/]*)?(?=/)", "")


def manifest(spark: SparkSession, source: str, raw_dir: str) -> DataFrame:
    """file, size and rows of each raw file of ``source``."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").option("recursiveFileLookup", True).load(raw_dir)
              .select(_name(F.col("path")).alias("file"), F.col("length").alias("size")))
    rows = (read_raw(spark, source, raw_dir).groupBy(F.col("_metadata.file_path").alias("path")).count()
            .select(_name(F.col("path")).alias("counted"), F.col("count").alias("rows")))
    return (listed.join(rows, listed["file"] == rows["counted"], "left")
            .select("file", "size", F.coalesce("rows", F.lit(0)).alias("rows")))


def reconcile(files: DataFrame, bronze: DataFrame) -> DataFrame:
    """file, size, rows, bronze_rows and status: one row per file that either side knows."""
    named = (bronze.groupBy("source_file").count()
             .select(_name(F.col("source_file")).alias("named"), F.col("count").alias("bronze_rows")))
    both = files.join(named, files["file"].eqNullSafe(named["named"]), "full")
    found = F.coalesce("bronze_rows", F.lit(0))
    status = (F.when(F.col("file").isNull(), "unknown").when(found < F.col("rows"), "missing")
              .when(found > F.col("rows"), "doubled").otherwise("ok"))
    return both.select(F.coalesce("file", "named").alias("file"), "size", "rows", found.alias("bronze_rows"), status.alias("status"))
