"""Write an intermediate result once and read it back.

Used where one lazily defined table feeds several consumers (the processed
claims feed the claim rows *and* two statistics aggregates): without it
each consumer recomputes the whole upstream chain, because column pruning
makes the three sub-plans differ so Spark cannot reuse their shuffles.

The table goes to a fresh folder under ``spark.checkpoint.dir`` (shared
storage on a cluster), as parquet so that every later read prunes columns
and pushes filters down.  Reading it back also cuts the lineage: a lost
executor recomputes from the stored table, not from the raw sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from claimwright.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"table-{name}")
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
