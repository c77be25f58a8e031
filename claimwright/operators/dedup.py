"""Keep one row per key: the first by a given ordering.

Expressed as ``row_number() over (partition by keys order by ...) = 1``.
Catalyst turns this into a ``WindowGroupLimit`` that is applied once per
map task *before* the shuffle and once after it, so a hot key (even one
holding a third of all rows) reaches the shuffle as at most one row per map
task; the final sort per key sees only those survivors.

The ordering should be total: pass tie-break columns after the business
ordering, otherwise the surviving row of a tie depends on task scheduling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW = "__keep_rank"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (NULL keys form one group)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(_ROW, F.row_number().over(w))
              .filter(F.col(_ROW) == 1)
              .drop(_ROW))


def latest_first(ts: str, tie_break: Sequence[str] = ()) -> list[Column]:
    """Newest ``ts`` first (NULL last), then ``tie_break`` ascending, NULL last."""
    return [F.col(ts).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie_break]
