"""Sharding by a hierarchical weighted hash tree.

A tree has regions, regions have racks, racks have shards; a node's weight is
the sum of the weights of the shards below it.  A shard's draw for a row is
``-ln(u) / weight`` with ``u`` a uniform hash of (key, shard id).  A rack's draw
is the least draw of its shards and a region's the least of its racks: the
minimum of such draws is distributed like one draw with the summed weight, so
each level has a weighted hash draw of its own.  A row descends the levels by
the least draw, and a child is chosen with probability weight / total.

A draw depends on the key, the shard's id and its own weight only.  When one
shard's weight grows, rows move only into that shard, when it shrinks only out
of it, whatever its place in the tree: no other subtree exchanges rows.  A shard
more, in an existing rack or in a new one, takes rows only into itself, so the
layout of n + 1 shards differs from that of n by exactly those rows.

Everything is a column expression: no shuffle to place rows.  Slots need one:
rows are numbered inside (shard, hash bucket of the key) cells of bounded
size, and each cell starts where the smaller cells of its shard end.

Defined cases: a null key is the key 0 with its own hash; a null text has
size 8 and CRC 0; equal keys always share a shard, and repeated rows still get
slots of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from claimwright.llm.common import stored

#: Rows that one cell of the slot numbering holds on average.
CELL_ROWS = 50_000


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(shards: int, racks_per_region: int = 2, shards_per_rack: int = 4) -> list[Shard]:
    """Shards 0..n-1 of equal weight, filled rack by rack."""
    return [Shard(i // (shards_per_rack * racks_per_region), i // shards_per_rack, i) for i in range(shards)]


def grow(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """One shard more, in a rack and a region of its own."""
    return [*tree, Shard(1 + max(s.region for s in tree), 1 + max(s.rack for s in tree),
                         1 + max(s.shard for s in tree), weight)]


def _draw(key: Column, shard: Shard) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit("shard"), F.lit(shard.shard), key), 11)
    u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.ln(u) / F.lit(shard.weight)


def _nodes(tree: list[Shard], level: str, parent: str | None) -> dict[int | None, dict[int, list[int]]]:
    """By parent node: its children, each with the places of its shards in ``tree``."""
    out: dict[int | None, dict[int, list[int]]] = {}
    for place, s in enumerate(tree):
        kids = out.setdefault(getattr(s, parent) if parent else None, {})
        kids.setdefault(getattr(s, level), []).append(place)
    return out


def _least(draws: Column, children: dict[int, list[int]]) -> Column:
    """The child with the least draw; equal draws: the smaller id."""
    def one(node: int, places: list[int]) -> Column:
        below = [draws[p] for p in places]
        return F.struct((F.least(*below) if len(below) > 1 else below[0]).alias("draw"), F.lit(node).alias("node"))

    if len(children) == 1:
        return F.lit(next(iter(children)))
    return F.array_min(F.array(*[one(n, p) for n, p in sorted(children.items())]))["node"]


def _below(chosen: Column, draws: Column, by_parent: dict) -> Column:
    out = None
    for parent, kids in sorted(by_parent.items()):
        out = F.when(chosen == parent, _least(draws, kids)) if out is None else out.when(chosen == parent, _least(draws, kids))
    return out


def assign_shard(df: DataFrame, key: str, tree: list[Shard], name: str) -> DataFrame:
    """``df`` with column ``name``: the shard of each row's key.  Shards without weight get no rows."""
    tree = [s for s in tree if s.weight > 0]
    k = F.coalesce(df[key], F.lit(0).cast(df.schema[key].dataType))
    k = F.struct(k, df[key].isNull())
    df = df.withColumn("__draws", F.array(*[_draw(k, s) for s in tree]))
    draws = F.col("__draws")
    df = df.withColumn("__region", _least(draws, _nodes(tree, "region", None)[None]))
    df = df.withColumn("__rack", _below(F.col("__region"), draws, _nodes(tree, "rack", "region")))
    df = df.withColumn(name, _below(F.col("__rack"), draws, _nodes(tree, "shard", "rack")).cast("int"))
    return df.drop("__draws", "__region", "__rack")


def number_slots(df: DataFrame, shard: str, order: list[str], rows: int, name: str) -> DataFrame:
    """Column ``name``: gapless numbers from 0 within each shard.

    ``rows`` is the row count; it fixes the number of cells, so one cell (the
    window's group) stays near ``CELL_ROWS`` however large a shard is.  Cells
    are cut by the hash of ``order``, which must name each row once, so a key
    that holds a third of all rows is spread too.
    """
    shards = df.select(shard).distinct().count()
    cells = max(1, -(-rows // (CELL_ROWS * max(1, shards))))
    df = df.withColumn("__cell", F.pmod(F.xxhash64(F.lit("cell"), *order), F.lit(cells)).cast("int"))
    counts = df.groupBy(shard, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(shard).alias("__s"), F.col("__cell").alias("__c"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(shard, "__cell").orderBy(*order)
    df = df.withColumn("__i", F.row_number().over(inside))
    joined = df.join(starts, (df[shard] == starts["__s"]) & (df["__cell"] == starts["__c"]), "left")
    return joined.withColumn(name, F.col("__start") + F.col("__i") - 1).drop("__s", "__c", "__cell", "__i", "__start")


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Place every row: key, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``key``: the key and the shard count decide.  ``grown_shard``
    is the shard after one more is added.  Rows of equal text are separate
    rows of this law; ``text_crc32`` and ``size`` name their group.
    """
    tree = layout(shards)
    t = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(docs[key].alias(key), (F.octet_length(t) + 8).cast("long").alias("size"),
                       F.crc32(t.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    rows = assign_shard(rows, key, tree, "shard")
    rows = assign_shard(rows, key, grow(tree), "grown_shard")
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "shards")
    out = number_slots(rows, "shard", ["__row"], rows.count(), "slot")
    return out.select(key, "size", "text_crc32", "law", "shard", F.col("slot").cast(T.LongType()).alias("slot"), "grown_shard")
