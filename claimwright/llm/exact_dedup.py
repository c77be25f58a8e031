"""Exact de-duplication by deterministic block naming.

Each text is cut into blocks of a fixed number of characters.  Equal blocks
get one integer name, different blocks different ones; then adjacent names are
paired, and equal pairs get one name again, until one name is left per
document.  Two texts of as many blocks are equal exactly when their last names
are: no hash decides, so there are no collisions.

*Block names.*  Distinct blocks are found by an aggregate on their content
(copies meet map-side first), sorted by content within their partitions and
numbered.  To carry the names back, occurrences would have to be joined on
whole blocks; instead both sides carry a 128-bit key of the block, and the
names are first checked to have one block per key (else the keys are drawn
anew).  So each text is shuffled once, and the names rest on the content alone.

*Pair names.*  The same on pairs of integers: distinct pairs, sorted, numbered,
joined back.  The rows halve with every level; the number of levels is the
logarithm of the longest text's blocks.

Every join has a shuffle on each side, so Spark can split the partition of a
name that a third of the rows carry.  DataFrame functions only.

Defined cases: null text equals the empty text; a null id is smaller than any
id; of rows equal in text and id one stays; an empty table gives an empty
result.  Only the id and the text column are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.llm.common import stored

#: Characters of one block.
BLOCK_CHARS = 4096


def _named(keys: DataFrame, by: list[str]) -> DataFrame:
    """Distinct rows of ``keys`` with an integer ``__name``: sorted, then numbered."""
    distinct = keys.distinct().sortWithinPartitions(*by)
    return distinct.withColumn("__name", F.monotonically_increasing_id())


def _blocks(texts: DataFrame, block_chars: int) -> DataFrame:
    """One row per block: the text's columns, ``__pos``, ``__n`` (blocks), ``__block``.

    Cut in one pass over the text; the empty text is one empty block.
    """
    cut = F.regexp_extract_all("__text", F.lit("(?s).{1,%d}" % block_chars), F.lit(0))
    cut = F.when(F.col("__text") == "", F.array(F.lit(""))).otherwise(cut)
    cuts = texts.withColumn("__blocks", cut).drop("__text").withColumn("__n", F.size("__blocks"))
    return cuts.select("*", F.posexplode("__blocks").alias("__pos", "__block")).drop("__blocks")


def _name_blocks(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``__name`` in place of ``__block``."""
    salt = 0
    while True:
        h1, h2 = F.xxhash64("__block"), F.xxhash64(F.lit(salt), "__block")
        keyed = blocks.withColumns({"__h1": h1, "__h2": h2})
        names = _named(keyed.select("__h1", "__h2", "__block"), ["__h1", "__h2", "__block"])
        names = stored(names.select("__h1", "__h2", "__name"), "block-names")
        if names.groupBy("__h1", "__h2").count().filter("count > 1").isEmpty():
            break
        salt += 1  # different blocks share a key: other keys
    names = names.select(F.col("__h1").alias("__k1"), F.col("__h2").alias("__k2"), "__name")
    thin = keyed.drop("__block")
    same = (thin["__h1"] == names["__k1"]) & (thin["__h2"] == names["__k2"])
    return thin.join(names, same, "inner").drop("__h1", "__h2", "__k1", "__k2")


def _halved(level: DataFrame) -> DataFrame:
    """Adjacent names paired, and the pairs named."""
    half = F.floor(F.col("__pos") / 2).cast("int")
    side = lambda rest: F.max(F.when(F.col("__pos") % 2 == rest, F.col("__name")))
    others = [F.max(c).alias(c) for c in level.columns if c not in ("__row", "__pos", "__name")]
    pairs = level.groupBy("__row", half.alias("__half")).agg(side(0).alias("__a"), side(1).alias("__b"), *others)
    pairs = stored(pairs.withColumnRenamed("__half", "__pos").withColumn("__b", F.coalesce("__b", F.lit(-1))), "pairs")
    names = stored(_named(pairs.select(F.col("__a").alias("__x"), F.col("__b").alias("__y")), ["__x", "__y"]), "pair-names")
    joined = pairs.join(names, (pairs["__a"] == names["__x"]) & (pairs["__b"] == names["__y"]), "inner")
    return joined.drop("__a", "__b", "__x", "__y")


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS,
             normalise: Column | None = None) -> DataFrame:
    """``key``, text_sha256, ``__n`` and ``__name``: equal (``__n``, ``__name``) means equal text.

    ``normalise`` is the text as compared; by default the text itself, null as empty.
    """
    body = F.coalesce(docs[text], F.lit("")) if normalise is None else F.coalesce(normalise, F.lit(""))
    texts = docs.select(F.monotonically_increasing_id().alias("__row"), docs[key].alias(key), body.alias("__text"))
    texts = texts.withColumn("text_sha256", F.sha2("__text", 256))
    blocks = _blocks(texts, block_chars)
    blocks = blocks.withColumn("text_sha256", F.when(F.col("__pos") == 0, F.col("text_sha256")))
    level = stored(_name_blocks(blocks), "level-0")
    done = level.filter("__n = 1")
    longest = level.agg(F.max("__n")).first()[0] or 1
    reach = 1
    while reach < longest:
        reach *= 2
        level = stored(_halved(level.filter(F.col("__n") > reach // 2)), f"level-{reach}")
        done = done.unionByName(level.filter(F.col("__n").between(reach // 2 + 1, reach)))
    return done.select("__row", key, "text_sha256", "__n", "__name")


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs``: ``key``, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays.
    """
    named = stored(identify(docs, key, text, block_chars), "identities")
    best = F.max(F.struct(F.col(key).alias("k"), F.col("__row").alias("r")))
    # Stored, so that both sides of the join are shuffled for it and a large
    # group's partition can be split.
    groups = stored(named.groupBy(F.col("__n").alias("__gn"), F.col("__name").alias("__gname")).agg(
        best.alias("__best"), F.count(F.lit(1)).alias("group_size")), "groups")
    out = named.join(groups, (named["__n"] == groups["__gn"]) & (named["__name"] == groups["__gname"]), "inner")
    return out.select(key, F.col("__best.k").alias("keep_id"), "group_size",
                      (F.col("__row") == F.col("__best.r")).alias("kept"), "text_sha256")
