"""SimHash near-duplicates by multi-index hashing.

*Fingerprints.*  A-Z are lower-cased, words are runs of characters other than
space and \\t-\\r, shingles are ``shingle`` consecutive words joined by a space
(repeats count; fewer words: the whole sequence).  Each shingle is hashed by
XXH64 with seed 42; bit i of the fingerprint is set when it is set in more than
half of the hashes.  No words: fingerprint 0.

*Links* (:func:`hamming_links`).  The 64 bits are cut into ``segments``.  With
``max_distance = segments * q + a``, two codes within that distance agree up to
q bits in one of the first a + 1 segments or up to q - 1 bits in one of the
others.  So each code is stored under each of its segments, each code looks up
the Hamming ball of that radius around each of its segments, and each match is
verified on the whole code.

A segment value that very many codes share (a crowd, such as thousands of edits
of one text) would be matched with itself pair by pair.  Codes that look such a
value up, and those stored there, are linked by another exact way instead:
each is stored under every code in a ball of half the distance around it.  Two
codes share such a key exactly when they are close enough, so the members of a
key are linked to its smallest member, and the links grow with the rows.  The
links of a crowd are thus enough for its components, not all its pairs.

The looked-up and the starred rows come from an ``explode`` of some tens of
masks for each code, which Spark sizes like the codes themselves.  Their joins
are therefore told to shuffle both sides: left alone, Spark would broadcast
rows of many times the threshold through the driver.

*Classes.*  Links join distinct fingerprints, so copies cost nothing;
components are found by :func:`claimwright.llm.components.components` and
named after their smallest id.

Defined cases: null and empty texts have fingerprint 0 and are linked like any
other; null ids get their class's smallest id (null if it has none); repeated
rows are repeated in the result; an empty table gives an empty result.  Only
the id and the text column are read.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.common import map_texts, stored
from claimwright.llm.components import components

BITS = 64
SEED = 42
#: Codes under one segment value above which the value counts as a crowd.
CROWD = 64
#: Largest ball by which crowds are linked (distances up to 4; beyond it they are matched pair by pair).
MOST_STARS = 5000
#: Shingle hashes whose bits are counted at once.
BLOCK = 1 << 16

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    words = text.translate(_LOWER).split()  # splits at space and \t-\r
    if len(words) <= shingle:
        parts = [b" ".join(words)] if words else []
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), parts), dtype="<u8")


def fingerprint(hashes: np.ndarray) -> int:
    """Majority bits of the hashes as a signed 64-bit integer."""
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[i:i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``key`` and ``__code`` (the fingerprint as a signed long) of every row."""
    def make():
        return lambda texts: [[fingerprint(shingle_hashes(t, shingle)) for t in texts]]
    return map_texts(docs, text, [key], [T.StructField("__code", T.LongType())], make)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _ball(bits: range, radius: int) -> list[int]:
    """All masks of up to ``radius`` bits out of ``bits``."""
    return [sum(1 << b for b in some) for r in range(radius + 1) for some in combinations(bits, r)]


def _segments(segments: int, max_distance: int) -> list[tuple[int, int, list[int]]]:
    """(number, bit mask, ball masks) of each segment that has to be looked up."""
    q, a = divmod(max_distance, segments)
    edges = [BITS * i // segments for i in range(segments + 1)]
    out = []
    for i in range(segments):
        radius = q if i <= a else q - 1
        if radius >= 0:
            bits = range(edges[i], edges[i + 1])
            out.append((i, sum(1 << b for b in bits), _ball(bits, radius)))
    return out


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def hamming_links(codes: DataFrame, code: str, max_distance: int, segments: int = 2, crowd: int = CROWD) -> DataFrame:
    """Links (a, b), a < b, of distinct codes: they connect exactly the codes within ``max_distance``."""
    parts = _segments(segments, max_distance)
    c = F.col("code")
    codes = codes.select(F.col(code).alias("code")).distinct()
    table = codes.select("code", F.explode(F.array(*[
        F.struct(F.lit(i).alias("seg"), c.bitwiseAND(F.lit(_signed(mask))).alias("value")) for i, mask, _ in parts])).alias("p"))
    table = table.select("code", "p.seg", "p.value")
    probes = codes.select("code", F.explode(F.array(*[
        F.struct(F.lit(i).alias("seg"), F.lit(_signed(mask)).alias("mask"), F.lit(_signed(flip)).alias("flip"))
        for i, mask, ball in parts for flip in ball])).alias("p"))
    probes = probes.select("code", "p.seg", c.bitwiseXOR(F.col("p.flip")).bitwiseAND(F.col("p.mask")).alias("value"))

    if crowd is None or comb(BITS, (max_distance + 1) // 2) > MOST_STARS:
        thin = table.select("seg", "value", F.col("code").alias("other"))
        return _matches(probes, thin, max_distance)
    crowds = stored(table.groupBy("seg", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd)
                    .select("seg", "value"), "crowds")
    thin = table.join(crowds, ["seg", "value"], "left_anti").select("seg", "value", F.col("code").alias("other"))
    links = _matches(probes, thin, max_distance)
    crowded = probes.join(crowds, ["seg", "value"], "left_semi").select("code").distinct()
    return links.unionByName(_crowd_links(crowded, max_distance))


def _matches(probes: DataFrame, table: DataFrame, max_distance: int) -> DataFrame:
    """Codes stored under looked-up segment values, verified on the whole code."""
    near = _distance(F.col("code"), F.col("other")) <= max_distance
    return (probes.hint("merge").join(table, ["seg", "value"], "inner").filter((F.col("code") < F.col("other")) & near)
            .select(F.col("code").alias("a"), F.col("other").alias("b")))


def _crowd_links(codes: DataFrame, max_distance: int) -> DataFrame:
    near, far = max_distance // 2, (max_distance + 1) // 2
    masks = _ball(range(BITS), far)
    c = F.col("code")
    stars = codes.select("code", F.explode(F.array(*[
        F.struct(F.lit(_signed(m)).alias("flip"), F.lit(m.bit_count() <= near).alias("near")) for m in masks])).alias("p"))
    stars = stars.select("code", c.bitwiseXOR(F.col("p.flip")).alias("at"), F.col("p.near").alias("near"))
    centres = stars.filter("near").groupBy(F.col("at").alias("__at")).agg(F.min("code").alias("centre"))
    linked = stars.hint("merge").join(centres, F.col("at") == F.col("__at"), "inner").filter(
        (c != F.col("centre")) & (_distance(c, F.col("centre")) <= max_distance))
    return linked.select(F.least("code", "centre").alias("a"), F.greatest("code", "centre").alias("b")).distinct()


def simhash_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                  max_distance: int = 2, segments: int = 2, crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs``: ``key``, fingerprint (16 hex digits), component_id."""
    rows = stored(fingerprints(docs, key, text, shingle), "fingerprints")
    codes = stored(rows.groupBy("__code").agg(F.min(key).alias("__least")), "codes")
    roots = stored(components(hamming_links(codes, "__code", max_distance, segments, crowd), "a", "b"), "roots")
    linked = codes.join(roots, codes["__code"] == roots["node"], "left").select(
        "__code", "__least", F.coalesce("root", "__code").alias("__root"))
    least = linked.groupBy(F.col("__root").alias("__r")).agg(F.min("__least").alias("component_id"))
    named = stored(linked.join(least, linked["__root"] == least["__r"], "inner")
                   .select(F.col("__code").alias("__c"), "component_id"), "components")
    out = rows.join(named, rows["__code"] == named["__c"], "inner")
    return out.select(key, F.lower(F.lpad(F.hex("__code"), 16, "0")).alias("fingerprint"), "component_id")
