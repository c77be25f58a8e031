"""Source divergence audit: how far the vocabularies of a language's sources differ.

Each language keeps the terms in at least ``min_docs`` of its documents.  A
source's price of a term is 1 + floor(10^9 (count + 2) / (N + 2 V)), from the
term's count there, the source's N (all counts of kept terms) and the V kept
terms; two prices diverge by floor((p - q)^2 / (p + q)).  The audit gives, for
every source, its divergence from each other source summed over all kept terms
(part ``pair``) and the ``top`` terms that it has more of than its language
(part ``term``).

Pairs come from *one-hot level products*.  A price depends only on the source
and on the count there (its *level*), so two sources need no more than their
joint table: how many terms have level i in one and level j in the other.  A
block of terms becomes a 0/1 matrix with a column for each (source, level) that
occurs in it; the matrix transposed times itself holds the joint tables of all
pairs of sources at once (float products of 0 and 1 over at most
:data:`BLOCK_TERMS` rows are exact).  Each table is priced in 64-bit integers,
and the sums over blocks are the divergences.  Terms of like frequency share a
block, so few levels occur in it; a block with many columns is halved, and the
product is taken in panels of columns, so memory is bounded.

How it runs: each task counts terms of the documents it reads and emits sums,
which are added up by (language, source, term): a hot source or term is
combined before the shuffle.  Blocks hold a bounded number of terms; with over
:data:`PANEL_SOURCES` sources a block is worked off by pairs of source panels in
separate tasks.  Every source is paired with each other source of its language:
the result asks for them.

Defined cases: null text, language and source are ''; documents without terms
still make their source appear; a language without kept terms has V = 0, all
its pairs diverge by 0 and it lists no terms; repeated rows count again; an
empty table gives an empty result.  Only the named columns are read, so further
columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwright.llm.common import prepare, quoted, stored

#: Prices are in units of 1 / SCALE; each count is smoothed by SMOOTH.
SCALE, SMOOTH = 1_000_000_000, 2
#: Terms of one block, and the sources of one panel.
BLOCK_TERMS, PANEL_SOURCES = 1024, 256
#: A block with more columns is halved, down to this many terms; a product is taken in panels of so many columns.
MANY_COLUMNS, FEWEST_TERMS = 1024, 32
#: Distinct (source, term) counts that a task holds before it hands them on.
HELD_COUNTS = 400_000

#: Letters of A-Z and all characters beyond ASCII, in lower-cased UTF-8.
_TERMS = re.compile(rb"[a-z\x80-\xff]+").findall


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of what one task reads; term '' stands for the documents themselves."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                pa.array([t.decode("utf-8", "replace") for t in terms], pa.string()),
                pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in terms], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        counts.clear()

    held = 0
    for batch in batches:
        for lang, source, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.large_binary())):
            terms = Counter(_TERMS((body.as_py() or b"").lower()))
            terms[b""] = 1
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            held -= len(n)
            n.update(terms)
            docs.update(terms.keys())
            held += len(n)
            if held > HELD_COUNTS:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents); with term '' for all documents of a source."""
    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(quoted(lang).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(quoted(source).cast("string"), F.lit("")).alias("source"), quoted(text).alias("body"))
    counts = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE (count + SMOOTH) / (total + SMOOTH kept)), exact for all 64-bit counts."""
    top = (count + SMOOTH).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    bottom = (total + F.lit(SMOOTH) * kept).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", top, bottom)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) in 64-bit integers."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank (from 1 for each source and part)."""
    counts = stored(term_counts(docs, text, lang, source), "audit-counts")
    words = counts.filter("term != ''")
    kept = (words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
            .filter(F.col("docs") >= min_docs).drop("docs"))
    used = stored(words.drop("docs").join(kept, ["lang", "term"]), "audit-kept")  # a term has a row for each source at most

    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").na.fill(0, ["total"])
    terms = used.groupBy("lang").agg(F.count_distinct("term").alias("kept"))
    groups = groups.join(terms, "lang", "left").na.fill(0, ["kept"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stored(groups.withColumn("g", number), "audit-sources")

    return _pairs(groups, used).unionByName(_terms(groups, used, top))


def _ranked(rows: DataFrame, part: str, limit: int | None = None) -> DataFrame:
    first = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    rows = rows.withColumn("rank", F.row_number().over(first))
    if limit is not None:
        rows = rows.filter(F.col("rank") <= limit)
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _terms(groups: DataFrame, used: DataFrame, top: int) -> DataFrame:
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("kept").alias("kept"))
    rows = used.join(groups.select("lang", "source", "total"), ["lang", "source"]).join(langs, "lang")
    rows = rows.select("lang", "source", F.col("term").alias("item"),
                       price(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
                       price(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))
    rows = rows.filter("p > q").select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))
    return _ranked(rows, "term", top)


def _pairs(groups: DataFrame, used: DataFrame) -> DataFrame:
    prepare(groups.sparkSession)
    # Terms of like frequency share a block; a block has about BLOCK_TERMS terms, and at most a few more.
    size = F.floor(F.log2(F.col("lang_n")) * 2).cast("int")
    per_size = used.withColumn("size", size).groupBy("lang", "size").agg(F.count_distinct("term").alias("__terms"))
    cells = used.withColumn("size", size).join(per_size, ["lang", "size"]).join(groups.select("lang", "source", "g"), ["lang", "source"])
    block = F.pmod(F.xxhash64("term"), F.ceil(F.col("__terms") / BLOCK_TERMS)).cast("int")
    blocks = cells.groupBy("lang", "size", block.alias("block")).agg(
        F.collect_list(F.struct("term", "g", "n")).alias("cells"))
    # Each language also has a block without terms: its pairs appear whatever its terms are.
    langs = groups.groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("g", "total"))).alias("sources"), F.max("kept").alias("kept"))
    none = langs.select("lang", F.lit(-1).alias("size"), F.lit(0).alias("block"),
                        F.expr("CAST(array() AS array<struct<term: string, g: int, n: bigint>>)").alias("cells"))
    tasks = blocks.unionByName(none).join(langs, "lang")
    panels = F.sequence(F.lit(0), F.expr(f"CAST((size(sources) - 1) div {PANEL_SOURCES} AS INT)"))
    tasks = tasks.withColumn("a", F.explode(panels)).withColumn("b", F.explode(panels)).filter("a <= b")
    # Blocks differ in cost: deal them out one by one.
    parts = (tasks.repartition("lang", "size", "block", "a", "b")
             .mapInArrow(_multiply, "lang string, g int, h int, value long"))
    sums = parts.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    both = sums.select("lang", "value", F.explode(F.expr(
        "array(named_struct('g', g, 'h', h), named_struct('g', h, 'h', g))")).alias("x")).select("lang", "value", "x.g", "x.h")
    names = groups.select("lang", "g", "source")
    rows = (both.join(names, ["lang", "g"])
            .join(names.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"]))
    return _ranked(rows, "pair")


def _multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Divergence sums (g < h) over one block of terms, for sources of panel ``a`` against those of panel ``b``."""
    for batch in batches:
        lang, cells, sources, kept, a, b = (batch.column(c) for c in ("lang", "cells", "sources", "kept", "a", "b"))
        for i in range(batch.num_rows):
            totals = [s["total"] for s in sources[i].as_py()]
            flat = cells[i].values
            g, n = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("g", "n"))
            row = flat.field("term").dictionary_encode()
            terms, row = len(row.dictionary), row.indices.to_numpy(zero_copy_only=False)
            v, pa_, pb = kept[i].as_py(), a[i].as_py(), b[i].as_py()
            own = range(pa_ * PANEL_SOURCES, min((pa_ + 1) * PANEL_SOURCES, len(totals)))
            other = range(pb * PANEL_SOURCES, min((pb + 1) * PANEL_SOURCES, len(totals)))

            def matrix(groups: range) -> np.ndarray:
                out = np.zeros((terms, len(groups)), dtype=np.int64)
                here = (g >= groups.start) & (g < groups.stop)
                out[row[here], g[here] - groups.start] = n[here]
                return out

            def priced(groups: range) -> Callable[[int, np.ndarray], list[int]]:
                def prices(k: int, levels: np.ndarray) -> list[int]:
                    bottom = totals[groups.start + k] + SMOOTH * v
                    return [1 + SCALE * (c + SMOOTH) // bottom for c in levels.tolist()]
                return prices

            sums = joint_divergence(matrix(own), matrix(other), priced(own), priced(other))
            at = np.argwhere(np.add.outer(np.arange(own.start, own.stop), -np.arange(other.start, other.stop)) < 0)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang[i].as_py()] * len(at), pa.string()), pa.array(at[:, 0] + own.start, pa.int32()),
                pa.array(at[:, 1] + other.start, pa.int32()), pa.array(sums[at[:, 0], at[:, 1]], pa.int64())],
                names=["lang", "g", "h", "value"])


def one_hot(counts: np.ndarray, prices: Callable[[int, np.ndarray], list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indicator columns of all (source, level) that occur, their prices, and the first column of each source."""
    columns, values, first = [], [], []
    for k in range(counts.shape[1]):
        levels, level = np.unique(counts[:, k], return_inverse=True)
        first.append(len(values))
        columns.append(level + len(values))
        values += prices(k, levels)
    hot = np.zeros((len(counts), len(values)), dtype=np.float32)
    for at in columns:
        hot[np.arange(len(counts)), at] = 1
    return hot, np.array(values, dtype=np.int64), np.array(first, dtype=np.int64)


def joint_divergence(a: np.ndarray, b: np.ndarray, price_a: Callable, price_b: Callable) -> np.ndarray:
    """Sums over rows (terms) of the divergence of each column (source) of ``a`` from each of ``b``."""
    sums = np.zeros((a.shape[1], b.shape[1]), dtype=np.int64)
    if not len(a):
        return sums
    levels = sum(len(np.unique(x[:, k])) for x in (a, b) for k in range(x.shape[1]))
    if levels > MANY_COLUMNS and len(a) > FEWEST_TERMS:
        order = np.argsort(a.sum(axis=1) + b.sum(axis=1), kind="stable")
        for half in np.array_split(order, 2):
            sums += joint_divergence(a[half], b[half], price_a, price_b)
        return sums
    hot_a, p, first_a = one_hot(a, price_a)
    hot_b, q, first_b = one_hot(b, price_b)
    for at, from_a, to_a in _panels(first_a, len(p)):
        for bt, from_b, to_b in _panels(first_b, len(q)):
            joint = (hot_a[:, from_a:to_a].T @ hot_b[:, from_b:to_b]).astype(np.int64)
            p_, q_ = p[from_a:to_a, None], q[None, from_b:to_b]
            worth = joint * ((p_ - q_) ** 2 // (p_ + q_))
            by_row = np.add.reduceat(worth, first_a[at] - from_a, axis=0)
            sums[np.ix_(at, bt)] += np.add.reduceat(by_row, first_b[bt] - from_b, axis=1)
    return sums


def _panels(first: np.ndarray, columns: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """Sources whose columns make up about MANY_COLUMNS, with their first and last column."""
    ends = np.r_[first[1:], columns]
    k = 0
    while k < len(first):
        stop = max(k + 1, int(np.searchsorted(ends, first[k] + MANY_COLUMNS, side="right")))
        yield np.arange(k, stop), int(first[k]), int(ends[stop - 1])
        k = stop
