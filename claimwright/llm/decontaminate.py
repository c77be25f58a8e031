"""Benchmark decontamination by Wu-Manber multi-pattern search.

*Patterns.*  Texts are normalised on their UTF-8 bytes: A-Z become lower case,
words are runs of 0-9, a-z and characters from U+0080 on, and words are joined
by single spaces with one in front and one behind.  A benchmark item's windows
are its runs of ``window`` consecutive words (a shorter item is one window), in
the same form, so an occurrence of a window is an occurrence of its bytes.

*Search* (:class:`WuManber`).  Patterns are grouped by length, each group has
tables of its own.  With m the group's least length and B the block length,
SHIFT gives for the hash of a block how far the search may move on when the
block ends the current m bytes: m - B + 1 if no pattern has the block in its
first m bytes, and less by its last place in them otherwise.  Where the shift is
0, the patterns in the block's suffix-hash bucket are candidates; their first
bytes (the prefix test) and then all their bytes are compared directly.  numpy
moves the cursors of many short text segments at once, each by its own shift.

*Scale.*  Documents stay where they are: one pass, no shuffle.  The benchmark
is cut into pieces, pieces into blocks of at most about ``block_bytes``, and
only one block's text is broadcast at a time, so its size is bounded.  If there
are several blocks, the documents are written once with row numbers, each block
is searched for in a pass that writes the rows with hits alone (number, ranges,
items), and the last pass joins these by number, unique and so without skew.

Defined cases: null or empty texts have no words, no hits and are not
contaminated; items without words have no window; items with a null id are
searched like any other, have no name in ``items`` and count as one item
together in ``n_items``; repeated items count once by item id; repeated rows are
judged alike; empty tables give empty results or no hits.  Only the named
columns are read.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.common import map_texts, prepare, stored
from claimwright.session import scratch_path

WINDOW = 13
RESULTS = ("n_words", "n_hit", "n_items", "items", "contaminated")
#: Bytes of normalised benchmark text that are broadcast at once.
BLOCK_BYTES = 2 << 20
#: Words of one benchmark piece.
PIECE_WORDS = 4096
#: Block length B of the shift table, and bytes of one cursor's segment.
BLOCK, SEGMENT = 12, 512
_ROW = "__decontaminate_row"

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def normalised(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" " if words else b""


def windows_of(words: list[bytes], window: int) -> list[bytes]:
    return [normalised(words[i:i + window]) for i in range(max(1, len(words) - window + 1))] if words else []


class _Group:
    """Tables of the patterns whose length is in one class."""

    def __init__(self, patterns: list[bytes], ids: list[int]):
        self.patterns, self.ids = patterns, ids
        self.m = min(map(len, patterns))
        self.b = min(BLOCK, 1 + self.m // 2)
        text = np.frombuffer(b"".join(p + bytes(16) for p in patterns), dtype=np.uint8)
        starts = np.cumsum([0] + [len(p) + 16 for p in patterns[:-1]])
        bits = int(np.clip(np.ceil(np.log2(4 * self.m * len(patterns))), 12, 22))
        self.down = np.uint64(64 - bits)
        # SHIFT: a block's last place within the first m bytes of any pattern.
        self.shift = np.full(1 << bits, self.m - self.b + 1, dtype=np.int32)
        loads = _loads(text)
        for at in range(self.m - self.b + 1):
            self.shift[self.block(loads, starts + at)] = self.m - self.b - at
        # HASH: patterns by the hash of the block that ends their first m bytes.
        suffix = self.block(loads, starts + self.m - self.b)
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]
        # PREFIX: the first bytes, compared before the whole.
        self.head = np.uint64((1 << 8 * min(8, self.m)) - 1)
        self.prefix = (loads[starts] & self.head)[self.order]

    def block(self, loads: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hash of the b bytes at each place."""
        if self.b >= 8:
            h = loads[at] * _K1 ^ loads[at + (self.b - 8)] * _K2
        else:
            h = (loads[at] & np.uint64((1 << 8 * self.b) - 1)) * _K1
        return ((h ^ (h >> np.uint64(29))) * _K2) >> self.down

    def find(self, text: bytes, loads: np.ndarray) -> tuple[list[int], list[int]]:
        """Places and pattern ids of all occurrences in ``text``."""
        last = len(text) - self.m
        if last < 0:
            return [], []
        pos = np.arange(0, last + 1, SEGMENT)
        end = np.minimum(pos + SEGMENT, last + 1)
        found = []
        while len(pos):
            step = self.shift[self.block(loads, pos + (self.m - self.b))]
            if not step.all():
                found.append(pos[step == 0])
            pos = pos + np.maximum(step, 1)
            alive = pos < end
            if not alive.all():
                pos, end = pos[alive], end[alive]
        at: list[int] = []
        ids: list[int] = []
        if not found:
            return at, ids
        hits = np.concatenate(found)
        suffix = self.block(loads, hits + (self.m - self.b))
        low, high = np.searchsorted(self.suffix, suffix), np.searchsorted(self.suffix, suffix, side="right")
        count = high - low
        which = np.repeat(np.arange(len(hits)), count)
        slot = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + low[which]
        same = (loads[hits[which]] & self.head) == self.prefix[slot]
        for p, k in zip(hits[which[same]].tolist(), self.order[slot[same]].tolist()):
            if text.startswith(self.patterns[k], p):
                at.append(p)
                ids.append(self.ids[k])
        return at, ids


def _loads(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as an integer."""
    return np.ndarray(shape=(len(text) - 7,), dtype="<u8", buffer=text, strides=(1,))


class WuManber:
    """All occurrences of the patterns in a text."""

    def __init__(self, patterns: list[bytes]):
        by_class: dict[int, tuple[list[bytes], list[int]]] = {}
        for i, p in enumerate(patterns):
            some = by_class.setdefault(min(len(p), 32).bit_length() if len(p) < 27 else 0, ([], []))
            some[0].append(p)
            some[1].append(i)
        self.groups = [_Group(*some) for some in by_class.values()]

    def find(self, text: bytes) -> tuple[list[int], list[int]]:
        at: list[int] = []
        ids: list[int] = []
        loads = _loads(np.frombuffer(text + bytes(24), dtype=np.uint8))
        for group in self.groups:
            more = group.find(text, loads)
            at += more[0]
            ids += more[1]
        return at, ids


class Matcher:
    """Words of documents that occurrences of the items' windows cover."""

    def __init__(self, pieces: list[tuple[str | None, bytes]], window: int):
        items: dict[bytes, set[str | None]] = {}
        for item, text in pieces:
            for w in windows_of(text.split(), window):
                items.setdefault(w, set()).add(item)
        self.items = list(items.values())
        self.lengths = [w.count(b" ") - 1 for w in items]
        self.search = WuManber(list(items)) if items else None

    def __call__(self, texts: list[bytes]) -> list[list]:
        """n_words, hit ranges (start, end, ... in words, merged) and items of each text."""
        docs = [normalised(words_of(t)) for t in texts]
        n_words = [max(0, d.count(b" ") - 1) for d in docs]
        ranges: list[list[int]] = [[] for _ in docs]
        items: list[list[str | None]] = [[] for _ in docs]
        whole = b"\0".join(docs)
        at, ids = self.search.find(whole) if self.search else ([], [])
        if at:
            starts = np.cumsum([0] + [len(d) + 1 for d in docs[:-1]])
            spaces = np.flatnonzero(np.frombuffer(whole, dtype=np.uint8) == 32)
            places = np.array(at)
            doc = np.searchsorted(starts, places, side="right") - 1
            word = np.searchsorted(spaces, places) - np.searchsorted(spaces, starts)[doc]
            order = np.lexsort((word, doc))
            seen: dict[int, set[str | None]] = {}
            for d, w, k in zip(doc[order].tolist(), word[order].tolist(), np.array(ids)[order].tolist()):
                _extend(ranges[d], w, w + self.lengths[k])
                seen.setdefault(d, set()).update(self.items[k])
            for d, names in seen.items():
                items[d] = sorted(names, key=lambda n: (n is None, n))
        return [n_words, ranges, items]


def _extend(ranges: list[int], start: int, end: int) -> None:
    """Add a range to sorted, merged ranges; starts come in order."""
    if ranges and start <= ranges[-1]:
        ranges[-1] = max(ranges[-1], end)
    else:
        ranges += [start, end]


_MATCHERS: dict[str, Matcher] = {}


def _matcher(name: str, pieces: list[tuple[str | None, bytes]], window: int) -> Matcher:
    """One block's tables, kept while a worker works on that block."""
    if name not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[name] = Matcher(pieces, window)
    return _MATCHERS[name]


def _pieces(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(item, piece, bytes): normalised pieces of the items that together hold all their windows once."""
    step = PIECE_WORDS - window + 1

    def make():
        def fn(texts):
            out = []
            for t in texts:
                words = words_of(t)
                out.append([b" ".join(words[i:i + PIECE_WORDS]).decode("utf-8", "replace")
                            for i in range(0, max(1, len(words) - window + 1), step)] if words else [])
            return [out]
        return fn

    field = T.StructField("__pieces", T.ArrayType(T.StringType()))
    named = benchmark.select(benchmark[item].cast("string").alias("__item"), benchmark[text].alias("__text0"))
    cut = map_texts(named, "__text0", ["__item"], [field], make)
    cut = cut.select(F.col("__item").alias("item"), F.explode("__pieces").alias("piece")).distinct()
    return cut.withColumn("size", F.octet_length("piece"))


def _blocks(pieces: DataFrame, block_bytes: int) -> DataFrame:
    """Pieces dealt into blocks of about ``block_bytes`` at most (one piece at least)."""
    total, most = pieces.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    n = max(1, -(-total // block_bytes))
    while True:
        dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item", "piece"), F.lit(n)).cast("int"))
        largest = dealt.groupBy("block").agg(F.sum("size").alias("size")).agg(F.max("size")).first()[0] or 0
        if n == 1 or largest <= 2 * max(block_bytes, most):
            return dealt
        n *= 2


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = WINDOW, share: int = 20,
                  keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns (``key`` by default), n_words, n_hit, n_items, items, contaminated.

    ``items`` are the ids (as text, sorted) of the items with occurring
    windows, ``n_items`` is their number, and one more if windows of items
    without id occur; contaminated: n_hit > 0 and share * n_hit >= n_words.  A
    kept column named like one of these gives way to it.
    """
    spark = docs.sparkSession
    prepare(spark)
    keep = [c for c in keep or [key] if c not in RESULTS]
    blocks = stored(_blocks(stored(_pieces(benchmark, item, item_text, window), "pieces"), block_bytes), "blocks")
    numbers = sorted(r[0] for r in blocks.select("block").distinct().collect())
    fields = [T.StructField("n_words", T.LongType()), T.StructField("__ranges", T.ArrayType(T.IntegerType())),
              T.StructField("__items", T.ArrayType(T.StringType()))]

    def searched(rows: DataFrame, number: int | None, carried: list[str]) -> DataFrame:
        """The rows' hits in one block, whose text alone is broadcast."""
        block = [(r.item, r.piece.encode()) for r in
                 blocks.filter(F.col("block") == number).select("item", "piece").collect()] if number is not None else []
        shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex
        return map_texts(rows, "__body", carried, fields, lambda: _matcher(name, shared.value, window))

    rows = docs.select(*[docs[c] for c in keep], docs[text].alias("__body"))
    if len(numbers) <= 1:
        rows = searched(rows, numbers[0] if numbers else None, keep)
    else:
        # The texts are written once, with a number for each row; of a block's pass only rows with hits are.
        rows = stored(rows.withColumn(_ROW, F.monotonically_increasing_id()), "decontaminate")
        hits = scratch_path(spark, "table-llm-hits")
        for number in numbers[:-1]:
            found = searched(rows, number, [_ROW]).filter(F.size("__ranges") > 0)
            found.select(_ROW, "__ranges", "__items").write.parquet(f"{hits}/block={number}")
        earlier = spark.read.schema(rows.select(_ROW).schema.add(fields[1]).add(fields[2])).option("recursiveFileLookup", "true").parquet(hits)
        earlier = earlier.groupBy(F.col(_ROW).alias("__of")).agg(
            F.flatten(F.collect_list("__ranges")).alias("__more"), F.flatten(F.collect_list("__items")).alias("__named"))
        last = searched(rows, numbers[-1], [*keep, _ROW])
        none = F.array().cast("array<int>"), F.array().cast("array<string>")
        rows = (last.join(earlier, last[_ROW] == earlier["__of"], "left")
                .withColumn("__ranges", F.concat("__ranges", F.coalesce("__more", none[0])))
                .withColumn("__items", F.array_sort(F.array_union("__items", F.coalesce("__named", none[1])))))
    return (rows.withColumn("n_hit", _covered(F.col("__ranges")))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
            .select(*keep, "n_words", "n_hit", F.size("__items").cast("long").alias("n_items"),
                    F.array_compact("__items").alias("items"), "contaminated"))


def _covered(flat):
    """Words that the ranges (start, end, start, end ...) of all blocks cover together."""
    pairs = F.transform(F.sequence(F.lit(0), (F.size(flat) / 2 - 1).cast("int")), lambda i: F.struct(
        flat[(i * 2).cast("int")].alias("s"), flat[(i * 2 + 1).cast("int")].alias("e")))
    pairs = F.when(F.size(flat) == 0, F.array().cast("array<struct<s:int,e:int>>")).otherwise(F.array_sort(pairs))
    zero = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(pairs, zero, lambda a, p: F.struct(
        F.greatest(a["to"], p["e"]).alias("to"),
        (a["n"] + F.greatest(F.lit(0), p["e"] - F.greatest(a["to"], p["s"]))).alias("n")), lambda a: a["n"])
