"""Removal of long repeated passages by repeated-phrase automata.

A word is a run of characters other than space and \\t-\\r.  Every word covered
by a window of ``window`` consecutive words whose sequence also starts in a
document with a smaller id is removed; windows are judged on the input.

1. *Whole copies.*  Documents with the same word sequence as one with a smaller
   id are covered whole (if they have ``window`` words); only the smallest goes
   on, so thousands of copies cost one document.
2. *Candidates.*  Of the ``window - phrase + 1`` phrases (runs of ``phrase``
   words) in a window, the one with the least hash is its anchor; equal windows
   have equal anchors.  An aggregate over all anchors keeps those of two
   documents or more, and only windows with such an anchor are looked at further.
3. *Confirmed passages.*  Those windows (128-bit hash of the words, one of a kind
   for each document) are grouped; the ones of two documents or more recur.  One
   document of each owns it.  An owner's neighbouring windows with the same
   smallest id are written together, ``PIECE`` windows at most, as the words of
   one passage: the stored table of passages.
4. *Automata.*  A document is sent the passages that start in a smaller id and
   with which it shares a window.  The shards are Arrow slices of documents of
   bounded size; for each an Aho-Corasick automaton over word numbers
   (pyahocorasick) is compiled from phrases of its part of the passage table,
   one in every window, and all its documents are streamed through.
5. *Occurrences.*  Where the automaton reports a phrase of one of the document's
   passages, document and passage are compared word by word to both sides;
   stretches of ``window`` equal words or more are removed.  The result is taken
   from these occurrences alone, so a document's words are never dropped on the
   strength of a hash; that two *other* documents share a window rests on 128 bits.

The work is linear: a shard's automaton holds the passages of its own documents
only, so each text is streamed once, however many passages the corpus has.
Documents without a confirmed passage hold no occurrence and are not streamed.  A
phrase or passage that a third of the documents share is aggregated map-side and
joined back by joins that Spark can split.  A text is named by its id and its
hash, never by its id alone, so rows that share an id do not meet each other's.

Defined cases: null and empty texts have no words; documents with fewer than
``window`` words lose none; rows with a null id are neither smaller nor larger
than others and lose no word; repeated rows (equal id and text) are treated
alike and do not repeat each other; an empty table gives an empty result.  Only
the id and the text column are read.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.common import map_texts, stored

WINDOW, PHRASE = 50, 16
#: Windows that one stored passage holds at most.
PIECE = 64
#: Odd multipliers of the two rolling hashes.
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _hashes(words: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))


def rolling(values: np.ndarray, length: int, multiplier: np.uint64) -> np.ndarray:
    """Polynomial hash of each run of ``length`` values, by doubling."""
    n = len(values) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    run, size, power, done = values, 1, multiplier, 0  # run: hashes of `size` values
    with np.errstate(over="ignore"):
        while True:
            if length & size:
                out = out * power + run[done:done + n]
                done += size
            if done == length:
                return out
            run = run[:-size] * power + run[size:]
            size, power = 2 * size, power * power


def anchors(words: np.ndarray, window: int, phrase: int) -> np.ndarray:
    """For each window, the least mixed phrase hash in it."""
    grams = rolling(words, phrase, _M1)
    span = window - phrase + 1
    if len(grams) < span:
        return np.empty(0, dtype=np.uint64)
    least = mix(grams)
    size = 1
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    n = len(grams) - span + 1
    return np.minimum(least[:n], least[span - size:span - size + n])


def mix(hashes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (hashes ^ (hashes >> np.uint64(33))) * _MIX
    return h ^ (h >> np.uint64(29))


def _distinct_runs(values: np.ndarray) -> np.ndarray:
    return np.unique(values).view(np.int64)


def _survey(window: int, phrase: int):
    """Per text: n_words, hash of the word sequence (two longs), digest of the words, anchors."""
    def make():
        def fn(texts: list[bytes]) -> list[list]:
            out: list[list] = [[], [], [], [], []]
            for text in texts:
                words = text.split()
                joined = b" ".join(words)
                row = (len(words), *identity(joined), hashlib.sha256(joined).hexdigest(),
                       _distinct_runs(anchors(_hashes(words, 1), window, phrase)) if len(words) >= window else [])
                for column, value in zip(out, row):
                    column.append(value)
            return out
        return fn
    return make


def identity(joined: bytes) -> tuple[int, int]:
    """128-bit hash of a word sequence as two longs."""
    whole = xxhash.xxh128_intdigest(joined)
    return _signed(whole >> 64), _signed(whole & (2**64 - 1))


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _windows(window: int, phrase: int):
    """Per (text, its recurring anchors): windows with such an anchor, as first places and two hashes."""
    def fn(texts: list[bytes], wanted: list[np.ndarray]) -> list[list]:
        out: list[list] = [[], [], []]
        for text, want in zip(texts, wanted):
            numbers: dict[bytes, int] = {}
            doc = np.array([numbers.setdefault(w, len(numbers)) for w in text.split()], dtype=np.int64)
            vocabulary = list(numbers)
            first = _hashes(vocabulary, 1)[doc]
            starts = np.flatnonzero(np.isin(anchors(first, window, phrase).view(np.int64), want))
            p1 = rolling(first, window, _M1)[starts].view(np.int64)
            p2 = rolling(_hashes(vocabulary, 2)[doc], window, _M2)[starts].view(np.int64)
            one = _first_of_each(p1, p2)
            out[0].append(starts[one].astype(np.int32))
            out[1].append(p1[one])
            out[2].append(p2[one])
        return out
    return fn


def _first_of_each(p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """Places, ascending, where a pair stands for the first time."""
    _, one, which = np.unique(p1, return_index=True, return_inverse=True)
    if not np.array_equal(p2[one][which], p2):  # one first half, two second halves
        _, one = np.unique(np.stack([p1, p2], axis=1), axis=0, return_index=True)
    return np.sort(one)


def _pieces(window: int):
    """Per (owner's text, first places of its passages): their words; runs are ``PIECE`` windows at most."""
    def fn(texts: list[bytes], spans: list[np.ndarray]) -> list[list]:
        out: list[list] = [[], []]
        for text, flat in zip(texts, spans):
            words = text.split()
            pairs = flat.reshape(-1, 2).tolist()
            out[0].append([at for at, _ in pairs])
            out[1].append([b" ".join(words[at:at + n + window - 1]) for at, n in pairs])
        return out
    return fn


class Automaton:
    """Phrases of a shard's passages, compiled; finds where documents hold one."""

    def __init__(self, passages: list[np.ndarray], window: int, phrase: int):
        self.phrase, self.step = phrase, window - phrase + 1
        self.numbers: dict[tuple[int, ...], int] = {}
        #: For each passage, the (phrase number, place in the passage) of one phrase in every window.
        self.of = [[(self.numbers.setdefault(tuple(p[at:at + phrase].tolist()), len(self.numbers)), at)
                    for at in range(0, len(p) - phrase + 1, self.step)] for p in passages]
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for words, number in self.numbers.items():
            self.machine.add_word(words, number)
        if self.numbers:
            self.machine.make_automaton()

    def occurrences(self, doc: np.ndarray) -> list[tuple[int, int]]:
        """(place, phrase number) of every phrase in the document."""
        if not self.numbers:
            return []
        return [(end - self.phrase + 1, number) for end, number in self.machine.iter(tuple(doc.tolist()))]


def covered(doc: np.ndarray, own: list[tuple[np.ndarray, list[tuple[int, int]]]], found: list[tuple[int, int]],
            window: int) -> np.ndarray:
    """Which words of ``doc`` lie in a stretch of ``window`` words that it shares with one of its passages.

    ``own``: its passages with their phrases; ``found``: where the automaton met phrases.
    """
    holders: dict[int, list[tuple[np.ndarray, int]]] = {}
    for passage, phrases in own:
        for number, at in phrases:
            holders.setdefault(number, []).append((passage, at))
    marks = np.zeros(len(doc) + 1, dtype=np.int64)
    for place, number in found:
        for passage, at in holders.get(number, ()):
            low = max(0, place - at)  # the passage laid over the document
            high = min(len(doc), place - at + len(passage))
            off = place - at
            unequal = np.flatnonzero(doc[low:high] != passage[low - off:high - off]) + low
            cut = int(np.searchsorted(unequal, place))
            start = int(unequal[cut - 1]) + 1 if cut else low
            end = int(unequal[cut]) if cut < len(unequal) else high
            if end - start >= window:
                marks[start] += 1
                marks[end] -= 1
    return np.cumsum(marks[:-1]) > 0


def _without(window: int, phrase: int):
    """Per (text, its passages): identity, words removed, digest of the words kept."""
    def fn(texts: list[bytes], bodies: list[np.ndarray]) -> list[list]:
        numbers: dict[bytes, int] = {}

        def numbered(words: list[bytes]) -> np.ndarray:
            return np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)

        place: dict[bytes, int] = {}
        for body in bodies:
            for b in body:
                place.setdefault(b, len(place))
        passages = [numbered(b.split()) for b in place]
        automaton = Automaton(passages, window, phrase)
        out: list[list] = [[], [], [], []]
        for text, body in zip(texts, bodies):
            words = text.split()
            doc = numbered(words)
            own = [(passages[i], automaton.of[i]) for i in {place[b] for b in body}]
            gone = covered(doc, own, automaton.occurrences(doc), window)
            kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
            row = (*identity(b" ".join(words)), int(gone.sum()), hashlib.sha256(kept).hexdigest())
            for column, value in zip(out, row):
                column.append(value)
        return out
    return fn


_IDENTITY = ["__h1", "__h2"]
_NAME = ["__t1", "__t2"]


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """One row per row of ``docs``: ``key``, n_words, n_removed, kept_sha256 (of the kept words)."""
    if not 0 < phrase <= window:
        raise ValueError("a phrase must fit into a window")
    long, ids = T.LongType(), T.ArrayType(T.LongType())
    fields = [T.StructField("n_words", long), *[T.StructField(c, long) for c in _IDENTITY],
              T.StructField("__sha", T.StringType()), T.StructField("__anchors", ids)]
    d = F.col(key)
    # A text's name is its id and its hash: rows of one id stay apart.
    named = docs.select(d, F.col(text).alias("__body"), F.xxhash64(text).alias("__t1"), F.xxhash64(F.lit(1), text).alias("__t2"))
    survey = stored(map_texts(named, "__body", [key, *_NAME], fields, _survey(window, phrase)), "survey")

    # 1. The smallest id of each word sequence; its other rows are copies.
    firsts = stored(survey.filter((F.col("n_words") >= window) & d.isNotNull()).groupBy(*[F.col(c).alias(f"{c}f") for c in _IDENTITY])
                    .agg(F.min(key).alias("__first")), "firsts")
    rows = survey.join(firsts, (F.col("__h1") == F.col("__h1f")) & (F.col("__h2") == F.col("__h2f")), "left")
    rows = stored(rows.withColumn("__copy", F.coalesce(d > F.col("__first"), F.lit(False))).drop("__h1f", "__h2f"), "rows")

    # 2. Anchors of the others that occur in two documents, and the texts that hold them.
    spread = rows.filter(~F.col("__copy") & d.isNotNull()).select(
        d.alias("__id"), *[F.col(c).alias(f"{c}i") for c in _NAME], F.explode("__anchors").alias("anchor"))
    common = stored(spread.groupBy("anchor").agg(F.min("__id").alias("lo"), F.max("__id").alias("hi"))
                    .filter("lo < hi").select(F.col("anchor").alias("__a")), "phrases")
    held = spread.join(common, F.col("anchor") == F.col("__a"), "inner")
    held = held.groupBy("__id", "__t1i", "__t2i").agg(F.collect_set("anchor").alias("__wanted"))
    same = (d == F.col("__id")) & (F.col("__t1") == F.col("__t1i")) & (F.col("__t2") == F.col("__t2i"))
    chosen = named.join(held, same, "inner").select(key, "__body", "__wanted", F.monotonically_increasing_id().alias("__row"))
    chosen = stored(chosen, "chosen")

    # 3. Windows that recur, and their words from one owner each.
    up = map_texts(chosen, "__body", [key, "__row"], [T.StructField("at", T.ArrayType(T.IntegerType())),
                                                      T.StructField("p1", ids), T.StructField("p2", ids)],
                   lambda: _windows(window, phrase), with_column="__wanted")
    up = up.select(key, "__row", F.explode(F.arrays_zip("at", "p1", "p2")).alias("w"))
    up = stored(up.select(key, "__row", "w.*"), "windows")
    recurring = (up.groupBy(F.col("p1").alias("q1"), F.col("p2").alias("q2"))
                 .agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.min("__row").alias("owner")).filter("lo < hi").drop("hi"))
    meets = (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2"))
    joined = stored(up.join(recurring, meets, "inner").select(key, "__row", "at", "p1", "p2", "lo", "owner"), "recurring")
    own = _runs(joined.filter("__row = owner"))
    spans = own.groupBy("__row").agg(F.flatten(F.collect_set(F.array("run", "windows"))).alias("__spans"))
    spans = spans.select(F.col("__row").alias("__r"), "__spans")
    owners = chosen.select("__row", "__body").join(spans, F.col("__row") == F.col("__r"), "inner")
    passages = map_texts(owners, "__body", ["__row"], [T.StructField("at", T.ArrayType(T.IntegerType())),
                                                       T.StructField("words", T.ArrayType(T.BinaryType()))],
                         lambda: _pieces(window), with_column="__spans")
    passages = passages.select(F.col("__row").alias("__owner"), F.explode(F.arrays_zip("at", "words")).alias("p"))
    passages = stored(passages.select("__owner", F.col("p.at").alias("__run"), F.col("p.words").alias("words")), "passages")

    # 4. The passages of smaller ids go to the documents that share a window with them.
    where = own.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), "owner", "run")
    need = joined.filter(d > F.col("lo")).select("__row", "p1", "p2").join(where, meets, "inner")
    need = need.select(F.col("__row").alias("__r"), "owner", "run").distinct()
    sent = need.join(passages, (F.col("owner") == F.col("__owner")) & (F.col("run") == F.col("__run")), "inner")
    sent = sent.groupBy("__r").agg(F.collect_list("words").alias("__passages"))
    return _result(rows, chosen, sent, key, window, phrase)


def _runs(own: DataFrame) -> DataFrame:
    """Windows of owners with ``run``, the place at which their passage begins, and ``windows``, its length.

    A run ends where the next place or the smallest id differs, and after ``PIECE`` windows.
    The window partitions are the windows of one text, which one row held before.
    """
    places = Window.partitionBy("__row").orderBy("at")
    breaks = ((F.col("at") != F.lag("at").over(places) + 1) | (F.col("lo") != F.lag("lo").over(places)))
    stretch = F.sum(F.coalesce(breaks, F.lit(True)).cast("int")).over(places.rowsBetween(Window.unboundedPreceding, 0))
    numbered = own.withColumn("__stretch", stretch)
    inside = Window.partitionBy("__row", "__stretch")
    numbered = numbered.withColumn("__from", F.min("at").over(inside))
    numbered = numbered.withColumn("run", (F.col("at") - F.pmod(F.col("at") - F.col("__from"), F.lit(PIECE))).cast("int"))
    windows = F.count(F.lit(1)).over(Window.partitionBy("__row", "run")).cast("int")
    return stored(numbered.withColumn("windows", windows).select("__row", "owner", "run", "windows", "p1", "p2"), "runs")


def _result(rows: DataFrame, chosen: DataFrame, sent: DataFrame, key: str, window: int, phrase: int) -> DataFrame:
    """5. The words that occurrences of the passages cover are left out."""
    cut = chosen.join(sent, chosen["__row"] == sent["__r"], "inner").select(key, "__body", "__passages")
    fields = [*[T.StructField(f"{c}c", T.LongType()) for c in _IDENTITY],
              T.StructField("__removed", T.LongType()), T.StructField("__kept", T.StringType())]
    cut = map_texts(cut, "__body", [key], fields, lambda: _without(window, phrase), with_column="__passages")
    # Repeated rows give equal results; other texts of the same id have another identity.
    cut = stored(cut.withColumnRenamed(key, "__id").distinct(), "cut")
    same = (rows[key] == cut["__id"]) & (rows["__h1"] == cut["__h1c"]) & (rows["__h2"] == cut["__h2c"])
    out = rows.join(cut, same & ~rows["__copy"], "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(key, "n_words",
                      F.when(F.col("__copy"), F.col("n_words")).otherwise(F.coalesce("__removed", F.lit(0))).alias("n_removed"),
                      F.when(F.col("__copy"), nothing).otherwise(F.coalesce("__kept", "__sha")).alias("kept_sha256"))
