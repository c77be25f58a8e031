"""Token counts of byte-level BPE by rank-synchronous array merging.

A text is cut at the vocabulary's special strings (one token each, as the
library takes them by default) and then into pre-tokens by the vocabulary's
pattern, with the library's idea of letters and numbers.  The distinct pre-tokens of a batch that are not known yet become one
ragged numpy array of byte symbols.  In each round every sequence applies its
own lowest-ranked pair, at all places at once; sequences without a pair left
drop out; the symbols that survive are counted.  A merged symbol's own pairs
come later in the merge list than the pair it was made from (checked when the
vocabulary is read), so applying a pair everywhere at once equals applying it
from left to right; of overlapping places (a run of one symbol) every second
one is taken, from the left.

Only ranks next to a merge are looked up again, in a sorted table of pairs.
No shuffle; the vocabulary is read from its path in each Python worker.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows
are counted alike; an empty table gives an empty result.  Only the named
columns are read.
"""

from __future__ import annotations

import json
import re

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.common import map_texts

#: Fixed value: the pre-token pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters and numbers that are newer than the library's Unicode tables; to it they are other characters.
NEWER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
#: Pre-tokens whose counts a worker remembers, and the longest remembered one.
MEMORY_TOKENS, MEMORY_CHARS = 300_000, 48
#: Bytes of pre-tokens merged together.
MERGE_BYTES = 1 << 20
NO_RANK = np.int32(2**31 - 1)


def older_pattern() -> str:
    """:data:`PATTERN` with the newer characters moved out of the letters and numbers."""
    newer = "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in NEWER)
    return (PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]")
            .replace(r"\p{L}+", rf"[\p{{L}}--[{newer}]]+").replace(r"\p{N}+", rf"[\p{{N}}--[{newer}]]+"))


#: The first bytes of UTF-8 characters from the least newer one on.
MAYBE_NEWER = re.compile(b"[%c-\xf4]" % chr(NEWER[0][0]).encode()[0]).search


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for the
    characters from U+0100 on, in order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class RankMerger:
    """Merge ranks of a byte-level vocabulary as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.n = 1 + max(vocab.values())
        self.bytes = np.array([vocab[c] for c in byte_alphabet()], dtype=np.int64)
        born = {vocab[a + b]: r for r, (a, b) in reversed(list(enumerate(merges)))}
        if any(max(born.get(vocab[a], -1), born.get(vocab[b], -1)) >= r for r, (a, b) in enumerate(merges)):
            raise ValueError("a merge comes before the symbols it joins")
        keys = np.array([vocab[a] * self.n + vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        special = [t["content"] for t in spec.get("added_tokens", []) if t.get("special")]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.cut = regex.compile(PATTERN).findall
        self.cut_older = regex.compile(older_pattern(), regex.V1).findall
        self.known: dict[str, int] = {}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols that survive in each (non-empty) pre-token."""
        sizes = np.array([len(t) for t in tokens])
        symbols = self.bytes[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
        counts = sizes.copy()
        alive = np.arange(len(tokens))  # the sequences still in the arrays
        seq = np.repeat(alive, sizes)
        # ranks[i]: of the pair of symbols i and i + 1; none at a sequence's end.
        ranks = np.full(len(symbols), NO_RANK)
        inner = np.flatnonzero(seq[1:] == seq[:-1])
        ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            lengths = np.diff(np.r_[starts, len(seq)])
            lowest = np.minimum.reduceat(ranks, starts)
            going = lowest < NO_RANK
            if not going.all():
                counts[seq[starts[~going]]] = lengths[~going]
                stay = np.repeat(going, lengths)
                symbols, seq, ranks = symbols[stay], seq[stay], ranks[stay]
                lengths, lowest = lengths[going], lowest[going]
                if not len(symbols):
                    break
            at = np.flatnonzero(ranks == np.repeat(lowest, lengths))
            # Places one after another overlap: every second one from the left.
            run = np.r_[True, np.diff(at) != 1]
            first = np.flatnonzero(run)
            at = at[(np.arange(len(at)) - first[np.cumsum(run) - 1]) % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            stay = np.ones(len(symbols), dtype=bool)
            stay[at + 1] = False
            now = at - np.arange(len(at))  # places of the merged symbols afterwards
            symbols, seq, ranks = symbols[stay], seq[stay], ranks[stay]
            around = np.unique(np.r_[now, now[now > 0] - 1])
            inner = around[(around + 1 < len(seq))]
            same = inner[seq[inner] == seq[inner + 1]]
            ranks[around] = NO_RANK
            ranks[same] = self.rank(symbols[same], symbols[same + 1])
        return counts

    def learn(self, tokens: list[str]) -> dict[str, int]:
        """Counts of distinct pre-tokens, merged in groups of bounded size."""
        out: dict[str, int] = {}
        group: list[str] = []
        size = 0
        for t in [*tokens, None]:
            if t is None or size + len(t) > MERGE_BYTES:
                if group:
                    out.update(zip(group, self.count([g.encode() for g in group]).tolist()))
                group, size = [], 0
            if t is not None:
                group.append(t)
                size += len(t)
        return out

    def tokens(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text."""
        specials = [0] * len(texts)
        cut: list[list[str]] = []
        for i, raw in enumerate(texts):
            text = raw.decode("utf-8", "replace")
            find = self.cut_older if MAYBE_NEWER(raw) else self.cut
            if self.special and (found := len(self.special.findall(text))):
                specials[i] = found
                cut.append([t for part in self.special.split(text) for t in find(part)])
            else:
                cut.append(find(text))
        fresh = {t for tokens in cut for t in tokens if t not in self.known}
        counts = self.learn(sorted(fresh))
        if len(self.known) + len(counts) > MEMORY_TOKENS:
            counts.update({t: self.known[t] for tokens in cut for t in tokens if t in self.known})
            self.known = {}
        long = {t: n for t, n in counts.items() if len(t) > MEMORY_CHARS}
        self.known.update(counts)
        out = [n + sum(map(self.known.__getitem__, tokens)) for n, tokens in zip(specials, cut)]
        for t in long:
            del self.known[t]
        return out


_MERGERS: dict[str, RankMerger] = {}


def merger(path: str) -> RankMerger:
    """The worker's tables of a vocabulary."""
    if path not in _MERGERS:
        _MERGERS[path] = RankMerger(path)
    return _MERGERS[path]


def token_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: ``key``, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    def make():
        tables = merger(vocabulary)

        def fn(texts: list[bytes]) -> list[list]:
            return [list(map(len, texts)), tables.tokens(texts)]
        return fn

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return map_texts(docs, text, [key], fields, make).withColumn("over_limit", F.col("n_tokens") > limit)
