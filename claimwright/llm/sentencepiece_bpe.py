"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

*Encoding* (:class:`MergeEncoder`).  The text is prepared as the vocabulary's
normaliser does it (a space in front, spaces become U+2581) and cut into
characters.  An agenda (a heap; a list for short words) holds every adjacent pair of symbols whose
concatenation is a piece, the highest score first, then the leftmost.  The best
pair is merged and its new neighbours are put on the agenda; entries whose
symbols have changed meanwhile are skipped.  What is left is looked up; unknown
characters become byte pieces.

No piece goes on with other characters and then U+2581, and none joins a line
feed to another character (both checked when the vocabulary is read).  So
merges never cross into a following space or over a line feed: words between
them are encoded one by one, and a worker remembers the ids of recent words.

*Check.*  In each Arrow batch, every word that has been merged is encoded by
the sentencepiece library too, and so is the batch's first text as a whole; a
difference fails the task, so the result is never unlike the library's.

*Decoding.*  The pieces' texts are joined, byte pieces read as UTF-8 (each byte
that is not part of a character becomes U+FFFD), U+2581 becomes a space and the
space in front goes.  Every decoded text is compared with the library's
``decode(ids)``.

No shuffle: documents are encoded where they lie; the vocabulary file is read
from the path in each Python worker (``model`` is a path that executors see, as
a distributed file or part of their image).

Defined cases: null and empty texts have the end id only and decode to the
empty text; repeated rows are encoded alike; an empty table gives an empty
result.  Only the named columns are read.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush
from itertools import chain, repeat
from operator import concat

import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from claimwright.llm.common import map_texts

SPACE = "▁"
#: Words whose ids a worker remembers (twice as many for a moment), and the longest one.
MEMORY_WORDS, MEMORY_CHARS = 300_000, 48
#: Longest word whose agenda is a list.
SHORT = 32
NEVER = float("inf")


class Memory(dict):
    """Ids by word; what is missing is merged.  Recent words outlive full memories.

    ``pairs`` are the adjacent characters of all pieces.  A last character
    that follows its neighbour in no piece (often a comma or full stop) is
    never merged with it, so the rest of the word is looked up by itself.
    """

    def __init__(self, encode, pairs: set[str], last: "Memory | None" = None):
        super().__init__()
        self.encode, self.pairs, self.last, self.old, self.merged = encode, pairs, last, {}, []

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.old.get(word)
        if ids is None:
            if len(word) > 1 and word[-2:] not in self.pairs and len(word) <= MEMORY_CHARS:
                ids = (*self[word[:-1]], *(self if self.last is None else self.last)[word[-1]])
            else:
                ids = self.encode(word)
                self.merged.append((word, ids))
        if len(word) <= MEMORY_CHARS:
            if len(self) >= MEMORY_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class MergeEncoder:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, model: str):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model)
        self.eos = lib.eos_id()
        self.ids: dict[str, int] = {}
        self.cost: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        # Byte pieces from 0x80 on stand as lone surrogates (surrogateescape).
        self.texts: list[str] = []
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                byte = int(piece[3:5], 16)
                self.bytes[byte] = i
                self.texts.append(chr(byte if byte < 128 else 0xDC00 + byte))
            elif lib.is_control(i):
                self.texts.append("")
            else:
                self.texts.append(piece.replace(SPACE, " "))
                if not (lib.is_unknown(i) or lib.is_unused(i)):
                    self.ids[piece] = i
                    if len(piece) > 1:
                        self.cost[piece] = -lib.get_score(i)
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.cost):
            raise ValueError("a piece goes over a space or line feed: words can't be encoded one by one")
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        self.line_feed = self.merge("\n")
        pairs = {piece[i:i + 2] for piece in self.cost for i in range(len(piece) - 1)}
        self.bare = Memory(lambda word: tuple(self.merge(word)), pairs)
        self.spaced = Memory(lambda word: tuple(self.merge(SPACE + word)), pairs, self.bare)

    def merge(self, word: str) -> list[int]:
        """Ids of one word, by the agenda of adjacent pairs."""
        symbols = self._merged_short(word) if len(word) <= SHORT else self._merged(word)
        try:
            return list(map(self.ids.__getitem__, symbols))
        except KeyError:  # characters that are no pieces
            return [i for s in symbols for i in ([self.ids[s]] if s in self.ids else map(self.bytes.__getitem__, s.encode()))]

    def _merged_short(self, word: str) -> list[str]:
        """The agenda as a list, one entry for each pair in place: the first of the best entries is next."""
        get, symbols = self.cost.get, list(word)
        agenda = list(map(get, map(concat, symbols, symbols[1:]), repeat(NEVER)))
        while agenda and (best := min(agenda)) < NEVER:
            i = agenda.index(best)
            del agenda[i]
            symbols[i] += symbols.pop(i + 1)
            if i:
                agenda[i - 1] = get(symbols[i - 1] + symbols[i], NEVER)
            if i < len(agenda):
                agenda[i] = get(symbols[i] + symbols[i + 1], NEVER)
        return symbols

    def _merged(self, word: str) -> list[str]:
        """The agenda as a heap of (cost, place, pair); entries out of date are skipped."""
        cost, n, symbols = self.cost, len(word), list(word)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(cost[pair], i, pair) for i in range(n - 1) if (pair := word[i:i + 2]) in cost]
        heapify(agenda)
        while agenda:
            _, i, pair = heappop(agenda)
            j = right[i]
            # Merged away, or a neighbour has grown.
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, ""
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (longer := pair + symbols[k]) in cost:
                    heappush(agenda, (cost[longer], i, longer))
            h = left[i]
            if h >= 0 and (longer := symbols[h] + pair) in cost:
                heappush(agenda, (cost[longer], h, longer))
        return [s for s in symbols if s]

    def encode(self, text: str) -> list[int]:
        """Ids of a text with the end id."""
        out: list[int] = []
        if text:
            spaced = self.spaced.__getitem__
            for n, line in enumerate(text.replace(SPACE, " ").split("\n")):
                if n:
                    out += self.line_feed
                words = line.split(" ")
                if n:  # the first word of a later line has no space in front
                    first = words.pop(0)
                    if first:
                        out += self.bare[first]
                if "" in words:
                    words = _runs(words)
                out += chain.from_iterable(map(spaced, words))
        out.append(self.eos)
        return out

    def check(self, texts: list[str], ids: list[list[int]], decoded: list[str]) -> None:
        """Compare what a batch has merged and decoded with the library."""
        # The library puts a space in front: words without one follow a line feed.
        start, end = [self.ids[SPACE], *self.line_feed], self.line_feed
        for memory, sides in ((self.spaced, ("", "\n")), (self.bare, ("\n", ""))):
            plain = [sides[0] + w.replace(SPACE, " ") + sides[1] for w, _ in memory.merged]
            for (word, got), want in zip(memory.merged, self.library.encode(plain, num_threads=1) if plain else []):
                if ([*got, *end] if sides[1] else [*start, *got]) != want:
                    raise ValueError(f"ids differ from the library's: {word!r}")
            memory.merged.clear()
        if texts and self.library.encode(texts[0], add_eos=True) != ids[0]:
            raise ValueError(f"ids differ from the library's: {texts[0][:200]!r}")
        if decoded != self.library.decode(ids):
            raise ValueError("decoded texts differ from the library's")

    def decode(self, ids: list[int]) -> str:
        joined = "".join(map(self.texts.__getitem__, ids)).removeprefix(" ")
        try:
            joined.encode()
        except UnicodeEncodeError:  # bytes of characters that are no pieces
            joined = _utf8(joined.encode("utf-8", "surrogateescape"))
        return joined


def _runs(words: list[str]) -> list[str]:
    """Empty words (between spaces) put as spaces in front of the next word."""
    out, run = [], 0
    for w in words:
        if w:
            out.append(SPACE * run + w)
            run = 0
        else:
            run += 1
    if run:
        out.append(SPACE * (run - 1))
    return out


def _utf8(raw: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that is not part of a character."""
    parts = []
    while True:
        try:
            parts.append(raw.decode())
            return "\ufffd".join(parts)
        except UnicodeDecodeError as e:
            parts.append(raw[:e.start].decode())
            raw = raw[e.start + 1:]


_ENCODERS: dict[str, MergeEncoder] = {}


def encoder(model: str) -> MergeEncoder:
    """The worker's encoder of a vocabulary."""
    if model not in _ENCODERS:
        _ENCODERS[model] = MergeEncoder(model)
    return _ENCODERS[model]


def encode_decode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text",
                  check: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``key``, ids (array, with the end id), decoded."""
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]

    def make():
        enc = encoder(model)

        def fn(texts: list[bytes]) -> list[list]:
            plain = [t.decode("utf-8", "replace") for t in texts]
            ids = [enc.encode(t) for t in plain]
            decoded = [enc.decode(i) for i in ids]
            if check:
                enc.check(plain, ids, decoded)
            else:
                enc.spaced.merged.clear(), enc.bare.merged.clear()
            return [ids, decoded]
        return fn

    return map_texts(docs, text, [key], fields, make)
