"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into chunks that overlap a little.  Chunks are pre-tokenised
independently, each from its own first character, so the first pre-tokens of a
chunk may be cut wrongly.  Two neighbours are stitched at the first place of
their overlap where both have a pre-token boundary: what follows such a place
depends only on the text after it, so from there on the right chunk's
pre-tokens are the whole text's.  (The pattern looks ahead but never back.  A
boundary close to a chunk's end may depend on what comes after it, so the left
chunk's last :data:`MARGIN` bytes do not count.)  Then each chunk encodes the
pre-tokens between its two seams, and the ids are joined in order.  Decoding
joins the raw bytes of the ids.

A pre-token that is a vocabulary entry is one id; otherwise the neighbouring
symbols whose joined bytes have the least rank are merged, leftmost first,
until no pair has a rank.

How it runs: texts of one chunk are encoded in place, without a shuffle.
Longer ones are cut into chunk rows that are dealt out over the cluster, so a
very long text does not keep one task busy; seams come from a window over
boundary lists of the overlaps (narrow rows), and only a text's ids and decoded
bytes meet again, in the one row that they are.  A text in which some overlap
has no common boundary (one run of letters over ``overlap`` bytes, say) is
encoded by one task as a whole.  The vocabulary is read from its path in each
Python worker; it must be installed on every executor.

Defined cases: null and empty texts have no ids and decode to nothing; rows
that repeat, share an id or have none are coded row by row; an empty table
gives an empty result; bytes that are not UTF-8 are read as U+FFFD.  Only the
named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.common import map_texts, prepare, quoted, stored
from claimwright.llm.token_counts import MAYBE_NEWER, PATTERN, older_pattern

#: Texts over this many bytes are cut; neighbours share ``OVERLAP_BYTES``.
CHUNK_BYTES, OVERLAP_BYTES = 1 << 16, 1 << 11
#: A boundary this close to a chunk's end may change with what follows: three characters of four bytes.
MARGIN = 12
#: Pre-tokens whose ids a worker remembers, and the longest remembered one.
MEMORY_TOKENS, MEMORY_CHARS = 300_000, 48
#: From this length on a pre-token's pairs are kept in a heap.
HEAP_BYTES = 96


class Coder(dict):
    """Packed ids (little-endian, 32 bits) by pre-token; unknown pre-tokens are merged and remembered."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError(f"{path} does not have all single bytes")
        self.raw = [b""] * (1 + max(self.ranks.values()))
        for token, rank in self.ranks.items():
            self.raw[rank] = token
        self.cut = regex.compile(PATTERN).findall
        self.cut_older = regex.compile(older_pattern(), regex.V1).findall

    def pretokens(self, raw: bytes) -> list[str]:
        return (self.cut_older if MAYBE_NEWER(raw) else self.cut)(raw.decode("utf-8", "replace"))

    def __missing__(self, pretoken: str) -> bytes:
        ids = self.merge(pretoken.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(pretoken) <= MEMORY_CHARS:
            self[pretoken] = packed
        return packed

    def merge(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self._merge_heap(piece) if len(piece) >= HEAP_BYTES else self._merge_short(piece)

    def _merge_short(self, piece: bytes) -> list[int]:
        rank = self.ranks.get
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [rank(a + b) for a, b in zip(parts, parts[1:])]
        while (known := [r for r in pairs if r is not None]):
            i = pairs.index(min(known))
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1])
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i])
        return [self.ranks[p] for p in parts]

    def _merge_heap(self, piece: bytes) -> list[int]:
        """Like :meth:`_merge_short`; symbols are linked spans, outdated heap entries are skipped."""
        n, rank = len(piece), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n))  # of the symbol that starts at a place
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        dead = bytearray(n + 1)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if dead[i] or end[i] >= n or end[end[i]] != stop:
                continue  # one of the two symbols has grown or gone
            dead[end[i]] = 1
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := rank(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if i and (r := rank(piece[before[i]:stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def encode(self, raw: bytes) -> bytes:
        return b"".join(map(self.__getitem__, self.pretokens(raw)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.raw.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))

    def trim(self) -> None:
        if len(self) > MEMORY_TOKENS:
            self.clear()


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The worker's tables of a vocabulary."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def chunk_spans(raw: bytes, size: int, overlap: int) -> list[tuple[int, int]]:
    """Spans of about ``size`` bytes, each with ``overlap`` bytes of the next; none splits a character.

    A rest of ``overlap`` bytes or less stays with the span before it.
    """
    def whole(at: int) -> int:
        while at < len(raw) and raw[at] & 0xC0 == 0x80:
            at += 1
        return min(at, len(raw))

    starts = sorted({whole(at) for at in range(0, max(1, len(raw) - overlap), size)} - {len(raw)} | {0})
    return [(a, len(raw) if b is None else whole(b + overlap)) for a, b in zip(starts, [*starts[1:], None])]


def boundaries(pretokens: list[str]) -> np.ndarray:
    """Byte places where pre-tokens begin, and the last one's end."""
    return np.cumsum([0, *[len(t.encode()) for t in pretokens]])


def encode_decode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
                  chunk_bytes: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``key``, n_tokens, ids (packed, little-endian 32 bits), decoded (bytes)."""
    if not 0 < overlap < chunk_bytes:
        raise ValueError("chunks must be longer than their overlap")
    rows = docs.select(quoted(key).alias("key"), quoted(text).alias("body"))
    length = F.coalesce(F.octet_length("body"), F.lit(0))
    short = _encode_short(rows.filter(length <= chunk_bytes), vocabulary)
    coded = short.unionByName(_encode_long(rows.filter(length > chunk_bytes), vocabulary, chunk_bytes, overlap))
    return coded.select(F.col("key").alias(key), F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids", "decoded")


_CODED = [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())]


def _encode_short(rows: DataFrame, vocabulary: str) -> DataFrame:
    def make() -> Callable[[list[bytes]], list[list]]:
        tables = coder(vocabulary)

        def fn(texts: list[bytes]) -> list[list]:
            ids = [tables.encode(raw) for raw in texts]
            tables.trim()
            return [ids, [tables.decode(x) for x in ids]]
        return fn

    return map_texts(rows, "body", ["key"], _CODED, make)


def _encode_long(rows: DataFrame, vocabulary: str, size: int, overlap: int) -> DataFrame:
    prepare(rows.sparkSession)
    key_type = rows.schema["key"].dataType.simpleString()
    chunks = rows.mapInArrow(_cutter(size, overlap), f"key {key_type}, row long, chunk int, last boolean, start long, body binary")
    # Each chunk to any task: nothing of a text meets here.
    chunks = chunks.repartition("row", "chunk").mapInArrow(
        _pretokeniser(vocabulary, overlap),
        f"key {key_type}, row long, chunk int, start long, body binary, bounds binary, head array<long>, tail array<long>, last boolean")
    chunks = stored(chunks, "bpe-chunks")

    in_text = Window.partitionBy("row").orderBy("chunk")
    seam = F.when(F.col("last"), F.lit(-1)).otherwise(F.array_min(F.array_intersect("tail", F.lead("head").over(in_text))))
    seams = (chunks.select("row", "chunk", "head", "tail", "last").withColumn("until", seam)
             .select(F.col("row").alias("seam_row"), F.col("chunk").alias("seam_chunk"), "until",
                     F.coalesce(F.lag("until").over(in_text), F.lit(0)).alias("since"),
                     F.max(F.col("until").isNull()).over(Window.partitionBy("row")).alias("broken")))
    pieces = chunks.join(seams, (chunks["row"] == seams["seam_row"]) & (chunks["chunk"] == seams["seam_chunk"]))
    coded = pieces.select("key", "row", "chunk", "start", "since", "until", "broken", "body", "bounds").mapInArrow(
        _encoder(vocabulary), f"key {key_type}, row long, chunk int, start long, broken boolean, ids binary, decoded binary")
    # A group is one text, that is one row of the result.
    return coded.groupBy("row").applyInArrow(_gatherer(vocabulary), f"key {key_type}, ids binary, decoded binary")


def _cutter(size: int, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for i, body in enumerate(batch.column(1).cast(pa.large_binary())):
                raw = body.as_py()
                spans = chunk_spans(raw, size, overlap)
                last = len(spans) - 1
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([batch.column(0).slice(i, 1)] * len(spans)),
                    pa.array([row] * len(spans), pa.int64()), pa.array(range(len(spans)), pa.int32()),
                    pa.array([k == last for k in range(len(spans))]), pa.array([a for a, _ in spans], pa.int64()),
                    pa.array([raw[a:b] for a, b in spans], pa.binary())], names=["key", "row", "chunk", "last", "start", "body"])
                row += 1
    return run


def _pretokeniser(vocabulary: str, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = coder(vocabulary)
        for batch in batches:
            bounds, heads, tails = [], [], []
            for start, last, body in zip(batch.column("start").to_pylist(), batch.column("last").to_pylist(), batch.column("body")):
                raw = body.as_py()
                at = boundaries(tables.pretokens(raw))
                bounds.append(at.astype("<i8").tobytes())
                heads.append((start + at[at < overlap]).tolist())
                # Only what lies in the next chunk too can be a seam; its first byte is at least len - overlap - 4.
                tails.append([] if last else (start + at[(at >= len(raw) - overlap - 4) & (at <= len(raw) - MARGIN)]).tolist())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("key", "row", "chunk", "start", "body")], pa.array(bounds, pa.binary()),
                 pa.array(heads, longs), pa.array(tails, longs), batch.column("last")],
                names=["key", "row", "chunk", "start", "body", "bounds", "head", "tail", "last"])
    return run


def _encoder(vocabulary: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = coder(vocabulary)
        for batch in batches:
            ids, decoded = [], []
            for start, since, until, broken, body, bounds in zip(*[
                    batch.column(c).to_pylist() for c in ("start", "since", "until", "broken", "body", "bounds")]):
                if broken:  # encoded as a whole when its chunks are together
                    ids.append(None)
                    decoded.append(body)
                    continue
                at = np.frombuffer(bounds, dtype="<i8")
                at = at[(at >= since - start) & (at <= (len(body) if until < 0 else until - start))].tolist()
                ids.append(b"".join([tables[body[a:b].decode("utf-8", "replace")] for a, b in zip(at, at[1:])]))
                decoded.append(tables.decode(ids[-1]))
            tables.trim()
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("key", "row", "chunk", "start", "broken")], pa.array(ids, pa.binary()),
                 pa.array(decoded, pa.binary())], names=["key", "row", "chunk", "start", "broken", "ids", "decoded"])
    return run


def _gatherer(vocabulary: str) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        parts = table.column("decoded").to_pylist()
        if table.column("broken")[0].as_py():
            starts = [*table.column("start").to_pylist(), None]
            raw = b"".join(p if b is None else p[:b - a] for p, a, b in zip(parts, starts, starts[1:]))
            tables = coder(vocabulary)
            ids = tables.encode(raw)
            decoded = tables.decode(ids)
        else:
            ids, decoded = b"".join(table.column("ids").to_pylist()), b"".join(parts)
        return pa.table([table.column("key").slice(0, 1), pa.array([ids], pa.binary()), pa.array([decoded], pa.binary())],
                        names=["key", "ids", "decoded"])
    return run
