"""Conversation structure repair: the cheapest edits that give a well-formed chat.

Each row of a conversation is kept, reroled or deleted, and empty turns may be
inserted anywhere, so that the roles read ``(s?(ua)+)?``: an optional system
turn, then user and assistant in turn.  The *audit* is the string of edits
(K, R, D, I); of the cheapest ones the ASCII-least.  A row's first fault counts:
blank, duplicate (role and text seen earlier) or truncated; blank and duplicate
rows must go, a truncated row that stays costs 1.

Persistent audit DP.  Four states stand for the roles written so far (nothing,
s, u, a).  Each state's best audit is a node of a linked list that shares its
prefix with others (:class:`Trails`): a node knows its parent, its depth, a
rolling hash of its string and its ancestors 1, 2, 4 ... steps up.  Equal costs
are decided by the first difference of two audits, found by lifting both nodes
over ever shorter steps while the hashes differ; equal hashes are verified
character by character down to a shared node.  (Of two audits of one state at
one row, neither continues the other: the further edits would be insertions,
which cost.  So a prefix's best audit is part of the whole's.)

How it runs: rows are sorted by a range shuffle on (conversation, turn, role,
text) and numbered, so a conversation with a third of all rows lies in many
partitions.  The DP works on blocks of at most 2 ** :data:`BLOCK_BITS` rows of one
conversation, each a short string of codes: a block gives the best audit from
each state to each state, all blocks at the same time.  Conversations are folded
over their blocks, which gives each block its part of the audit.  Applying the
edits streams the rows of a conversation in order; no conversation is held in
memory, other than its audit, which is one value of the result.  (The digest of
a conversation's repaired text is sequential, so one task reads that text.)

Defined cases: null role and text are one space, so the role is unknown and the
row blank; null turns come first; rows with equal turn are ordered by role, then
text; repeated rows are duplicates of the first; rows without a conversation id
are one conversation; an unknown role is no s, u or a by its first letter, and
can be kept in no place; an empty table gives an empty result.  Only the named
columns are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.llm.common import prepare, quoted, stored

#: What edits cost, and what a truncated row costs that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Fixed value: white space.
BLANKS = " \t\n\x0b\x0c\r"
#: A block has 2 ** BLOCK_BITS rows at most.
BLOCK_BITS = 12
#: Rows of text that leave a worker together.
OUT_ROWS = 500

#: States: nothing written, then the last role written.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
#: The state that a role leads to, by state.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Codes of rows: by initial (x: any other), plain, truncated and to be deleted.
PLAIN, CUT, GONE = "suax", "SUAX", "1234"
_LEGAL = {"su", "ua", "au"}


class Trails:
    """Strings as linked nodes that share prefixes; node 0 is the empty string."""

    BASE, MOD = 1_000_003, (1 << 61) - 1

    def __init__(self) -> None:
        self.parent, self.char, self.depth, self.hash = [0], [""], [0], [0]
        self.up: list[list[int]] = [[]]  # ancestors 1, 2, 4 ... steps up
        self.verified: set[tuple[int, int]] = set()

    def add(self, node: int, char: str) -> int:
        up, at = [node], 0
        while at < len(self.up[up[at]]):
            up.append(self.up[up[at]][at])
            at += 1
        self.parent.append(node)
        self.char.append(char)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.BASE + ord(char)) % self.MOD)
        self.up.append(up)
        return len(self.parent) - 1

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.char[node])
            node = self.parent[node]
        return "".join(reversed(out))

    def lift(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            step = (self.depth[node] - depth).bit_length() - 1
            node = self.up[node][step]
        return node

    def same(self, x: int, y: int) -> bool:
        """Whether two nodes of one depth are the same string: equal hashes, then equal characters."""
        if x == y:
            return True
        if self.hash[x] != self.hash[y]:
            return False
        a, b = x, y
        while a != b and (a, b) not in self.verified:
            if self.char[a] != self.char[b]:
                return False  # a collision
            a, b = self.parent[a], self.parent[b]
        self.verified |= {(x, y), (y, x)}
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether ``x`` comes before ``y`` in ASCII order (a prefix comes first)."""
        depth = min(self.depth[x], self.depth[y])
        a, b = self.lift(x, depth), self.lift(y, depth)
        if self.same(a, b):
            return self.depth[x] < self.depth[y]
        # The first difference: the highest ancestors that differ.
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and not self.same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.char[a] < self.char[b]


def best_audits(codes: str, entry: int) -> list[tuple[int, str] | None]:
    """(cost, audit) of the best edits of a block's rows that lead from state ``entry`` to each state."""
    trails = Trails()
    now: list[tuple[int, int] | None] = [None] * 4
    now[entry] = (0, 0)

    def offer(at: list[tuple[int, int] | None], state: int, cost: int, node: int, char: str) -> None:
        held = at[state]
        if held is None or cost < held[0]:
            at[state] = (cost, trails.add(node, char))
        elif cost == held[0]:
            new = trails.add(node, char)
            if trails.less(new, held[1]):
                at[state] = (cost, new)

    def insert(at: list[tuple[int, int] | None]) -> None:
        # A second insertion can only follow one into USER; a third would be undone by none.
        for state in (START, SYSTEM, ASSISTANT):
            if at[state] is not None:
                offer(at, USER, at[state][0] + INSERT, at[state][1], "I")
        if at[USER] is not None:
            offer(at, ASSISTANT, at[USER][0] + INSERT, at[USER][1], "I")

    insert(now)
    for code in codes:
        then: list[tuple[int, int] | None] = [None] * 4
        stays = code not in GONE
        extra = TRUNCATED if code in CUT else 0
        keep = AFTER.get(code.lower(), {})
        for state, held in enumerate(now):
            if held is None:
                continue
            cost, node = held
            offer(then, state, cost + DELETE, node, "D")
            if stays:
                if state in keep:
                    offer(then, keep[state], cost + KEEP + extra, node, "K")
                offer(then, ASSISTANT if state == USER else USER, cost + REROLE + extra, node, "R")
        insert(then)
        now = then
    return [None if held is None else (held[0], trails.text(held[1])) for held in now]


@dataclass(frozen=True)
class Path:
    """Best audits of a conversation's first blocks, as parts linked backwards."""
    cost: int
    before: Path | None
    part: str
    entry: int

    def parts(self) -> list[Path]:
        out: list[Path] = []
        at: Path | None = self
        while at is not None:
            out.append(at)
            at = at.before
        return out[::-1]


def _earlier(x: Path, y: Path) -> bool:
    """Whether ``x`` is better than ``y`` (both of as many blocks): cheaper, or the lesser string."""
    if x.cost != y.cost:
        return x.cost < y.cost
    a, b, texts = x, y, ([], [])
    while a is not b and a is not None:
        texts[0].append(a.part)
        texts[1].append(b.part)
        a, b = a.before, b.before
    return "".join(reversed(texts[0])) < "".join(reversed(texts[1]))


def _better(paths: list[Path]) -> Path | None:
    best = None
    for p in paths:
        if best is None or _earlier(p, best):
            best = p
    return best


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults, decided by crc32 of ``conv:turn`` modulo 20 (nulls are one space)."""
    said = F.coalesce(quoted(text), F.lit(" "))
    name = F.concat(F.coalesce(quoted(conv).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(quoted(turn).cast("string"), F.lit(" ")))
    kind = F.crc32(F.encode(name, "UTF-8")) % 20
    rows = rows.select(quoted(conv).alias("conv"), quoted(turn).alias("turn"), F.coalesce(quoted(role), F.lit(" ")).alias("role"),
                       said.alias("text"), kind.alias("kind")).filter("kind != 0")
    text_ = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array_repeat(F.lit(1), 2)).otherwise(F.array(F.lit(1)))
    return rows.select(F.col("conv").alias(conv), F.col("turn").alias(turn),
                       F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias(role), text_.alias(text),
                       F.explode(copies).alias("__copy")).drop("__copy")


@dataclass(frozen=True)
class Repair:
    """``audits``: one row per conversation; ``turns``: the repaired rows (conv, position, role, text), by conversation and in order within a partition."""
    audits: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           block_bits: int = BLOCK_BITS) -> Repair:
    """Repaired conversations, and for each gaps, blank, duplicate, truncated, illegal, cost and audit."""
    prepare(rows.sparkSession)
    rows = rows.select(quoted(conv).alias("conv"), quoted(turn).alias("turn"), F.coalesce(quoted(role), F.lit(" ")).alias("role"),
                       F.coalesce(quoted(text), F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("seen"))
    conv_type = rows.schema["conv"].dataType.simpleString()
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "seen"]
    rows = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                  .select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("n")), "repair-rows")

    trimmed = F.rtrim("text", F.lit(BLANKS))
    narrow = rows.select("conv", "turn", "n", "role", F.sha2("text", 256).alias("digest"), (trimmed == "").alias("is_blank"),
                         F.right(trimmed, F.lit(1)).isin(".", "!", "?").alias("is_ended"))
    again = stored(narrow.filter("NOT is_blank").groupBy("conv", "role", "digest").agg(F.min("n").alias("first"), F.count("n").alias("times"))
                   .filter("times > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"),
                   "repair-repeated")
    same = narrow["conv"].eqNullSafe(again["c"]) & (narrow["role"] == again["r"]) & (narrow["digest"] == again["d"])
    fault = (F.when(F.col("is_blank"), "blank").when(F.col("n") > F.col("first"), "duplicate")
             .when(~F.col("is_ended"), "truncated").otherwise(""))
    initial = F.substring("role", 1, 1)
    place = F.when(initial.isin("s", "u", "a"), F.instr(F.lit(PLAIN), initial)).otherwise(F.lit(4))
    codes = (F.when(F.col("fault").isin("blank", "duplicate"), F.lit(GONE)).when(F.col("fault") == "truncated", F.lit(CUT))
             .otherwise(F.lit(PLAIN)))
    judged = narrow.join(again, same, "left").withColumn("fault", fault).withColumn("code", F.substring(codes, place, F.lit(1)))
    judged = stored(judged.select("conv", "turn", "n", "fault", "code"), "repair-judged")

    counts = judged.groupBy(F.col("conv").alias("conv_c")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])

    # Numbers of a conversation's rows follow one another within a block.
    blocks = judged.groupBy("conv", F.shiftright("n", block_bits).alias("block")).agg(
        F.min("n").alias("n"), F.array_sort(F.collect_list(F.struct("n", "code"))).alias("rows"))
    blocks = blocks.select("conv", "n", F.array_join(F.col("rows.code"), "").alias("codes"))
    solved = blocks.mapInArrow(_solver(1 << block_bits), f"conv {conv_type}, n long, codes string, costs array<int>, audits array<string>")
    parts = (solved.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "n")
             .mapInArrow(_fold, f"conv {conv_type}, n long, entry int, part string, cost long, illegal long, audit string"))
    parts = stored(parts, "repair-parts")

    whole = parts.filter("audit IS NOT NULL").select("conv", "cost", "illegal", "audit")
    audits = counts.join(whole, counts["conv_c"].eqNullSafe(whole["conv"])).select(
        F.col("conv_c").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    edits = parts.filter("audit IS NULL").select("conv", "n", F.lit(0).alias("kind"), F.col("entry").cast("string").alias("role"),
                                                 F.col("part").alias("text"))
    both = edits.unionByName(rows.select("conv", "n", F.lit(1).alias("kind"), "role", "text"))
    turns = (both.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "n", "kind")
             .mapInArrow(_apply, f"conv {conv_type}, position long, role string, text string"))
    return Repair(audits, turns.withColumnRenamed("conv", conv))


def digests(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``conv`` and repaired_sha256 (of ``role:text``, joined by newlines) of the conversations that have turns."""
    kind = turns.schema[conv].dataType.simpleString()
    return turns.select(conv, "role", "text").mapInArrow(_digest, f"`{conv}` {kind}, repaired_sha256 string")


def _solver(block_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """16 costs (-1: none) and audits of each block, by entry and exit state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs, audits = [], []
            for n, codes in zip(batch.column("n").to_pylist(), batch.column("codes").to_pylist()):
                # A block that does not begin at a block's place is the conversation's first.
                entries = (START,) if n % block_rows else range(4)
                found = [best_audits(codes, e) if e in entries else [None] * 4 for e in range(4)]
                costs.append([-1 if x is None else x[0] for row in found for x in row])
                audits.append([None if x is None else x[1] for row in found for x in row])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("conv", "n", "codes")], pa.array(costs, pa.list_(pa.int32())),
                 pa.array(audits, pa.list_(pa.string()))], names=["conv", "n", "codes", "costs", "audits"])
    return run


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's part of its conversation's audit, then one row with the whole."""
    conv, starts, best, illegal, last = None, [], [], 0, ""
    kind = None

    def finish() -> Iterator[pa.RecordBatch]:
        chosen = _better([best[s] for s in FINAL if best[s] is not None])
        parts = chosen.parts()
        size = len(parts)
        yield pa.RecordBatch.from_arrays([
            pa.array([conv] * (size + 1), kind), pa.array([*starts, None], pa.int64()),
            pa.array([*[p.entry for p in parts], None], pa.int32()), pa.array([*[p.part for p in parts], None], pa.string()),
            pa.array([None] * size + [chosen.cost], pa.int64()), pa.array([None] * size + [illegal], pa.int64()),
            pa.array([None] * size + ["".join(p.part for p in parts)], pa.string())],
            names=["conv", "n", "entry", "part", "cost", "illegal", "audit"])

    for batch in batches:
        kind = batch.column("conv").type
        for c, n, codes, costs, audits in zip(*[batch.column(x).to_pylist() for x in ("conv", "n", "codes", "costs", "audits")]):
            if not starts or c != conv:
                if starts:
                    yield from finish()
                conv, starts, illegal, last = c, [], 0, ""
                best = [None] * 4
                begin = True
            else:
                begin = False
                if costs[4 * SYSTEM + SYSTEM] < 0:
                    raise ValueError("a later block was solved as a first one")
            initials = last + "".join(PLAIN[(PLAIN + CUT + GONE).index(x) % 4] for x in codes)
            illegal += sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
            last = initials[-1]
            starts.append(n)
            then = []
            for out in range(4):
                paths = [Path((0 if begin else best[e].cost) + costs[4 * e + out], None if begin else best[e], audits[4 * e + out], e)
                         for e in ((START,) if begin else range(4)) if (begin or best[e] is not None) and costs[4 * e + out] >= 0]
                then.append(_better(paths))
            best = then
    if starts:
        yield from finish()


def edited(entry: int, part: str, rows: Callable[[], tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of a block's turns after its edits; ``rows()`` gives the next row."""
    state = entry
    for edit in part:
        role, text = ("", "") if edit == "I" else rows()
        if edit == "D":
            continue
        if edit == "K":
            state = AFTER[role[0]][state]
        else:
            state = ASSISTANT if state == USER else USER
            role = ROLE[state]
        yield role, text


def _stream(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, OUT_ROWS):
            piece = batch.slice(at, OUT_ROWS)
            yield from zip(*[piece.column(c).to_pylist() for c in names])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's edits come before its rows; turns leave in order."""
    peek = next(batches, None)
    if peek is None:
        return
    kind = peek.column("conv").type

    def chained() -> Iterator[pa.RecordBatch]:
        yield peek
        yield from batches

    out: list[tuple] = []
    stream = _stream(chained(), ("conv", "kind", "role", "text"))

    def flush() -> pa.RecordBatch:
        convs, positions, roles, texts = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(positions, pa.int64()), pa.array(roles, pa.string()),
                                           pa.array(texts, pa.string())], names=["conv", "position", "role", "text"])

    held, position = object(), 0
    for conv, _, entry, part in stream:
        if conv != held:
            held, position = conv, 0
        for role, text in edited(int(entry), part, lambda: next(stream)[2:]):
            out.append((conv, position, role, text))
            position += 1
            if len(out) >= OUT_ROWS:
                yield flush()
    if out:
        yield flush()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, sha, kind, out = None, None, None, []

    def flush() -> pa.RecordBatch:
        convs, shas = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(shas, pa.string())], names=[name, "repaired_sha256"])

    for batch in batches:
        kind, name = batch.column(0).type, batch.schema.names[0]
        for conv, role, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            if sha is None or conv != held:
                if sha is not None:
                    out.append((held, sha.hexdigest()))
                held, sha = conv, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        if len(out) >= OUT_ROWS:
            yield flush()
    if sha is not None:
        out.append((held, sha.hexdigest()))
        yield flush()
