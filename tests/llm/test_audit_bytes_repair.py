"""Source divergence, byte-level BPE coding and conversation repair against brute force and the library."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import tiktoken
from pyspark.sql import functions as F

from claimwright.llm import byte_bpe, conversation_repair, source_divergence
from claimwright.llm import queries as Q
from edge_rows import EDGE_ROWS, LONG, SF_SMALL, edge, none, prose, prose_rows  # noqa: F401

# --- byte-level BPE -------------------------------------------------------------

VOCABULARY = Q.vocabulary("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(packed):
    return list(memoryview(bytes(packed)).cast("I"))


PIECES = ["a", "b", "é", "'s", "'re", "'", " ", "  ", "\n", "\t", "1", "22", "!", "?!", "日本", " ", " ", "\x1c", "the ", "ing", "\U00010ee7"]


def test_pretoken_merges_equal_library(library):
    coder, rng = byte_bpe.Coder(VOCABULARY), random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 120))) for _ in range(400)]
    for t in [*texts, "a" * 3000, "ab" * 2000, "é" * 700, "!?" * 300, "aaab" * 200]:
        assert ids_of(coder.encode(t.encode())) == library.encode_ordinary(t)
        assert coder.decode(coder.encode(t.encode())) == t.encode()


@pytest.mark.parametrize("size,overlap", [(64, 32), (200, 60), (5000, 700), (1 << 16, 1 << 11)])
def test_chunked_coding_equals_library(spark, library, size, overlap):
    rng = random.Random(size)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 600))) for _ in range(60)]
    texts += [t for _, t in EDGE_ROWS if t is not None and len(t) < 100_000] + ["x" * 700 + " end", "\n" * 900, "it's " * 300, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in byte_bpe.encode_decode(df, VOCABULARY, chunk_bytes=size, overlap=overlap).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert ids_of(got[i]["ids"]) == library.encode_ordinary(t or "") and bytes(got[i]["decoded"]) == (t or "").encode()
        assert got[i]["n_tokens"] == len(got[i]["ids"]) // 4


def test_chunk_spans_cover_and_keep_characters():
    rng = random.Random(9)
    for _ in range(200):
        raw = "".join(rng.choices(["a", "é", "日", "\U0001F600"], k=rng.randint(0, 90))).encode()
        spans = byte_bpe.chunk_spans(raw, 16, 5)
        assert spans[0][0] == 0 and spans[-1][1] == len(raw)
        for (a, b), (c, _) in zip(spans, spans[1:]):
            assert a < c < b and b - c >= 1
        for a, b in spans:
            raw[a:b].decode()


def test_byte_bpe_edge_rows(edge, none, library):
    got = byte_bpe.encode_decode(edge, VOCABULARY, chunk_bytes=4096, overlap=256).collect()
    want = Counter((i, hashlib.sha256(str(library.encode_ordinary(t or "")).encode()).hexdigest()) for i, t in EDGE_ROWS)
    assert Counter((r["doc_id"], hashlib.sha256(str(ids_of(r["ids"])).encode()).hexdigest()) for r in got) == want
    assert byte_bpe.encode_decode(none, VOCABULARY).collect() == []


def test_op12_on_whole_table(spark, library):
    import struct
    got = {r["doc_id"]: r for r in Q.op12_byte_bpe(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


# --- source divergence ----------------------------------------------------------

def brute_divergence(rows, min_docs, top):
    """Contract, by plain dictionaries; rows are (text, lang, source)."""
    per, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower)
        groups.add((lang, source))
        per[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = sorted(s for g, s in groups if g == lang)
        whole = Counter()
        for s in sources:
            whole.update(per[lang, s])

        def prices(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: prices(per[lang, s]) for s in sources}, prices(whole)
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if per[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k) for k, (v, i) in enumerate(items[:limit], 1)]
    return sorted(out)


def audited(docs, **kw):
    return sorted(tuple(r) for r in source_divergence.audit(docs, **kw).collect())


def test_divergence_equals_brute_force(spark):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdé", k=rng.randint(1, 4))) for _ in range(150)] + ["X", "ß", "日本"]
    rows = [(" ".join(rng.choices(words, weights=range(1, len(words) + 1), k=rng.randint(0, 60))) if rng.random() < .95 else None,
             rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", None])) for _ in range(300)]
    rows += [("lonely words", "xx", "only"), ("", "yy", "a"), (None, "yy", "b")] + [("same text again", "en", "s1")] * 30
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    assert audited(df, min_docs=3, top=4) == brute_divergence(rows, 3, 4)


def test_divergence_by_panels(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(" ".join(rng.choices("abcdefgh", k=12)), "en", f"s{rng.randint(0, 12)}") for _ in range(200)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    import numpy as np
    a, b = np.array([[0, 3], [1, 3], [2, 0], [5, 0]]), np.array([[7], [0], [0], [1]])
    price = lambda k, levels: [10 * (k + 1) + c for c in levels.tolist()]
    direct = [[sum((10 * (i + 1) + x - 10 * (j + 1) - y) ** 2 // (10 * (i + 1) + x + 10 * (j + 1) + y)
                   for x, y in zip(a[:, i], b[:, j])) for j in range(1)] for i in range(2)]
    for few, many in ((32, 1024), (1, 2)):
        monkeypatch.setattr(source_divergence, "FEWEST_TERMS", few)
        monkeypatch.setattr(source_divergence, "MANY_COLUMNS", many)
        assert source_divergence.joint_divergence(a, b, price, price).tolist() == direct
    assert audited(df, min_docs=1, top=3) == brute_divergence(rows, 1, 3)


def test_divergence_prices_are_exact(spark):
    big = spark.createDataFrame([(9_007_199_254_740_993, 9_007_199_254_740_995, 3)], "n long, total long, kept long")
    got = big.select(source_divergence.price(F.col("n"), F.col("total"), F.col("kept")).alias("p")).first()["p"]
    assert got == 1 + 1_000_000_000 * (9_007_199_254_740_993 + 2) // (9_007_199_254_740_995 + 6)


def test_divergence_edge_rows(edge, none):
    rows = [(t, "?", "s") for _, t in EDGE_ROWS]
    df = edge.withColumn("source", F.lit("s"))
    assert audited(df, min_docs=2) == brute_divergence(rows, 2, 10)
    assert audited(none.withColumn("source", F.lit("s"))) == []


# --- conversation repair --------------------------------------------------------

WHITE = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute_repair(turns):
    """Contract for one conversation's rows (turn, role, text): all audits by a table of whole strings."""
    turns = sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in turns:
        inner = text.strip(WHITE)
        faults.append("blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else "")
        seen.add((role, text))
    known = [t for t, _, _ in turns if t is not None]
    initials = [r[:1] for _, r, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    # (state) -> (cost, audit, repaired lines)
    best = {"": (0, "", ())}

    def better(table, state, item):
        if state not in table or item[:2] < table[state][:2]:
            table[state] = item

    def inserted(table):
        for _ in range(3):
            for s, (c, a, l) in list(table.items()):
                for r, name in (("u", "user"), ("a", "assistant")):
                    if (s, r) in moves:
                        better(table, r, (c + 2, a + "I", (*l, f"{name}:")))
        return table

    best = inserted(best)
    for (_, role, text), fault in zip(turns, faults):
        then, cut = {}, fault == "truncated"
        for s, (c, a, l) in best.items():
            better(then, s, (c + 3, a + "D", l))
            if fault in ("blank", "duplicate"):
                continue
            if (s, role[:1]) in moves:
                better(then, role[:1], (c + cut, a + "K", (*l, f"{role}:{text}")))
            for r, name in (("u", "user"), ("a", "assistant")):
                if (s, r) in moves:
                    better(then, r, (c + 2 + cut, a + "R", (*l, f"{name}:{text}")))
        best = inserted(then)
    cost, audit, lines = min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])
    return {"gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": illegal, "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


NOTHING = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}


def brute_op13(rows):
    per = defaultdict(list)
    for conv, *rest in brute_damage(rows):
        per[conv].append(tuple(rest))
    return {c: brute_repair(per[c]) if per[c] else NOTHING for c in {r[0] for r in rows}}


def same_audits(got, want):
    got = {r["conv_id"]: {k: r[k] for k in NOTHING} for r in got}
    assert got.keys() == want.keys()
    for c in want:
        assert got[c] == want[c], c


def made_up_rows(seed, convs, longest):
    rng = random.Random(seed)
    said = ["Hello there.", "What is it?", "no end", "", None, "  \n", "Yes!", "Yes!", "two. parts", "x.\t "]
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", "", "users"]
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, longest)):
            turn = None if rng.random() < .05 else t + rng.randint(0, 1)
            rows.append((None if c == 3 else c, turn, rng.choice(roles), rng.choice(said)))
    return rows


@pytest.mark.parametrize("bits", [12, 2, 0])
def test_repair_equals_brute_force(spark, bits):
    rows = made_up_rows(bits, 60, 30)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("code", F.lit(1))
    same_audits(Q.repair_report(df.withColumn("a.b", F.lit(2)).repartition(5), block_bits=bits).collect(), brute_op13(rows))


def test_one_conversation_with_most_rows(spark):
    rng = random.Random(5)
    rows = [(7, t // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c!", "", "d?", f"e{t}."])) for t in range(3000)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"fine {t}.") for c in range(100, 130) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    same_audits(Q.repair_report(df, block_bits=6).collect(), brute_op13(rows))


def test_op13_on_whole_table(spark):
    d = SF_SMALL.replace("0.001", "0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same_audits(Q.op13_conversation_repair(spark, d).collect(), brute_op13(rows))


def test_repair_of_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    fixed = conversation_repair.repair(empty)
    assert fixed.audits.collect() == [] and conversation_repair.digests(fixed.turns).collect() == []


def test_repaired_turns_are_well_formed(spark):
    rows = made_up_rows(77, 40, 12)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    per = defaultdict(list)
    for r in conversation_repair.repair(df).turns.collect():
        per[r["conv_id"]].append((r["position"], r["role"]))
    for turns in per.values():
        assert [p for p, _ in sorted(turns)] == list(range(len(turns)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, r in sorted(turns)))


def test_trails_order_strings():
    rng = random.Random(2)
    for collide in (False, True):
        trails = conversation_repair.Trails()
        if collide:
            trails.MOD = 7  # nearly all hashes collide: only the verification tells strings apart
        nodes = [0]
        for _ in range(400):
            nodes.append(trails.add(rng.choice(nodes[-12:]), rng.choice("DIKR")))
        # equal strings as different nodes
        for n in nodes[:40]:
            again = 0
            for c in trails.text(n):
                again = trails.add(again, c)
            nodes.append(again)
        for x, y in itertools.islice(itertools.product(rng.sample(nodes, 60), repeat=2), 3600):
            assert trails.less(x, y) == (trails.text(x) < trails.text(y))


def test_block_audits_equal_enumeration():
    """Every sequence of edits of up to three rows, by hand."""
    for codes in ("", "u", "ua", "sua", "aU", "2u", "x", "su", "uau", "s3a", "AUx"):
        for entry in range(4):
            found = {}

            def walk(i, state, cost, audit):
                if cost > 12:
                    return
                if i == len(codes):
                    found[state] = min(found.get(state, (99, "")), (cost, audit))
                for to in (2, 3):
                    if (to == 2) != (state == 2) and audit[-3:] != "III":
                        walk(i, to, cost + 2, audit + "I")
                if i < len(codes):
                    walk(i + 1, state, cost + 3, audit + "D")
                    if codes[i] not in "1234":
                        cut = codes[i].isupper()
                        to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(codes[i].lower(), {}).get(state)
                        if to is not None:
                            walk(i + 1, to, cost + cut, audit + "K")
                        walk(i + 1, 3 if state == 2 else 2, cost + 2 + cut, audit + "R")

            walk(0, entry, 0, "")
            assert {s: x for s, x in enumerate(conversation_repair.best_audits(codes, entry)) if x} == found
