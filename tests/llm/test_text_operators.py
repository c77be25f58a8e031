from __future__ import annotations

import hashlib
import pathlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import xxhash
from edge_rows import SF_SMALL, edge, none, prose, prose_rows  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimwright.llm import decontaminate as D
from claimwright.llm import exact_dedup as E
from claimwright.llm import sentencepiece_bpe as S
from claimwright.llm import sharding as H
from claimwright.llm import simhash as M
from claimwright.llm import substring_dedup as P
from claimwright.llm import token_counts as C
from claimwright.llm.components import components

MODEL, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- 1: decontamination ------------------------------------------------------

def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def hits(text, items, window):
    own, covered, found = item_words(text), set(), set()
    for item, body in items:
        w = item_words(body)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            part = w[i:i + window]
            for at in range(len(own) - len(part) + 1):
                if own[at:at + len(part)] == part:
                    covered |= set(range(at, at + len(part)))
                    found.add(str(item))
    return len(own), len(covered), sorted(found)


ITEMS = [(1, "alpha beta gamma delta"), (2, "one"), (30, "tail"), (4, None), (5, ""), (None, "alpha"), (30, "tail"),
         (7, "éà Ñ"), (8, " ".join(f"w{i}" for i in range(100, 130))), (9, "x, X; x! x"), (10, "a")]


def compare_hits(rows, items, texts, window):
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows), key=repr)
    items = [i for i in items if i[0] is not None]
    want = []
    for i, t in texts:
        n, hit, found = hits(t, items, window)
        want.append((i, n, hit, found, hit > 0 and 20 * hit >= n))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 40])
def test_decontaminate_edge_rows(spark, edge, block_bytes):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    short = edge.filter("length(text) < 10000 or text is null")
    rows = D.decontaminate(short, benchmark, block_bytes=block_bytes).collect()
    compare_hits(rows, ITEMS, pairs(short), 13)


def test_decontaminate_long_text(spark, edge):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    by_id = {r.doc_id: r for r in D.decontaminate(edge.filter("doc_id in (7, 13)"), benchmark).collect()}
    assert by_id[7].n_words == 60_000 and by_id[7]["items"] == ["8"] and by_id[7].n_hit == 30 * 60 + 0 + (60_000 % 997 > 129) * 30 - 0
    assert by_id[13]["items"] == ["30", "8"] and not by_id[7].contaminated


@pytest.mark.parametrize("window", [1, 3, 13])
def test_decontaminate_prose(spark, prose, prose_rows, window):
    items = [(i, " ".join(t.split()[:17 + i])) for i, t in enumerate(prose[:12])]
    rows = D.decontaminate(prose_rows, spark.createDataFrame(items, "item_id long, text string"), window=window).collect()
    compare_hits(rows, items, list(enumerate(prose)), window)


def test_decontaminate_many_blocks_write_the_texts_once(spark, prose, prose_rows):
    from claimwright.session import scratch_scope
    items = [(i % 25, " ".join(prose[i % len(prose)].split()[i:i + 5 + i % 9])) for i in range(120)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    with scratch_scope(spark) as folder:
        rows = D.decontaminate(prose_rows, benchmark, window=4, block_bytes=60)
        compare_hits(rows.collect(), items, list(enumerate(prose)), 4)
        tables = [p.name for p in pathlib.Path(folder.removeprefix("file:")).iterdir()]
        blocks = [p for p in pathlib.Path(folder.removeprefix("file:")).glob("table-llm-hits-*/block=*")]
        assert len(blocks) >= 30 and sum(t.startswith("table-llm-decontaminate") for t in tables) == 1
        assert all("__body" not in spark.read.parquet(str(b)).columns for b in blocks[:3])


def test_decontaminate_empty_tables(spark, edge, none):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.decontaminate(none, benchmark).collect() == []
    rows = D.decontaminate(edge, benchmark.limit(0)).collect()
    assert len(rows) == edge.count() and all(r.n_hit == 0 and not r.contaminated for r in rows)


def test_decontaminate_keeps_columns(spark, edge):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = D.decontaminate(edge.withColumn("items", F.lit("?")), benchmark, keep=[*edge.columns, "items"])
    assert df.columns == [c for c in edge.columns if c != "n_words"] + list(D.RESULTS)
    assert {r.lang for r in df.collect()} == {"?"} and dict(df.dtypes)["items"] == "array<string>"


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 20])
def test_decontaminate_searches_items_without_id(spark, block_bytes):
    items = [(None, "only unnamed here"), (None, "second unnamed"), (1, "named one"), (None, "named one"), (2, None), (None, "")]
    docs = [(1, "x only unnamed here y"), (2, "named one z"), (3, "Second, unnamed only unnamed here"), (4, "nothing"), (5, None),
            (6, "word " * 100 + "second unnamed")]
    rows = D.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in rows) == [
        (1, 5, 3, 1, [], True), (2, 3, 2, 2, ["1"], True), (3, 5, 5, 1, [], True), (4, 1, 0, 0, [], False),
        (5, 0, 0, 0, [], False), (6, 102, 2, 1, [], False)]


def test_decontaminate_query_equals_its_sql_on_items_without_id(spark, tmp_path):
    import duckdb
    from claimwright.llm.queries import ORACLE_SQL, QUERIES
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    benchmark = benchmark.withColumn("item_id", F.when(F.col("item_id") % 3 != 0, F.col("item_id")))
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [tuple(r) for r in QUERIES["op1_decontaminate"](spark, str(tmp_path)).collect()]
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert sorted(rows) == sorted(db.execute(ORACLE_SQL["op1_decontaminate"]).fetchall())


def test_wu_manber_finds_overlapping_patterns():
    search = D.WuManber([b" a ", b" a b ", b" a b a ", b" ab ", b" " + b"abcdefgh " * 5])
    text = b" a b a b a ab " + b"abcdefgh " * 7
    at, ids = search.find(text)
    want = [(m, i) for g in search.groups for p, i in zip(g.patterns, g.ids) for m in range(len(text)) if text.startswith(p, m)]
    assert sorted(zip(at, ids)) == sorted(want) and len(want) > 8


# --- 2: SimHash --------------------------------------------------------------

def fingerprint(text, shingle=3):
    w = words(lower(text))
    parts = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(codes, distance):
    """Component by brute force: smallest non-null id."""
    n = len(codes)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if (codes[i][1] ^ codes[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(n):
        groups[find(i)].append(codes[i][0])
    return [(codes[i][0], f"{codes[i][1]:016x}", min((d for d in groups[find(i)] if d is not None), default=None)) for i in range(n)]


@pytest.mark.parametrize("distance,segments,crowd", [(2, 2, 64), (2, 2, 0), (3, 4, 0), (3, 2, 1), (0, 2, 64), (8, 4, 10**6)])
def test_simhash_prose(prose, prose_rows, distance, segments, crowd):
    got = [tuple(r) for r in M.simhash_dedup(prose_rows, max_distance=distance, segments=segments, crowd=crowd).collect()]
    assert sorted(got) == sorted(linked([(i, fingerprint(t)) for i, t in enumerate(prose)], distance))


def test_simhash_edge_rows(edge, none):
    got = [tuple(r) for r in M.simhash_dedup(edge).collect()]
    assert sorted(got, key=repr) == sorted(linked([(i, fingerprint(t)) for i, t in pairs(edge)], 2), key=repr)
    assert M.simhash_dedup(none).collect() == []


def test_simhash_exploded_rows_are_never_broadcast(spark):
    codes = spark.range(3000).select(F.xxhash64("id").alias("code"))  # small as Spark sizes it, some 34 and 65 times as many rows exploded
    for crowd in (64, 0, None):
        plan = M.hamming_links(codes, "code", 2, crowd=crowd)._jdf.queryExecution().sparkPlan().toString()
        joins = re.findall(r"(\w+Join) .*?, Inner", plan)
        assert joins == ["SortMergeJoin"] * (1 if crowd is None else 2), plan


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 150)]
    rows = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert dict((r.node, r.root) for r in rows) == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 150: 150, 200: 150}
    assert len(rows) == 41 + 30 + 2


# --- 3: SentencePiece --------------------------------------------------------

def test_sentencepiece_equals_the_library(edge, none, prose_rows):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for df in (edge, prose_rows):
        got = sorted(((r.doc_id, r.ids, r.decoded) for r in S.encode_decode(df, MODEL).collect()), key=repr)
        ids = [(i, lib.encode(t or "", add_eos=True)) for i, t in pairs(df)]
        assert got == sorted(((i, x, lib.decode(x)) for i, x in ids), key=repr)
    assert S.encode_decode(none, MODEL).collect() == []


def test_sentencepiece_word_memory_and_odd_spaces():
    enc = S.MergeEncoder(MODEL)
    texts = [" ", "  a", "a  ", "\n", " \n a\n\n", "▁a ▁ ▁", "a▁ b", "\x00", "�é́", "<0x41></s>", "a" * 300, "ab\ncd ef\n gh"]
    ids = [enc.encode(t) for t in texts]
    assert ids == enc.library.encode(texts, add_eos=True)
    assert [enc.decode(i) for i in ids] == enc.library.decode(ids)
    assert enc.decode([3 + 0xE3, 3 + 0x41, 3 + 0xC3]) == enc.library.decode([3 + 0xE3, 3 + 0x41, 3 + 0xC3])
    enc.check(texts, ids, enc.library.decode(ids))
    enc.encode("newword")
    enc.spaced.merged[0] = ("newword", (5,))
    with pytest.raises(ValueError, match="differ"):
        enc.check(texts, ids, enc.library.decode(ids))


# --- 4: repeated passages ----------------------------------------------------

def kept_words(rows, window):
    starts = defaultdict(set)
    split = [(i, words(t)) for i, t in rows]
    for i, w in split:
        for s in range(len(w) - window + 1):
            if i is not None:
                starts[tuple(w[s:s + window])].add(i)
    out = []
    for i, w in split:
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and min(starts[tuple(w[s:s + window])]) < i:
                gone |= set(range(s, s + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,phrase", [(50, 16), (12, 5), (3, 3), (20, 1)])
def test_substring_dedup_prose(prose, prose_rows, window, phrase):
    got = sorted((tuple(r) for r in P.substring_dedup(prose_rows, window=window, phrase=phrase).collect()), key=repr)
    assert got == kept_words(list(enumerate(prose)), window)


def test_substring_dedup_edge_rows(edge, none):
    short = edge.filter("doc_id is null or doc_id not in (7, 8, 13)")
    got = sorted((tuple(r) for r in P.substring_dedup(short, window=3, phrase=2).collect()), key=repr)
    assert got == kept_words(pairs(short), 3)
    assert P.substring_dedup(none).collect() == []


def test_substring_dedup_long_texts_and_repeated_ids(edge):
    rows = sorted(((r.doc_id, r.n_words, r.n_removed) for r in P.substring_dedup(edge.filter("doc_id in (7, 8, 13)")).collect()))
    assert rows == [(7, 60_000, 0), (8, 6, 0), (8, 60_000, 60_000), (13, 60_001, 60_000)]


@pytest.mark.parametrize("window,phrase,piece,words_of", [(5, 2, 64, 2), (6, 6, 3, 3), (8, 1, 1, 4), (20, 7, 5, 200)])
def test_substring_dedup_repetitive_texts(spark, monkeypatch, window, phrase, piece, words_of):
    monkeypatch.setattr(P, "PIECE", piece)
    rng = random.Random(window)
    shared = [[f"w{rng.randrange(words_of)}" for _ in range(40)] for _ in range(4)]
    docs = []
    for _ in range(60):
        text: list[str] = []
        for _ in range(rng.randrange(5)):
            part = rng.choice(shared)
            a = rng.randrange(20)
            text += part[a:a + rng.randrange(1, 40)] * rng.choice([1, 1, 3]) + [f"w{rng.randrange(words_of)}"]
        docs.append((rng.choice([None, *range(25)]), "  ".join(text)))  # ids repeat, with other texts and with none
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = sorted((tuple(r) for r in P.substring_dedup(rows, window=window, phrase=phrase).collect()), key=repr)
    assert got == kept_words(docs, window)


def test_substring_dedup_rows_of_one_id_stay_apart(spark):
    """A third of the rows under one id: equal results, and no row meets the anchors of the others."""
    passages = [" ".join(f"p{i}x{j}" for j in range(60)) for i in range(30)]
    docs = [(5, f"own{i} {p} end") for i, p in enumerate(passages)] + [(10 + i, f"{p} tail{i}") for i, p in enumerate(passages)]
    docs += [(i % 3, f"clean{i} " + " ".join(f"c{i}y{j}" for j in range(60))) for i in range(30)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    out = P.substring_dedup(rows)
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == kept_words(docs, 50) and sum(r[2] for r in got) == 30 * 60


def test_substring_dedup_result_comes_from_the_automaton(monkeypatch):
    words_ = [f"w{i}" for i in range(80)]
    text = " ".join(words_).encode()
    passages = [[" ".join(words_[10:70]).encode(), " ".join(words_[:49] + ["other"]).encode()]]
    removed = P._without(50, 16)([text], passages)
    assert removed[2] == [60] and removed[3] == [hashlib.sha256(" ".join(words_[:10] + words_[70:]).encode()).hexdigest()]
    monkeypatch.setattr(P.Automaton, "occurrences", lambda self, doc: [])
    assert P._without(50, 16)([text], passages)[2] == [0]


# --- 5: exact copies ---------------------------------------------------------

@pytest.mark.parametrize("block_chars", [1, 7, 4096])
def test_exact_dedup_edge_rows(edge, none, block_chars):
    df = edge if block_chars > 1 else edge.filter("length(text) < 10000 or text is null")
    rows = E.exact_dedup(df, block_chars=block_chars).collect()
    groups = defaultdict(list)
    for i, t in pairs(df):
        groups[t or ""].append(i)
    want = sorted(((i, max((d for d in g if d is not None), default=None), len(g), hashlib.sha256(t.encode()).hexdigest())
                   for t, g in groups.items() for i in g), key=repr)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr) == want
    assert sum(r.kept for r in rows) == len(groups) and all(r.doc_id == r.keep_id for r in rows if r.kept)
    assert E.exact_dedup(none).collect() == []


# --- 6: token counts ---------------------------------------------------------

def test_token_counts_equal_the_library(edge, none, prose_rows):
    lib = Tokenizer.from_file(BYTES)
    for df in (edge, prose_rows):
        got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in C.token_counts(df, BYTES, limit=30).collect()), key=repr)
        counts = [(i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t in pairs(df)]
        assert got == sorted(((*c, c[2] > 30) for c in counts), key=repr)
    assert C.token_counts(none, BYTES).collect() == []


def test_token_counts_with_a_small_memory(monkeypatch, prose):
    monkeypatch.setattr(C, "MEMORY_TOKENS", 50)
    monkeypatch.setattr(C, "MERGE_BYTES", 64)
    merger, lib = C.RankMerger(BYTES), Tokenizer.from_file(BYTES)
    for some in (prose[:30], prose[20:], ["aaaaaaa aaaa<|endoftext|><|endoftext|>x", "x'll  \n\n y"]):
        assert merger.tokens([t.encode() for t in some]) == [len(e.ids) for e in lib.encode_batch(some, add_special_tokens=False)]


def test_token_counts_of_characters_from_all_of_unicode():
    around = {c for a, b in C.NEWER for c in (a - 1, a, b, b + 1)}
    points = [c for c in sorted(around | set(range(0, 0x110000, 257)) | set(range(0x3000))) if not 0xD800 <= c < 0xE000]
    texts = ["a{0}1{0}{0} {0}'s{0}\n{0}  {0}1 ".format(chr(c)) for c in points]
    lib = Tokenizer.from_file(BYTES)
    assert C.RankMerger(BYTES).tokens([t.encode() for t in texts]) == [
        len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]
    enc = S.MergeEncoder(MODEL)
    ids = [enc.encode(t) for t in texts]
    assert ids == enc.library.encode(texts, add_eos=True)
    assert [enc.decode(i) for i in ids] == enc.library.decode(ids)


# --- 9: shards ---------------------------------------------------------------

def test_shards(spark, edge, none):
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("é"), F.col("id") % 7).alias("text"))
    rows = H.shard_documents(many, 24).collect()
    assert {r.grown_shard for r in rows if r.grown_shard != r.shard} == {24}
    sizes = defaultdict(list)
    for r in rows:
        sizes[r.shard].append(r.slot)
    assert sorted(sizes) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in sizes.values())
    assert all(abs(len(s) - 20_000 / 24) < 150 for s in sizes.values())
    again = {r.doc_id: r.shard for r in H.shard_documents(many.filter("doc_id % 3 = 0"), 24).collect()}
    assert all(again[r.doc_id] == r.shard for r in rows if r.doc_id in again)
    assert all(r["size"] == 11 and r.law == "key" for r in rows)
    assert H.shard_documents(none, 24).collect() == []
    odd = H.shard_documents(edge, 24).collect()
    assert len(odd) == edge.count() and {r["size"] for r in odd if r.doc_id in (2, 3)} == {8}


def test_slots_of_a_key_with_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(H, "CELL_ROWS", 10)
    df = spark.range(900).select(F.when(F.col("id") < 300, F.lit(None)).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    slots = defaultdict(list)
    for r in H.shard_documents(df, 5).collect():
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == 900 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_move_rows_only_with_their_subtree(spark):
    tree = H.layout(12, racks_per_region=2, shards_per_rack=2)
    df = spark.range(6000).select(F.col("id").alias("doc_id"))
    for weight, into in ((3.0, True), (0.4, False), (0.0, False)):
        changed = [H.Shard(s.region, s.rack, s.shard, weight if s.shard == 5 else 1.0) for s in tree]
        both = H.assign_shard(H.assign_shard(df, "doc_id", tree, "old"), "doc_id", changed, "new").filter("old != new")
        moved = {(r.old, r.new) for r in both.collect()}
        assert moved and {(new if into else old) for old, new in moved} == {5}
    sizes = {r.shard: r["count"] for r in H.assign_shard(df, "doc_id", [H.Shard(s.region, s.rack, s.shard, 1.0 + s.shard) for s in tree],
                                                         "shard").groupBy("shard").count().collect()}
    assert all(abs(sizes[s.shard] - 6000 * (1 + s.shard) / 78) < 5 * (6000 * (1 + s.shard) / 78) ** 0.5 for s in tree)


def test_one_shard_more_takes_rows_only_into_itself_for_every_number(spark):
    """Shards by the tree equal the least of all draws, so for every number the next one only adds a draw."""
    import math
    df = spark.range(400).select(F.when(F.col("id") > 5, F.col("id")).alias("doc_id")).coalesce(1)
    key = F.struct(F.coalesce("doc_id", F.lit(0).cast("long")), F.col("doc_id").isNull())
    draws = {r.doc_id: [-math.log(((h % (1 << 64)) >> 11) + 0.5) for h in r.h] for r in
             df.select("doc_id", F.array(*[F.xxhash64(F.lit("shard"), F.lit(s), key) for s in range(41)]).alias("h")).collect()}
    for n in [*range(7, 41, 4), 24, 25]:
        tree = H.layout(n)
        both = H.assign_shard(H.assign_shard(df, "doc_id", tree, "shard"), "doc_id", H.grow(tree), "grown")
        for r in both.collect():
            first = draws[r.doc_id]
            assert (r.shard, r.grown) == (min(range(n), key=first.__getitem__), min(range(n + 1), key=first.__getitem__))


def test_shards_by_brute_force(spark, edge):
    import math
    import zlib
    got = Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in H.shard_documents(edge, 6).collect())
    key = F.struct(F.coalesce("doc_id", F.lit(0).cast("long")), F.col("doc_id").isNull())
    rows = edge.select("doc_id", "text", *[F.xxhash64(F.lit("shard"), F.lit(s), key).alias(f"h{s}") for s in range(7)]).collect()
    want = Counter()
    for r in rows:
        draws = [-math.log((((r[f"h{s}"] % (1 << 64)) >> 11) + 0.5) / (1 << 53)) for s in range(7)]
        raw = (r.text or "").encode()
        want[r.doc_id, len(raw) + 8, zlib.crc32(raw), min(range(6), key=draws.__getitem__), min(range(7), key=draws.__getitem__)] += 1
    assert got == want


def test_queries_of_the_package_run(spark):
    import __spark_entry__ as entry
    for name in ("op2_simhash", "op3_sentencepiece", "op6_token_counts", "op9_sharding"):
        df = entry.queries()[name](spark, SF_SMALL)
        assert df.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
