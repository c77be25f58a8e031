from __future__ import annotations

import hashlib
import math
import pickle
import re
import tracemalloc
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from edge_rows import SF_SMALL, edge, none, prose, prose_rows  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from claimwright.llm import chat, gru_lm, quality
from claimwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


# --- 7: language model -------------------------------------------------------

def lm_tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]


def check_base(rows, texts):
    train = Counter()
    for i, t in texts:
        if i is not None and crc32(str(i).encode()) % 7 != 2:
            train.update(lm_tokens(t))
    n, v = sum(train.values()), len(train)
    want = []
    for i, t in texts:
        w = lm_tokens(t)
        base = sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w)
        want.append((i, i is None or crc32(str(i).encode()) % 7 == 2, len(w), sum(x in train for x in w), n, round(base, 4)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_lm_base_scores(monkeypatch, edge, none, prose, prose_rows):
    monkeypatch.setattr(gru_lm, "FREQUENT", 40)  # most tokens are joined
    check_base(gru_lm.lm_scores(prose_rows, rounds=1).collect(), list(enumerate(prose)))
    rows = gru_lm.lm_scores(edge, rounds=1).collect()
    check_base(rows, [(r.doc_id, r.text) for r in edge.collect()])
    assert all(r.score < 0 for r in rows)
    assert gru_lm.lm_scores(none, rounds=1).collect() == []


def test_lm_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in QUERIES["op7_lm_score"](spark, SF).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_lm_score_without_training_by_brute_force(monkeypatch, edge, prose, prose_rows):
    """Before it learns the network is the counts' unigram model, so every part of the score can be recomputed."""
    monkeypatch.setattr(gru_lm, "LEAST_SYMBOLS", 30)
    monkeypatch.setattr(gru_lm, "FREQUENT", 60)
    for df, texts in ((prose_rows, list(enumerate(prose))), (edge, [(r.doc_id, r.text) for r in edge.collect()])):
        train = Counter()
        for i, t in texts:
            if i is not None and crc32(str(i).encode()) % 7 != 2:
                train.update(lm_tokens(t))
        short = {w: c for w, c in train.items() if len(w.encode()) <= gru_lm.SHORT}
        ranked = sorted(short, key=lambda w: (-short[w], w.encode()))
        # tokens are broadcast by whole steps of frequency
        step = lambda c: math.floor(math.log2(c) * 8)
        sizes, taken = Counter(step(c) for c in short.values()), 0
        for s in sorted(sizes, reverse=True):
            if taken + sizes[s] > 60:
                break
            taken += sizes[s]
        symbols = ranked[:min(taken, 30)]
        counts = [train[w] for w in symbols] + [sum(train.values()) - sum(train[w] for w in symbols)]
        p = np.maximum(counts, 0.5) / np.maximum(counts, 0.5).sum()
        others = counts[-1] + len(train) - len(symbols) + 1
        number = {w: i for i, w in enumerate(symbols)}
        want = sorted(sum(math.log10(p[number[w]]) if w in number else math.log10(p[-1]) + math.log10((train[w] + 1) / others)
                          for w in lm_tokens(t)) for _, t in texts)
        got = sorted(r.score for r in gru_lm.lm_scores(df, rounds=0).collect())
        assert np.allclose(got, want, rtol=2e-5)


def net_and_texts():
    rng = np.random.default_rng(1)
    net = gru_lm.GRU(rng.integers(1, 50, 11).astype(float), hidden=5)
    net.class_w[:-1] = rng.normal(0, 1, net.class_w[:-1].shape)
    net.word_w[:, :-1] = rng.normal(0, 1, net.word_w[:, :-1].shape)
    return net, [rng.integers(0, 11, n) for n in (1, 7, 3, 40, 7, 2100, 16, 17, 33)]


def plain_states(net, text):
    """States of one text, one token after the other, in double precision."""
    k, h, last, out = net.hidden, np.zeros(net.hidden), net.n, []
    x, u = net.x.astype(float), net.u.astype(float)
    for s in text:
        gx, gh = x[last], h @ u
        r, z = (1 / (1 + np.exp(-(gx[i * k:(i + 1) * k] + gh[i * k:(i + 1) * k]))) for i in (0, 1))
        h = h + z * (np.tanh(gx[2 * k:] + r * gh[2 * k:]) - h)
        out.append(h)
        last = s
    return out


def plain_score(net, text):
    total = 0.0
    for h, s in zip(plain_states(net, text), text):
        h = np.append(h, 1.0)
        for z, i in ((h @ net.class_w, s // net.size), (h @ net.word_w[s // net.size], s % net.size)):
            total += z[i] - np.log(np.exp(z).sum())
    return total


def test_lm_is_a_distribution_over_symbols():
    net, _ = net_and_texts()
    h = np.c_[np.random.default_rng(2).normal(0, 1, (6, 5)), np.ones(6)].astype(np.float32)
    total = sum(np.exp(net.output(h, np.full(6, s))[0]) for s in range(11))
    assert np.allclose(total, 1, atol=1e-4)


@pytest.mark.parametrize("lanes", [1, 2, 4, 512])
def test_lm_carries_the_state_through_the_text(monkeypatch, lanes):
    monkeypatch.setattr(gru_lm, "SCORED_LANES", lanes)
    net, texts = net_and_texts()
    got = gru_lm.score_texts(net, texts)
    for text, score in zip(texts, got):
        assert abs(score - plain_score(net, text) / math.log(10)) < 1e-3 * len(text)
    assert gru_lm.score_texts(net, []).tolist() == []


@pytest.mark.parametrize("lanes", [1, 3, 16])
def test_lm_lanes_read_every_symbol_once(lanes):
    rng = np.random.default_rng(lanes)
    texts = [rng.integers(0, 11, n) for n in (5, 1, 3000, 16, 64, 1024, 1025, 1040, 2, 7)]
    net = gru_lm.GRU(np.ones(11), hidden=2)
    read = [[] for _ in texts]
    for state, (last, want, goes_on, owner) in gru_lm.windows(enumerate(texts), net, lanes):
        assert len(state[0]) == want.shape[1]
        for t, lane in zip(*np.nonzero(want >= 0)):
            who = owner[t, lane]
            assert (goes_on[t, lane] == 0) == (not read[who])
            assert last[t, lane] == (read[who][-1] if read[who] else net.n)
            read[who].append(int(want[t, lane]))
    assert read == [t.tolist() for t in texts]


def test_lm_learns_from_every_text_in_one_round(prose):
    for rounds in (1, 2, 3):
        assert {gru_lm.learned_in(t.encode(), rounds) for t in prose} <= set(range(rounds))


def test_lm_training_lowers_the_loss():
    rng = np.random.default_rng(4)
    texts = [np.array([(i + k) % 7 for k in range(rng.integers(20, 60))]) for i in range(200)]  # a cycle: only the state tells
    net = gru_lm.GRU(np.bincount(np.concatenate(texts), minlength=11).astype(float), hidden=8)
    before = gru_lm.score_texts(net, texts).sum()
    learner = gru_lm.Learner(net, rate=0.1)
    for _ in range(20):
        learner.learn(iter(texts), lanes=16)
    assert learner.tokens == 20 * sum(map(len, texts))
    assert gru_lm.score_texts(net, texts).sum() > 0.3 * before


def test_lm_gradients_agree_with_differences():
    net, texts = net_and_texts()
    for n in net.NAMES:
        setattr(net, n, getattr(net, n).astype(np.float64))
    text = np.concatenate([texts[3][:5], texts[1][:4]])[:, None]  # a lane in which a second text begins
    goes_on = np.ones(text.shape)
    goes_on[[0, 5]] = 0
    last = np.r_[[[net.n]], text[:-1]]
    last[5] = net.n
    grads = {}

    def loss():
        return -(plain_score(net, text[:5, 0]) + plain_score(net, text[5:, 0]))

    net.window(np.zeros((1, 5)), last, text, goes_on, grads)
    rows, some = grads["x"]
    grads["x"] = np.zeros_like(net.x)
    grads["x"][rows] = some
    for n in net.NAMES:
        p, g = getattr(net, n), grads[n]
        for i in np.random.default_rng(3).integers(0, p.size, 25):
            at = np.unravel_index(i, p.shape)
            old = p[at]
            p[at] = old + 1e-5
            up = loss()
            p[at] = old - 1e-5
            down = loss()
            p[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-3 * max(1, abs(g[at])), (n, at)


def test_lm_windows_use_their_arrays_again():
    rng = np.random.default_rng(6)
    net = gru_lm.GRU(rng.integers(1, 50, 1025).astype(float))
    shape = gru_lm.WINDOW, gru_lm.LANES
    h, goes_on = np.zeros((gru_lm.LANES, net.hidden), dtype=np.float32), np.ones(shape, dtype=np.float32)
    windows = [rng.integers(0, 1025, shape).astype(np.int32) for _ in range(3)]
    h = net.window(h, windows[0], windows[1], goes_on, {})
    tracemalloc.start()
    net.window(h, windows[1], windows[2], goes_on, {})
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 4 << 20
    assert pickle.loads(pickle.dumps(net))._room is None  # not sent to the tasks


def test_lm_numbers_stay_normal_on_large_counts():
    """Probabilities of places without a symbol and their gradients are not subnormal numbers, on which arithmetic is many times slower."""
    rng = np.random.default_rng(8)
    counts = np.append(rng.integers(1, 10**6, 1024), 10**10).astype(float)  # 31 places are left
    net, shape, grads = gru_lm.GRU(counts), (gru_lm.WINDOW, 8), {}
    want = rng.integers(1000, 1025, shape).astype(np.int32)
    net.window(np.zeros((8, net.hidden), dtype=np.float32), want, want, np.ones(shape, dtype=np.float32), grads)
    least = np.finfo(np.float32).tiny
    for numbers in (net.room.kept["pw"], grads["word_w"], np.square(grads["word_w"][:, -1])):
        assert not ((numbers != 0) & (np.abs(numbers) < least)).any()


def test_lm_learns_only_where_classes_have_words():
    """Classes without a wanted word keep weights and squares; all others are as if every class had been added up."""
    rng = np.random.default_rng(7)
    net = gru_lm.GRU(rng.integers(1, 50, 100).astype(float), hidden=4)
    before, learner = net.word_w.copy(), gru_lm.Learner(net, rate=0.1)
    learner.learn(iter([np.array([3, 25, 3, 4, 26], dtype="<i2")]), lanes=2)  # classes of ten words: 0 and 2
    changed = (net.word_w != before).any(axis=(1, 2)).tolist()
    assert changed == (learner.squares["word_w"] != np.float32(1e-4)).any(axis=(1, 2)).tolist() == [c in (0, 2) for c in range(10)]


@pytest.mark.parametrize("known", [[], [b"x", b"\n", b"a"]])
def test_lm_words_are_those_of_plain_splitting(known):
    texts = [b"", b" a  B ", b"\t\n\x0b\x0c\rX\xc3\x89 y\x85\xc2\xa0z \x1c\x1f q\xff", b"   ", b"one", b"\xe2\x80\x83a a\x00b", b"", b"A A"]
    at, numbers, distinct = gru_lm.words(texts, pa.array(known, type=pa.large_binary()))
    distinct = distinct.to_pylist()
    assert distinct[:len(known)] == known and len(set(distinct)) == len(distinct)
    got = [[distinct[i] for i in numbers[a:b]] for a, b in zip(at[:-1], at[1:])]
    assert got == [re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), t)) for t in texts]


def test_lm_counts_are_flushed_and_added_up(monkeypatch, prose, prose_rows):
    monkeypatch.setattr(gru_lm, "COUNTED", 20)
    want = Counter(w for t in prose for w in lm_tokens(t))
    assert {bytes(r.token).decode(): r.c for r in gru_lm.token_counts(prose_rows, "text").collect()} == want


# --- 8: quality --------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op8_quality"](spark, SF).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 40 and np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_edge_rows(spark, edge, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 1), (6, 1), (9, None), (10, 0), (None, 1), (7, 1), (14, 0), (14, 0)],
                                   "doc_id long, quality int")
    model, vectors = quality.train(edge, labels, folds=1, fold=1)
    rows = quality.classify(edge, model, vectors).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(none, model, vectors).collect() == []
    for some in (labels.limit(0), labels.filter("quality = 1")):
        model, vectors = quality.train(edge, some, folds=1, fold=1)
        assert {r.score for r in quality.classify(edge, model, vectors).collect()} <= {0.5, 1.0}


def test_quality_learns_from_no_held_out_row(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    sample = quality._sample(docs, labels, "doc_id", "text", "quality", 5, 0, 50).collect()
    assert len(sample) == 50 and all(crc32(str(r[0]).encode()) % 5 for r in sample)


def test_quality_sample_holds_one_row_of_each_id(spark):
    docs = spark.range(300).selectExpr("IF(id < 100, 1, id) AS doc_id", "concat('text ', id) AS text").repartition(4)
    docs = docs.unionByName(spark.createDataFrame([(1, None)], "doc_id long, text string"))
    labels = spark.range(300).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    sample = quality._sample(docs, labels, "doc_id", "text", "quality", 1, 1, 1000)
    rows = sorted((r["__id"], r["__y"]) for r in sample.collect())
    assert rows == [(i, i % 2) for i in [1, *range(100, 300)]]
    again = quality._sample(docs.repartition(7), labels, "doc_id", "text", "quality", 1, 1, 1000)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, sample.collect()))


# --- 10: chat ----------------------------------------------------------------

CHAT = [(1, 1, "user", "hi"), (1, 2, "assistant", "a \\0 \\a [INST] </s>"), (1, 3, "user", None), (1, 4, "assistant", ""),
        (2, 1, "assistant", "[/INST]<s>"), (2, 1, "assistant", "[/INST]<s>"), (3, 1, None, "x\n[ROLE]"), (3, 2, "to[TEXT]ol", "<</s>"),
        (None, 1, "user", "["), (4, None, "user", "first"), (4, 1, "system", "b" * 50_000), (5, 2, "assistant", "2"), (5, 1, "user", "1")]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*r, "?") for r in CHAT], "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_chats(df).withColumn("turns", chat.read_back(F.col("formatted"))).collect()
    groups = {}
    for c, t, r, x in sorted(CHAT, key=lambda r: (str(r[0]), r[1] if r[1] is not None else -1, r[2] or "", r[3] or "")):
        groups.setdefault(c, []).append((r or "", x or "", r == "assistant"))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in out} == groups
    for r in out:
        assert "".join(s.text for s in r.segments) == r.formatted
    assert {r.conv_id: r.valid_order for r in out} == {1: True, 2: False, 3: False, None: True, 4: False, 5: True}
    assert chat.format_chats(df.limit(0)).collect() == []


def test_chat_texts_hold_no_control_string(spark):
    template = chat.Template()
    nasty = "".join(template.controls()) * 2 + template.escape * 3 + "0ab"
    row = spark.range(1).select(chat.escape(F.lit(nasty), template).alias("e")).withColumn("u", chat.unescape(F.col("e"), template)).first()
    assert row.u == nasty and not any(c in row.e for c in template.controls())


def test_chat_query_takes_the_learned_text_from_the_segments(spark, monkeypatch):
    before = {r.conv_id: r for r in QUERIES["op10_chat_format"](spark, SF_SMALL).collect()}
    assert before[-7].loss_chars == len("</s>[INST] ok [/INST]")
    made = chat.format_chats

    def unflagged(rows):
        return made(rows).withColumn("segments", F.expr("transform(segments, s -> struct(s.text AS text, false AS loss))"))

    monkeypatch.setattr(chat, "format_chats", unflagged)
    after = {r.conv_id: r for r in QUERIES["op10_chat_format"](spark, SF_SMALL).collect()}
    assert all(r.loss_chars == 0 for r in after.values())
    assert all(after[c].turns_sha256 == r.turns_sha256 for c, r in before.items())


# --- pipeline ----------------------------------------------------------------

@pytest.fixture(scope="module")
def stages(spark):
    from claimwright.llm.common import stored
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs, stored(stage(spark, docs, SF_SMALL), f"test-{name}")))
        docs = out[-1][2]
    return {name: (before, after) for name, before, after in out}


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_pipeline_stages_keep_the_columns(spark, stages):
    columns = spark.read.parquet(f"{SF_SMALL}/documents.parquet").columns
    assert [len(stages), *stages] == [5, "quality", "exact_dedup", "near_dedup", "decontaminate", "encode"]
    assert all(after.columns == columns for name, (_, after) in stages.items() if name != "encode")


def test_pipeline_decisions(spark, stages):
    before, after = stages["exact_dedup"]
    largest = {}
    for r in before.collect():
        largest[r.text or ""] = max(r.doc_id, largest.get(r.text or "", r.doc_id))
    assert ids(after) == sorted(largest.values())
    before, after = stages["near_dedup"]
    from test_text_operators import fingerprint, hits, linked
    near = linked([(r.doc_id, fingerprint(r.text)) for r in before.collect()], 2)
    assert ids(after) == sorted({c for _, _, c in near})
    before, after = stages["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    clean = []
    for r in before.collect():
        n, hit, _ = hits(r.text, items, 13)
        if not (hit and 20 * hit >= n):
            clean.append(r.doc_id)
    assert ids(after) == sorted(clean)


def test_pipeline_keeps_good_documents(spark, stages):
    before, after = stages["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = set(ids(after))
    good = [i for i in ids(before) if labels.get(i) == 1]
    bad = [i for i in ids(before) if labels.get(i) == 0]
    assert np.mean([i in kept for i in good]) > 0.97 and np.mean([i in kept for i in bad]) < 0.2


def test_pipeline_run(spark, stages):
    rows = {tuple(r) for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert rows == {tuple(r) for r in stages["encode"][1].collect()} and rows


def test_pipeline_on_odd_rows(spark, edge, none):
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, edge, SF_SMALL).columns == edge.columns, name
        assert stage(spark, none, SF_SMALL).count() == 0, name
    near = {(r.doc_id, (r.text or "")[:20]) for r in corpus_pipeline.drop_near_copies(spark, edge, SF_SMALL).collect()}
    assert (8, "other text of the sa") in near and (-3, "alpha beta gamma del") in near and (5, "alpha beta gamma del") not in near
    kept = corpus_pipeline.drop_copies(spark, edge, SF_SMALL).collect()
    texts = [r.text or "" for r in kept]
    assert sorted(texts) == sorted({r.text or "" for r in edge.collect()})
    assert hashlib.sha256(b"").hexdigest() not in texts


def test_pipeline_near_copies_of_rows_without_a_unique_id(spark):
    base, other = "the first text with words", "another text about something else"
    groups = [{base, base.upper()}, {other, other.upper()}, {"q"}, {"z z"}, {"single"}]  # equal fingerprints
    rows = [(None, base.upper()), (None, base), (3, base.upper()), (4, base), (4, other), (5, other.upper()), (6, "q"), (6, "q"),
            (None, "z z"), (None, "z z"), (2, "single")]
    docs = spark.createDataFrame([(*r, "?") for r in rows], "doc_id long, text string, __row string").repartition(3)
    out = corpus_pipeline.drop_near_copies(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    kept = [(r.doc_id, next(i for i, g in enumerate(groups) if r.text in g)) for r in out.collect()]
    assert sorted(kept, key=repr) == sorted([(3, 0), (4, 1), (6, 2), (None, 3), (2, 4)], key=repr)


ODD_NAMES = ["__sha", "__id", "__doc", "__row", "a.b", "`tick`", "doc", "row", "sha", "c0", "text_sha256", "predicted", "n_hit", " "]


def test_pipeline_stages_keep_columns_of_any_name(spark, edge, none):
    odd = edge.select(F.lit(1).alias("LANG"), "doc_id", "text", *[F.concat(F.lit(f"{n}="), F.coalesce(F.col("doc_id").cast("string"), F.lit("~"))).alias(n) for n in ODD_NAMES])
    before = {tuple(r) for r in odd.collect()}
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == odd.columns, name
            assert {tuple(r) for r in out.collect()} <= (before if docs is odd else set()), name
        assert corpus_pipeline.encode(spark, docs, SF_SMALL).count() == docs.count()


def test_pipeline_stages_with_names_that_differ_in_case(spark, edge):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        odd = edge.select("doc_id", "text", F.lit("x").alias("TEXT"), F.lit(5).alias("Doc_Id"))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, odd, SF_SMALL).columns == ["doc_id", "text", "TEXT", "Doc_Id"], name
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_near_copies_stage_broadcasts_no_exploded_rows(monkeypatch, prose_rows):
    plans, found = [], corpus_pipeline.simhash.components

    def components(links, *names):
        plans.append(links._jdf.queryExecution().sparkPlan().toString())
        return found(links, *names)

    monkeypatch.setattr(corpus_pipeline.simhash, "components", components)
    kept = corpus_pipeline.drop_near_copies(prose_rows.sparkSession, prose_rows, SF_SMALL)
    assert 0 < kept.count() <= prose_rows.count()
    assert re.findall(r"(\w+Join) .*?, Inner", plans[0]) == ["SortMergeJoin"] * 2
