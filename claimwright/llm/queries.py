"""Registered queries of the operators, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.llm import (
    byte_bpe, chat, conversation_repair, decontaminate, exact_dedup, gru_lm, quality, sentencepiece_bpe, sharding,
    simhash, source_divergence, substring_dedup, token_counts,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file, as installed on driver and executors."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, d, "documents"), _table(spark, d, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op2_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.simhash_dedup(_table(spark, d, "documents"), shingle=3, max_distance=2)


def coded_digests(docs: DataFrame) -> DataFrame:
    coded = sentencepiece_bpe.encode_decode(docs, vocabulary("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return coded_digests(_table(spark, d, "documents"))


def op4_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring_dedup.substring_dedup(_table(spark, d, "documents"), window=50)


def op5_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, d, "documents"))


def op6_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, d, "documents"), vocabulary("byte_bpe_50k.json"), limit=512)


def op7_lm_score(spark: SparkSession, d: str) -> DataFrame:
    return gru_lm.lm_scores(_table(spark, d, "documents"), folds=7, fold=2)


def op8_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    model, vectors = quality.train(docs, _table(spark, d, "labels"), folds=5, fold=0)
    return (quality.classify(docs, model, vectors, threshold=0.3)
            .select("doc_id", quality.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted"))


def op9_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, d, "documents"), shards=24)


def op10_chat_format(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(1, 3).selectExpr(
        "CAST(-7 AS BIGINT) AS conv_id", "id AS turn",
        "CASE WHEN id = 1 THEN 'user' ELSE 'assistant' END AS role", "'</s>[INST] ok [/INST]' AS text")
    chats = chat.format_chats(rows.unionByName(planted))
    turns = chat.read_back(F.col("formatted"))
    chats = chats.withColumn("__turns", turns)
    learned = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                       lambda s: chat.unescape(s["text"], chat.Template())), "")
    dump = F.array_join(F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id", F.size("__turns").cast("long").alias("n_turns"), F.sha2(dump, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid_order")


def op11_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    return source_divergence.audit(_table(spark, d, "documents"), min_docs=10, top=10)


def op12_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    coded = byte_bpe.encode_decode(_table(spark, d, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def repair_report(rows: DataFrame, **kw: int) -> DataFrame:
    """Damaged and repaired conversations: counts, audit and digest of every conversation of ``rows``."""
    fixed = conversation_repair.repair(conversation_repair.damaged(rows), **kw)
    convs = rows.select(F.col("conv_id").alias("conv")).distinct()
    audits = fixed.audits.withColumnRenamed("conv_id", "audit_conv")
    texts = conversation_repair.digests(fixed.turns).withColumnRenamed("conv_id", "text_conv")
    found = (convs.join(audits, convs["conv"].eqNullSafe(audits["audit_conv"]), "left")
             .join(texts, convs["conv"].eqNullSafe(texts["text_conv"]), "left"))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(F.col("conv").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    return repair_report(_table(spark, d, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_simhash": op2_simhash,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_lm_score": op7_lm_score,
    "op8_quality": op8_quality,
    "op9_sharding": op9_sharding,
    "op10_chat_format": op10_chat_format,
    "op11_source_divergence": op11_source_divergence,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[s:s + 12], ' ') AS g
                FROM i, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(s) WHERE len(w) > 0),
        dw AS (SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS g
               FROM d, (SELECT DISTINCT k FROM win) AS ks, unnest(range(1, len(w) - k + 2)) AS t(s)),
        hit AS (SELECT doc_id, s, k, item_id FROM dw JOIN win USING (k, g)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                  FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT doc_id, s, k FROM hit))
                  GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op4_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, s, md5_number(array_to_string(w[s:s + 49], ' ')) AS g
                FROM d, unnest(range(1, len(w) - 48)) AS t(s)),
        low AS (SELECT g, min(doc_id) AS lo FROM win GROUP BY g HAVING min(doc_id) < max(doc_id)),
        gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + 50)) AS p
                 FROM win JOIN low USING (g) WHERE doc_id > lo)),
        word AS (SELECT doc_id, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k, count(*) AS n
                 FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(k, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op5_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(x) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY x)""",
    # The template's marks: [SYS][/SYS], [INST][/INST], <s></s>; each control
    # string inside a text takes 2 characters, and so does each backslash.
    "op10_chat_format": r"""
        WITH r AS (SELECT conv_id, turn, role, coalesce(text, '') AS x FROM conversations
                   UNION ALL SELECT -7, 1, 'user', '</s>[INST] ok [/INST]'
                   UNION ALL SELECT -7, 2, 'assistant', '</s>[INST] ok [/INST]'),
        m AS (SELECT *, CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                             ELSE 19 + length(coalesce(role, '')) END AS marks,
                     length(regexp_replace(replace(x, '\', '\0'),
                         '<s>|</s>|\[SYS\]|\[/SYS\]|\[INST\]|\[/INST\]|\[ROLE\]|\[/ROLE\]|\[TEXT\]', '\\9', 'g')) AS n
              FROM r),
        g AS (SELECT conv_id, count(*) AS n_turns,
                     string_agg(coalesce(role, '') || chr(10) || x || chr(10), '' ORDER BY turn, role, x) AS dump,
                     coalesce(string_agg(CASE WHEN role = 'assistant' THEN x END, '' ORDER BY turn, role, x), '') AS learned,
                     sum(marks + n) AS formatted_chars,
                     string_agg(coalesce(role, '?'), ',' ORDER BY turn, role, x) || ',' AS roles
              FROM m GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(dump) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
               sha256(learned) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars,
               regexp_full_match(roles, '(system,)?(user,assistant,)*(user,)?') AS valid_order
        FROM g""",
    "op11_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs
              FROM (SELECT lang, source, r, unnest(w) AS term FROM d) GROUP BY ALL),
        k AS (SELECT lang, term, sum(n) AS lang_n FROM c GROUP BY ALL HAVING sum(docs) >= 10),
        l AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM k GROUP BY lang),
        u AS (SELECT c.* FROM c JOIN k USING (lang, term)),
        g AS (SELECT lang, source, coalesce(sum(n), 0) AS total
              FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN u USING (lang, source) GROUP BY ALL),
        p AS (SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
                     1 + (1000000000::HUGEINT * (coalesce(u.n, 0) + 2)) // (g.total + 2 * l.v) AS p,
                     1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (l.total + 2 * l.v) AS q
              FROM g JOIN k ON g.lang = k.lang JOIN l ON l.lang = g.lang
              LEFT JOIN u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
        sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                 FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        rows AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
                 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                 LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
                 UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 10""",
}
