from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"

LONG = " ".join(f"w{i % 997}" for i in range(60_000))

#: Nulls, empty and very long texts, ties, repeated rows and odd characters.
EDGE_ROWS = [
    (1, "alpha beta gamma delta"), (2, None), (3, ""), (4, "   \n\t "), (5, "alpha beta gamma delta"),
    (6, "Alpha BETA gamma\tdelta"), (6, "Alpha BETA gamma\tdelta"), (7, LONG), (8, LONG), (8, "other text of the same id"),
    (None, "no id here"), (None, None), (9, "éà ñ 日本語 ▁   x\u0085y"), (10, "a" * 5000), (11, "</s><s>[INST] <|endoftext|> \\0 \x00z"),
    (12, "one"), (13, LONG + " tail"), (14, "x " * 200), (15, " lead and trail "), (-3, "alpha beta gamma delta"),
]


@pytest.fixture(scope="module")
def edge(spark):
    """The rows with further columns, whose names clash with results."""
    names = ["lang", "n_words", "score", "kept", "shard", "component_id", "__row", "n_tokens", "held_out"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           *[T.StructField(n, T.StringType()) for n in names]])
    return spark.createDataFrame([(i, t, *["?"] * len(names)) for i, t in EDGE_ROWS], schema).repartition(3)


@pytest.fixture(scope="module")
def none(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def prose():
    """Made-up texts with repeated passages and near copies."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(1, 3))) for _ in range(300)]
    passages = [" ".join(rng.choices(words, k=rng.randint(40, 90))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 80))) for _ in range(3)]
        if rng.random() < 0.6:
            parts.insert(rng.randint(0, 2), rng.choice(passages))
        texts.append(rng.choice([" ", "\n"]).join(parts))
    for _ in range(20):
        near = rng.choice(texts).split(" ")
        near[rng.randrange(len(near))] = rng.choice(words)
        texts.append(" ".join(near))
    return [*texts, texts[0], texts[1], texts[1]]


@pytest.fixture(scope="session")
def prose_rows(spark, prose):
    return spark.createDataFrame(list(enumerate(prose)), "doc_id long, text string").repartition(4)
