"""Quality classifier: random-indexing word vectors and a two-layer network.

*Words* are runs of letters (and all characters from U+0080 on), of digits, or
of other visible characters, of the whole text; each falls into one of
``buckets`` hash buckets.

*Random indexing.*  Every bucket has a fixed sparse random index vector.  A
bucket's context vector is the sum of the index vectors of the words next to it
in the training texts, scaled to length one.

*Pooling.*  A document is the mean of its words' index and context vectors,
the lengths of both means (repeated words make them long), the mean likeness of
neighbouring words and the logarithm of the word count.

*Network.*  One hidden layer (tanh) and a logistic output in numpy, by Adam on
the training rows; part of them is set aside to fit the temperature that
calibrates the probabilities.

*Training rows* are at most ``train_rows`` labelled rows (those with the least
hash of their id, of all that are not held out, and of rows with one id the text
with the least hash), so what is learned from and what is broadcast (sample ids,
vectors, weights) is bounded, whatever the table size.  Only their texts are
selected from the table; an aggregate, which combines map-side, leaves one of
each id.  Only pooled vectors reach the driver.  Scoring is one pass over all rows.

Defined cases: null and empty texts have no words, a zero vector and the score
that the network gives it; null ids count as held out; ids labelled in two ways
are not learned from; repeated label rows count once; without labels of both
classes every score is the share of label 1 (0.5 without labels); an empty
table gives an empty result.  No other column is an input.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.common import map_texts, prepare, slices, stored

TRAIN_ROWS = 20_000
BUCKETS, DIM, NONZERO = 1 << 15, 32, 4
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 30, 128, 3e-3, 1e-4
#: Files of the stored sample.
SAMPLE_PARTS = 8

_WORDS = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[!-/:-@\[-`{-~]+").findall


def held_out(key: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(True))


def word_buckets(text: bytes) -> np.ndarray:
    words = _WORDS(text)
    return np.fromiter(map(crc32, words), dtype=np.int64, count=len(words)) & (BUCKETS - 1)


def index_vectors() -> np.ndarray:
    """The fixed sparse random vector (length one) of each bucket."""
    rng = np.random.default_rng(7)
    out = np.zeros((BUCKETS, DIM), dtype=np.float32)
    rows = np.arange(BUCKETS)
    for _ in range(NONZERO):
        out[rows, rng.integers(0, DIM, BUCKETS)] += rng.choice([-1.0, 1.0], BUCKETS)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)


def contexts(docs: list[np.ndarray], index: np.ndarray) -> np.ndarray:
    """Sums of the neighbours' index vectors by bucket."""
    out = np.zeros((BUCKETS, DIM), dtype=np.float32)
    pairs = [(d[:-1], d[1:]) for d in docs if len(d) > 1]
    if pairs:
        a, b = (np.concatenate(side) for side in zip(*pairs))
        for here, there in ((a, b), (b, a)):
            order = np.argsort(here, kind="stable")
            here, there = here[order], there[order]
            first = np.flatnonzero(np.r_[True, here[1:] != here[:-1]])
            out[here[first]] += np.add.reduceat(index[there], first, axis=0)
    return out


def pooled(docs: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    """Features of each document; ``vectors`` holds index and context side by side."""
    out = np.zeros((len(docs), 2 * DIM + 4), dtype=np.float32)
    for row, words in zip(out, docs):
        n = len(words)
        if n:
            v = vectors[words]
            row[:2 * DIM] = v.mean(axis=0)
            row[2 * DIM] = np.linalg.norm(row[:DIM])
            row[2 * DIM + 1] = np.linalg.norm(row[DIM:2 * DIM])
            row[2 * DIM + 2] = np.einsum("ij,ij->", v[1:, :DIM], v[:-1, :DIM]) / max(1, n - 1)
            row[2 * DIM + 3] = np.log1p(n)
    return out


class Network:
    """Two layers with scaled inputs and a temperature."""

    def __init__(self, inputs: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.scale, self.temperature = np.zeros(inputs), np.ones(inputs), 1.0
        self.p = [rng.normal(0, inputs ** -0.5, (inputs, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self._forward((x - self.mean) / self.scale)[1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)

    def _forward(self, x):
        hidden = np.tanh(x @ self.p[0] + self.p[1])
        return hidden, hidden @ self.p[2] + self.p[3][0]

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 5) -> None:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        rng = np.random.default_rng(seed)
        first, second = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p]
        step = 0
        for _ in range(EPOCHS):
            for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
                hidden, z = self._forward(x[rows])
                d = (_sigmoid(z) - y[rows]) / len(rows)
                back = np.outer(d, self.p[2]) * (1 - hidden ** 2)
                grads = [x[rows].T @ back + DECAY * self.p[0], back.sum(axis=0), hidden.T @ d + DECAY * self.p[2], d.sum(keepdims=True)]
                step += 1
                for p, g, m, v in zip(self.p, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss on rows that were not fitted."""
        z, signs = self.logits(x), 2 * y - 1
        grid = np.exp(np.linspace(np.log(0.2), np.log(10), 200))
        self.temperature = float(grid[np.argmin([np.logaddexp(0, -signs * z / t).mean() for t in grid])])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class Constant:
    """Score where there is nothing to learn from."""

    def __init__(self, score: float):
        self.score = score

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.score)


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """Texts and labels of the training rows, stored in a few files."""
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col(key), folds, fold))
    known = known.groupBy(F.col(key).alias("__id")).agg(F.min(label).alias("__lo"), F.max(label).alias("__y"))
    known = known.filter("__lo = __y").orderBy(F.xxhash64("__id"), "__id").limit(rows)
    known = known.select("__id", F.col("__y").cast("int").alias("__y"))
    # Bounded by `rows`: 12 bytes each.
    known = F.broadcast(stored(known, "quality-ids"))
    chosen = docs.join(known, docs[key] == known["__id"], "inner")
    # One row of each id, so that `rows` bounds the rows too.
    least = F.min(F.struct(F.xxhash64(docs[text]).alias("hash"), docs[text].alias("body")))
    chosen = chosen.groupBy("__id", "__y").agg(least.alias("__least"))
    return stored(chosen.select("__id", "__y", F.col("__least.body").alias("__body")).repartition(SAMPLE_PARTS, "__id"), "quality-sample")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          folds: int = 5, fold: int = 0, train_rows: int = TRAIN_ROWS) -> tuple[Network | Constant, np.ndarray]:
    """The network and the word vectors, from at most ``train_rows`` labelled rows."""
    spark = docs.sparkSession
    prepare(spark)
    sample = _sample(docs, labels, key, text, label, folds, fold, train_rows)
    index = index_vectors()

    names = [f"v{i}" for i in range(DIM)]

    def sums(batches):
        """One row per bucket that this task has seen next to a word."""
        total = np.zeros((BUCKETS, DIM), dtype=np.float32)
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                total += contexts([word_buckets(t) for t in texts], index)
        seen = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(seen), *[pa.array(v) for v in total[seen].T]], ["bucket", *names])

    parts = sample.select("__body").mapInArrow(sums, "bucket long, " + ", ".join(f"{n} float" for n in names))
    added = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toArrow()  # BUCKETS rows at most
    total = np.zeros((BUCKETS, DIM), dtype=np.float32)
    total[added["bucket"].to_numpy()] = np.stack([added[n].to_numpy() for n in names], axis=1)
    total /= np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-6)
    vectors = np.hstack([index, total])

    shared = spark.sparkContext.broadcast(vectors)

    def make():
        return lambda texts: [list(pooled([word_buckets(t) for t in texts], shared.value))]

    field = T.StructField("x", T.ArrayType(T.FloatType()))
    rows = map_texts(sample, "__body", ["__id", "__y"], [field], make).collect()
    rows.sort(key=lambda r: (crc32(str(r[0]).encode()), r[0]))
    y = np.array([r[1] for r in rows], dtype=np.float64)
    if len(np.unique(y)) < 2:
        return Constant(float(y.mean()) if len(y) else 0.5), vectors
    x = np.array([r[2] for r in rows], dtype=np.float64)
    aside = np.arange(len(y)) % 5 == 0
    network = Network(x.shape[1])
    network.fit(x[~aside], y[~aside])
    network.calibrate(x[aside], y[aside])
    return network, vectors


def classify(docs: DataFrame, model: Network | Constant, vectors: np.ndarray, key: str = "doc_id", text: str = "text",
             threshold: float = 0.3, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (``key`` by default) of every row, score and predicted (1: score >= threshold).

    A kept column named like one of these gives way to it.
    """
    keep = [c for c in keep or [key] if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast((model, vectors))

    def make():
        network, words = shared.value
        return lambda texts: [network.scores(pooled([word_buckets(t) for t in texts], words).astype(np.float64)).tolist()]

    scored = map_texts(docs, text, keep, [T.StructField("score", T.DoubleType())], make)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
