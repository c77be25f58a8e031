"""Corpus pipeline: from raw documents to encoded, clean, distinct ones.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and calls one operator of
:mod:`claimwright.llm` on all rows it is given.  Stages that filter return the
columns of ``docs``; the last one returns the encoded documents' digests.
Between stages the rows are written as Parquet and read again.

Defined cases: rows without an id, and rows that share one, are judged by their
text like any other; of near copies the smallest id stays, a row without id only
if none has one; documents may have further columns under any name (inside a
stage columns are known by their position and carried in one struct, so no name
can clash with a stage's or an operator's, and none has to be quoted).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.llm import decontaminate as decontamination
from claimwright.llm import exact_dedup as exact
from claimwright.llm import quality, simhash
from claimwright.llm.common import stored
from claimwright.llm.queries import coded_digests


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class _Rows:
    """Documents with their columns by position: ``doc`` is the whole row, beside its id and text."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        places = [f"c{i}" for i in range(len(self.names))]
        key, text = (places[self.names.index(name)] for name in ("doc_id", "text"))
        self.rows = docs.toDF(*places).select(F.struct(*places).alias("doc"), F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def texts(self) -> DataFrame:
        return self.rows.select("doc_id", "text")

    def restored(self, rows: DataFrame) -> DataFrame:
        """The documents of rows that have ``doc``, under their own names."""
        return rows.select("doc.*").toDF(*self.names)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on these documents' labels, does not reject."""
    own = _Rows(docs)
    model, vectors = quality.train(own.texts(), _table(spark, sf_dir, "labels"))
    scored = quality.classify(own.rows, model, vectors, text="text", keep=["doc"])
    return own.restored(scored.filter("predicted = 1"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the row that exact de-duplication keeps."""
    own = _Rows(docs)
    named = stored(exact.exact_dedup(own.texts()), "pipeline-copies")
    kept = named.filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    rows = own.rows.select("doc", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    # By id and digest: copies of a text are spread by their ids.
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["kept_id"]) & (rows["sha"] == kept["kept_sha"]), "left_semi")
    if not named.groupBy("doc_id", "text_sha256").count().filter("count > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "sha"])  # rows repeated as a whole
    return own.restored(rows)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component: the one with the smallest id, null last; the first of equal ids."""
    own = _Rows(docs)
    # Rows are told apart by a number, not by their id; stored, so that it stays the same.
    rows = stored(own.rows.withColumn("row", F.monotonically_increasing_id()), "pipeline-numbered")
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    near = simhash.simhash_dedup(rows.select(name.alias("name"), "text"), key="name", text="text", shingle=3, max_distance=2)
    gone = stored(near.filter(F.col("name.row") != F.col("component_id.row")).select(F.col("name.row").alias("gone")),
                  "pipeline-near-copies")
    return own.restored(rows.join(gone, rows["row"] == gone["gone"], "left_anti"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less of the benchmark's windows than the contamination rule asks for."""
    own = _Rows(docs)
    found = decontamination.decontaminate(own.rows, _table(spark, sf_dir, "benchmark"), text="text", keep=["doc"])
    return own.restored(found.filter(~F.col("contaminated")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text."""
    return coded_digests(_Rows(docs).texts())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("encode", encode),
]

#: Classifier scores, XXH64 fingerprints and subword ids are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
