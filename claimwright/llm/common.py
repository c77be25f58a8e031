"""Helpers shared by the text operators.

Texts reach Python only as Arrow batches, are read as UTF-8 bytes and are
worked off in slices of bounded size, so a batch of long texts does not grow
a worker.  Intermediate tables go to the shared folder of the session
(:func:`stored`), never to a machine-local one.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimwright.operators.materialize import materialize

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Bytes of text worked on at once by the batch functions.
SLICE_BYTES = 2 << 20
#: Rows and bytes of one Arrow batch: bounds what a Python worker holds.
BATCH_ROWS, BATCH_BYTES = 2000, "32m"


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package, and keep Arrow batches small."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage)."""
    return materialize(df, f"llm-{name}")


def slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, UTF-8 texts) of consecutive rows with about ``max_bytes``; null is empty."""
    first, size, out = 0, 0, []
    for i, value in enumerate(texts.cast(pa.large_binary())):
        text = value.as_py() or b""
        if out and size + len(text) > max_bytes:
            yield first, out
            first, size, out = i, 0, []
        out.append(text)
        size += len(text)
    if out:
        yield first, out


def map_texts(df: DataFrame, text: str, keep: list[str], fields: list[T.StructField],
              make: Callable[[], Callable[..., list[list]]], with_column: str | None = None,
              slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``keep`` columns plus the columns ``fields`` computed from each text.

    ``make()`` runs once per task and returns the function that turns a list
    of texts into one list (or Arrow array) of values per field; ``with_column`` names an array
    column whose values it gets too.  ``slice_bytes`` of text make one list.  Rows stay in place: no shuffle.  ``text``
    is dropped from the result unless it is in ``keep``.
    """
    prepare(df.sparkSession)
    kept = [df.schema[c] for c in keep]
    schema = T.StructType([*kept, *fields])
    arrow = to_arrow_schema(schema)
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for first, texts in slices(batch.column(n_keep), slice_bytes):
                more = []
                if with_column:
                    column = batch.column(n_keep + 1).slice(first, len(texts))
                    more = [[v.values.to_numpy(zero_copy_only=False) for v in column]]
                made = fn(texts, *more)
                cols = [batch.column(i).slice(first, len(texts)).cast(arrow.field(i).type) for i in range(n_keep)]
                cols += [v.cast(arrow.field(n_keep + i).type) if isinstance(v, pa.Array) else pa.array(v, type=arrow.field(n_keep + i).type)
                         for i, v in enumerate(made)]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    inputs = [df[c] for c in keep] + [df[text].alias("__text")]
    if with_column:
        inputs.append(df[with_column].alias("__with"))
    return df.select(*inputs).mapInArrow(run, schema)
