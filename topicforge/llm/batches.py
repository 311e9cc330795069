"""Shared plumbing of the training-data operators: the rows an operator reads, and Arrow mapping.

Every operator takes ``docs`` (any DataFrame with an id and a text column; other columns, whatever
their names, are not read) and works on whole texts.  A null text is an empty text.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, as (doc_id bigint, text string); null text becomes ''."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, with underscores before them until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver found it: once for each Spark
    context, through Spark's own distribution of Python files."""
    sc = spark.sparkContext
    if getattr(sc, "_topicforge_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(sc._temp_dir, "topicforge_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._topicforge_shipped = True


def _trim() -> None:
    """Hand the C allocator's free pages back to the system, where it can."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


#: Rows of an Arrow batch.  Rows here are whole texts and sets; Spark's default of 10,000 would hold some
#: hundred MB at a time in the executor and again in its Python worker.
BATCH_ROWS = 1024


def small_batches(spark: SparkSession | None = None) -> None:
    """Lower the (else: active) session's Arrow batch size to ``BATCH_ROWS`` if it is larger or without bound;
    that changes no result."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if now > BATCH_ROWS or now <= 0:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` by a function of this package.  Lowers the session's Arrow batch size to
    ``BATCH_ROWS`` if it is larger (that changes no result), and has a worker give free memory back when a
    task is done."""
    spark = df.sparkSession
    ship_package(spark)
    small_batches(spark)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            _trim()

    return df.mapInArrow(task, schema)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema, most: int = 2 << 20) -> DataFrame:
    """Arrow mapping with a function of one record batch of about ``most`` bytes; ``None`` or an empty batch gives no rows.
    ``fn`` may be a zero-argument factory marked by ``per_task``: it is then called once in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = fn() if getattr(fn, "per_task", False) else fn
        for b in batches:
            for part in slices(b, most):
                out = each(part)
                if out is not None and out.num_rows:
                    yield out

    return map_arrow(df, run, schema)


def slices(batch: pa.RecordBatch, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes: as Python objects a batch would take many times
    its size."""
    rows = max(1, int(most * batch.num_rows / max(batch.nbytes, 1)))
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def per_task(factory):
    factory.per_task = True
    return factory


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
