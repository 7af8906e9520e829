"""Helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import materialize, shared_dir

__all__ = [
    "BATCH_BYTES",
    "appended",
    "clean_text",
    "materialize",
    "shared_dir",
    "slices",
    "small_batches",
    "table",
    "text_bytes",
]

BATCH_BYTES = 8 * 1024 * 1024  # text that a Python worker handles at a time


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; from now on its session hands workers batches of about ``BATCH_BYTES``.

    Spark's own bound is 64 MB, which each task holds in the JVM and again in its
    worker, and both keep the room. A bound that the session was given stays. Only
    sizes depend on it, no results.
    """
    name, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if name not in conf.getAll:
        conf.set(name, str(BATCH_BYTES))
    return df


def clean_text(name: str = "text") -> Column:
    """The column as text, NULL as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_bytes(value) -> bytes:
    """UTF-8 bytes of an Arrow string or binary scalar; NULL is empty."""
    if value is None or not value.is_valid:
        return b""
    return value.as_buffer().to_pybytes()


def slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``BATCH_BYTES`` of ``column``, one row at least."""
    for batch in batches:
        start, size = 0, 0
        values = batch.column(column)
        for i in range(batch.num_rows):
            size += len(values[i].as_buffer()) if values[i].is_valid else 0
            if size >= BATCH_BYTES:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def appended(
    df: DataFrame,
    column: str,
    added: list[T.StructField],
    work: Callable[[], Callable],
    without: Iterable[str] = (),
) -> DataFrame:
    """``df`` with columns computed from the text ``column`` by Arrow batches.

    ``work()`` runs once in each task and returns a function from a list of
    byte strings (NULL is empty) to one sequence for each added column. Columns
    of ``df`` with an added column's name are replaced; ``without`` leaves out more.
    """
    names = {f.name.lower() for f in added} | {c.lower() for c in without}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    source = "__text"
    df = df.select(
        *[F.col(f"`{f.name}`") for f in kept],
        F.encode(clean_text(f"`{column}`"), "UTF-8").alias(source),
    )
    schema = T.StructType([*kept, *added])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in added]
        act = work()
        for batch in slices(batches, source):
            texts = [text_bytes(v) for v in batch.column(source)]
            made = act(texts)
            arrays = [batch.column(f.name) for f in kept]
            arrays += [pa.array(v, t) for v, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)
