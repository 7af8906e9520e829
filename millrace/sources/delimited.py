"""Delimited files. Columns are read as text and coerced afterwards, or typed by their cells."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.infer import inferred_types, with_types
from millrace.sources.position import source_position

# Cell texts that mean "missing" (the pandas reader's defaults).
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def read_delimited(
    spark: SparkSession,
    path: str,
    missing: Iterable[str] = MISSING,
    order: str | None = None,
    infer: bool = False,
    **options,
) -> DataFrame:
    """All ``*.csv`` files at or below ``path`` as text columns.

    Without ``inferSchema`` Spark types every header column as STRING, so the
    schema never depends on the data. ``infer`` reads all cells first and gives each
    column the least type that holds them. ``order`` adds the source position.

    A quote inside a quoted cell is written twice. Columns are taken in the order
    of the first file's header; a file with another header fails the job rather
    than fill the wrong columns. Cells with line breaks need ``multiLine=True``,
    which reads each file in one task and is therefore left to the caller.
    """
    raw = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .options(**options)
        .csv(path)
    )
    missing = list(missing)
    cells = [F.when(~F.col(f"`{c}`").isin(missing), F.col(f"`{c}`")).alias(c) for c in raw.columns]
    read = raw.select(*cells, *([source_position().alias(order)] if order else []))
    return with_types(read, inferred_types(read, raw.columns)) if infer else read


def write_delimited(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV files as ``read_delimited`` reads them: a quote in a cell is written twice."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)
