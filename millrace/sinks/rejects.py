"""Rows a table refuses: kept with their reason, counted in the load's own pass."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.session import remove, shared_dir
from millrace.sinks.tables import TableSpec, append, create, with_reason

REJECTS = TableSpec(
    name="load_rejects",
    ddl="load_type STRING, batch_id STRING, table_name STRING, reason STRING, record STRING, rejected_at TIMESTAMP",
    required=("batch_id", "reason"),
    defaults={"rejected_at": "current_timestamp()"},
)


@dataclass(frozen=True)
class Screened:
    """A batch on shared files: the rows its table takes, those it refuses, and how many there are."""

    taken: DataFrame
    refused: DataFrame
    rows: int
    errors: int


@contextmanager
def screened(df: DataFrame, spec: TableSpec, label: str = "batch") -> Iterator[Screened]:
    """Write ``df`` once, refused rows apart, and count both while they are written.

    The files are removed after the block, also on failure.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, label)
    counts = Observation()
    rows = with_reason(df, spec).observe(
        counts, F.count(F.lit(1)).alias("rows"), F.count("_reason").alias("errors")
    )
    stored = rows.withColumn("_refused", F.col("_reason").isNotNull())
    try:
        stored.write.partitionBy("_refused").parquet(path)
        back = spark.read.schema(stored.schema).parquet(path)
        yield Screened(
            back.where("NOT _refused").drop("_reason", "_refused"),
            back.where("_refused").drop("_refused"),
            counts.get["rows"],
            counts.get["errors"],
        )
    finally:
        remove(spark, path)


def keep_rejects(
    spark: SparkSession, refused: DataFrame, kind: str, batch_id: str, table: TableSpec, rejects: TableSpec = REJECTS
) -> None:
    """Append refused rows as JSON texts with their reason."""
    create(spark, rejects)
    values = [F.col(f"`{c}`") for c in refused.columns if c != "_reason"]
    lines = refused.select(
        F.lit(kind).alias("load_type"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(table.name.rsplit(".", 1)[-1]).alias("table_name"),
        F.col("_reason").alias("reason"),
        F.to_json(F.struct(*values), {"ignoreNullFields": "false"}).alias("record"),
    )
    append(lines, rejects)
