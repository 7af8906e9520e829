"""Warehouse tables and plain Parquet tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def existing_tables(spark: SparkSession, names: Iterable[str]) -> list[str]:
    """Those of ``names`` the catalog knows, in the order asked."""
    return [n for n in names if spark.catalog.tableExists(n)]
