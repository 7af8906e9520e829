"""Profiling and load checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, row count and NULL count. One pass."""
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    described = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("rows").alias("row_count"),
                F.col(f"`{f.name}`").alias("null_count"),
            )
            for f in df.schema.fields
        ]
    )
    return counts.select(F.inline(described))


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def load_quality(
    df: DataFrame,
    key: Sequence[str] = ("noted_date", "device_id"),
    date: str = "noted_date",
    device: str = "device_id",
) -> DataFrame:
    """Row, day, device and duplicate-key counts of a loaded table, one row.

    Rows are counted per key once; everything else is computed from those
    counts, whose shuffle both aggregates read. Days are counted apart: two distinct
    counts in one aggregate would copy every row for each of them.
    """
    columns = list(dict.fromkeys([*key, date, device]))
    per_key = df.groupBy(*columns).agg(F.count("*").alias("_rows"))
    if len(columns) == len(key):
        repeated = F.count_if(F.col("_rows") > 1)
    else:  # date or device is not part of the key: merge counts per key
        whole = Window.partitionBy(*key)
        per_key = per_key.withColumns(
            {"_total": F.sum("_rows").over(whole), "_place": F.row_number().over(whole.orderBy(*columns))}
        )
        repeated = F.count_if((F.col("_total") > 1) & (F.col("_place") == 1))
    days = per_key.groupBy(F.to_date(date).alias("day")).agg(F.lit(1).alias("one"))
    counted = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        F.count_distinct(F.col(device)).alias("devices"),
        repeated.alias("duplicate_keys"),
    )
    days = days.agg(F.count("day").alias("days")).scalar()
    return counted.select("total_rows", days.alias("days"), "devices", "duplicate_keys")
