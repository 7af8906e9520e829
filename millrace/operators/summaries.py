"""Grouped and global statistics of readings. Each is one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_mean(df: DataFrame, date: str = "noted_date", value: str = "temp") -> DataFrame:
    return df.groupBy(date).agg(F.avg(value).alias(value))


def daily_summary(df: DataFrame, date: str = "noted_date", value: str = "temp") -> DataFrame:
    return df.groupBy(F.to_date(date).alias("date")).agg(
        F.avg(value).alias("avg_temp"),
        F.min(value).alias("min_temp"),
        F.max(value).alias("max_temp"),
        F.count("*").alias("record_count"),
    )


def value_stats(value: str) -> list[Column]:
    return [
        F.avg(value).alias("avg_temp"),
        F.min(value).alias("min_temp"),
        F.max(value).alias("max_temp"),
    ]


def table_stats(df: DataFrame, date: str = "noted_date", value: str = "temp") -> DataFrame:
    """Rows, days, first and last date, and value statistics of a whole table.

    Grouping by day first keeps the distinct-day count off the raw rows.
    """
    daily = df.groupBy(F.to_date(date).alias("_day")).agg(
        F.count("*").alias("_rows"),
        F.min(date).alias("_first"),
        F.max(date).alias("_last"),
        F.sum(value).alias("_sum"),
        F.count(value).alias("_values"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    )
    return daily.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_records"),
        F.count("_day").alias("total_days"),
        F.min("_first").alias("first_date"),
        F.max("_last").alias("last_date"),
        (F.sum("_sum") / F.nullif(F.sum("_values"), F.lit(0))).alias("avg_temp"),
        F.min("_min").alias("min_temp"),
        F.max("_max").alias("max_temp"),
    )


def load_stats(
    df: DataFrame,
    date: str = "noted_date",
    device: str = "device_id",
    value: str = "temperature",
    approximate: bool = False,
) -> DataFrame:
    """Period, devices and mean of a loaded table."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        count(F.col(device)).alias("device_count"),
        F.avg(value).alias("avg_temperature"),
    )


def batch_rows(df: DataFrame, batch_id: str | None) -> DataFrame:
    return df if batch_id is None else df.where(F.col("batch_id") == batch_id)


def batch_days(
    df: DataFrame, batch_id: str | None = None, newest: int = 5, date: str = "noted_date"
) -> DataFrame:
    """Rows per day of one batch, newest days first."""
    return (
        batch_rows(df, batch_id)
        .groupBy(F.to_date(date).alias("load_date"))
        .agg(F.count("*").alias("records"))
        .orderBy(F.desc("load_date"))
        .limit(newest)
    )


def batch_stats(
    df: DataFrame, batch_id: str | None = None, value: str = "temperature"
) -> DataFrame:
    return batch_rows(df, batch_id).agg(*value_stats(value))


def day_span(df: DataFrame, date: str = "noted_date") -> DataFrame:
    """How many days a batch covers, and the first and last of them."""
    day = F.to_date(date)
    return df.agg(
        F.count_distinct(day).alias("days"), F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )


def date_range(df: DataFrame, date: str = "noted_date") -> DataFrame:
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def first_seen_values(df: DataFrame, column: str, order: str, n: int = 10) -> DataFrame:
    """The first ``n`` distinct values of a column in source order."""
    return (
        df.groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.min(order).alias("_first"))
        .orderBy("_first")
        .limit(n)
        .select("value")
    )
