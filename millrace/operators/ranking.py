"""Hottest and coldest days. Ties go to the earlier date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(value: str, date: str, hottest: bool):
    first = F.col(value).desc_nulls_last() if hottest else F.col(value).asc_nulls_last()
    return [first, F.col(date).asc()]


def top_days(
    daily: DataFrame, n: int = 5, value: str = "temp", date: str = "noted_date", hottest: bool = True
) -> DataFrame:
    return daily.orderBy(*_order(value, date, hottest)).limit(n)


def ranked_days(
    summary: DataFrame,
    kind: str,
    n: int = 5,
    value: str = "avg_temp",
    date: str = "date",
) -> DataFrame:
    """The top ``n`` days of one kind, numbered from 1.

    Limiting first keeps the global numbering to ``n`` rows.
    """
    hottest = kind == "hot"
    place = F.row_number().over(Window.orderBy(*_order("temperature", "date", hottest)))
    return (
        top_days(summary, n, value, date, hottest)
        .select(F.col(date).alias("date"), F.col(value).alias("temperature"))
        .select("date", "temperature", F.lit(kind).alias("type"), place.alias("rank"))
    )


def temperature_extremes(summary: DataFrame, n: int = 5, **names: str) -> DataFrame:
    """Hot days, then cold days, of a daily summary."""
    return ranked_days(summary, "hot", n, **names).unionByName(
        ranked_days(summary, "cold", n, **names)
    )


def extremes_of_type(extremes: DataFrame, kind: str) -> DataFrame:
    return extremes.where(F.col("type") == kind).orderBy("rank").select("date", "temperature")
