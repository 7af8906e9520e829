"""Rows of the last N days, counted back from the newest row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def effective_days(days: int, cap_days: int | None = None) -> int:
    """``days`` under an upper bound set by an earlier preparation step."""
    return days if cap_days is None else min(days, cap_days)


def last_n_days(
    df: DataFrame,
    days: int,
    column: str = "noted_date",
    cap_days: int | None = None,
    newest: dt.datetime | None = None,
) -> DataFrame:
    """Rows at or after the newest timestamp minus ``days``.

    Unless the newest timestamp is known, the cutoff is a scalar subquery that
    reads one column. Either way a Parquet scan gets a plain comparison.
    """
    days = effective_days(days, cap_days)
    if newest is not None:
        return df.where(F.col(column) >= F.lit(newest - dt.timedelta(days=days)))
    cutoff = df.agg((F.max(column) - F.make_dt_interval(days=F.lit(days))).alias("_cutoff"))
    return df.where(F.col(column) >= cutoff.scalar())
