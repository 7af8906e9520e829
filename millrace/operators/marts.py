"""Analytics marts for one run date (or, without one, for all days)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.coerce import length_or_zero

OPEN_STATUSES = ("open", "in_progress")


def _money_like(total: Column, count: Column) -> Column:
    """An average rounded half-up to NUMERIC(12,2), from an exact integer sum."""
    exact = total.cast("decimal(20,0)") / F.nullif(count, F.lit(0)).cast("decimal(20,0)")
    return exact.cast("decimal(12,2)")


def user_activity(
    sessions: DataFrame, run_date: dt.date | None = None, grain: str = "page"
) -> DataFrame:
    """Per day and user: sessions, mean duration, actions, distinct pages.

    ``grain="page"`` counts what the mart's SQL counts: its lateral join repeats
    a session once per visited page before aggregating, so counts, actions and
    the mean are weighted by pages. ``grain="session"`` takes those three from
    one row per session. Either way pages are expanded once and the distinct
    count is pre-aggregated per (day, user, page), so a very active user is
    spread over pages before its final row is formed.
    """
    if grain not in ("page", "session"):
        raise ValueError(f"unknown grain {grain!r}")
    day = F.to_date("start_time")
    if run_date is not None:
        sessions = sessions.where(day == F.lit(run_date))
    visits = sessions.select(
        day.alias("activity_date"),
        "user_id",
        F.col("session_duration_seconds").alias("_seconds"),
        length_or_zero("actions").alias("_actions"),
        F.posexplode_outer("pages_visited").alias("_pos", "_page"),
    )
    counted = F.lit(True) if grain == "page" else F.coalesce(F.col("_pos"), F.lit(0)) == 0
    seconds = F.when(counted, F.col("_seconds"))
    return visits.groupBy("activity_date", "user_id").agg(
        F.count(F.when(counted, 1)).alias("sessions_count"),
        _money_like(F.sum(seconds), F.count(seconds)).alias("avg_session_duration_seconds"),
        F.sum(F.when(counted, F.col("_actions")).otherwise(0)).alias("total_actions"),
        F.count_distinct("_page").alias("unique_pages_visited"),
    )


def support_efficiency(tickets: DataFrame, run_date: dt.date) -> DataFrame:
    """Per issue type and status, over tickets created up to ``run_date``.

    Statuses are the current ones, so an old run date is not a historical view.
    """
    seconds = F.col("resolution_time_seconds")
    hours = _money_like(F.sum(seconds), F.count(seconds) * F.lit(3600))
    is_open = F.col("status").isin(*OPEN_STATUSES)
    return (
        tickets.where(F.to_date("created_at") <= F.lit(run_date))
        .groupBy("issue_type", "status")
        .agg(
            F.count("*").alias("tickets_count"),
            hours.alias("avg_resolution_time_hours"),
            F.sum(F.when(is_open, 1).otherwise(0)).alias("open_tickets_count"),
        )
        .select(F.lit(run_date).alias("snapshot_date"), "*")
    )
