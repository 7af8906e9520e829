"""Mart tables and their daily slices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from millrace.operators.marts import support_efficiency, user_activity
from millrace.plans.replication import SESSIONS, TICKETS
from millrace.sinks.tables import TableSpec, create, read, replace_slice

# Counts are BIGINT: at scale a single group can pass the range of INT.
ACTIVITY = TableSpec(
    name="marts.user_activity_mart",
    ddl=(
        "user_id STRING, sessions_count BIGINT, avg_session_duration_seconds DECIMAL(12,2), "
        "total_actions BIGINT, unique_pages_visited BIGINT, activity_date DATE"
    ),
    key=("activity_date", "user_id"),
    required=("sessions_count",),
    partition="activity_date",
)
SUPPORT = TableSpec(
    name="marts.support_efficiency_mart",
    ddl=(
        "issue_type STRING, status STRING, tickets_count BIGINT, "
        "avg_resolution_time_hours DECIMAL(12,2), open_tickets_count BIGINT, snapshot_date DATE"
    ),
    key=("snapshot_date", "issue_type", "status"),
    required=("tickets_count",),
    partition="snapshot_date",
)


def build_user_activity(
    spark: SparkSession,
    run_date: dt.date,
    sessions: TableSpec = SESSIONS.table,
    mart: TableSpec = ACTIVITY,
    grain: str = "page",
) -> None:
    create(spark, mart)
    replace_slice(user_activity(read(spark, sessions), run_date, grain), mart, run_date)


def build_support_efficiency(
    spark: SparkSession,
    run_date: dt.date,
    tickets: TableSpec = TICKETS.table,
    mart: TableSpec = SUPPORT,
) -> None:
    create(spark, mart)
    replace_slice(support_efficiency(read(spark, tickets), run_date), mart, run_date)


def build_marts(spark: SparkSession, run_date: dt.date, grain: str = "page") -> None:
    """Replace the slices of ``run_date`` in both marts; a repeated run changes nothing."""
    build_user_activity(spark, run_date, grain=grain)
    build_support_efficiency(spark, run_date)
