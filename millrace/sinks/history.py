"""Load history: one appended row per state change, read back per batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import error_text
from millrace.operators.dedupe import keep_last
from millrace.sinks.tables import TableSpec, append, read, replace_all

HISTORY = TableSpec(
    name="load_history",
    ddl=(
        "load_type STRING, batch_id STRING, start_date TIMESTAMP, end_date TIMESTAMP, "
        "records_loaded BIGINT, load_status STRING, error_message STRING, "
        "created_at TIMESTAMP, changed_at TIMESTAMP"
    ),
    required=("batch_id",),
)

# The outcomes a batch can end with.
STARTED, SUCCESS, PARTIAL, FAILED = "started", "success", "partial", "failed"
NO_DATA, NO_VALID_DATA = "no_data", "no_valid_data"
NO_DATE, NO_DATE_COLUMN = "failed_no_date", "failed_no_date_col"


def batch_name(kind: str, at: dt.datetime) -> str:
    """``full_...`` or ``inc_...`` with the start time."""
    return f"{kind}_{at:%Y%m%d_%H%M%S}"


def outcome(newest, in_window, valid, errors) -> Column:
    """Status of a batch from its newest date and row counts."""
    def count(value) -> Column:
        return F.col(value) if isinstance(value, str) else value

    newest = F.col(newest) if isinstance(newest, str) else newest
    return (
        F.when(newest.isNull(), NO_DATE)
        .when(count(in_window) == 0, NO_DATA)
        .when(count(valid) == 0, NO_VALID_DATA)
        .when(count(errors) > 0, PARTIAL)
        .otherwise(SUCCESS)
    )


def record(
    spark: SparkSession,
    spec: TableSpec,
    kind: str,
    batch_id: str,
    status: str,
    started: dt.datetime,
    rows: int | None = None,
    error: str | None = None,
) -> None:
    """Append the batch's new state. The start time stays that of the batch."""
    ended = status != STARTED
    line = spark.range(1).select(
        F.lit(kind).alias("load_type"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(started).alias("start_date"),
        (F.current_timestamp() if ended else F.lit(None)).alias("end_date"),
        F.lit(rows).alias("records_loaded"),
        F.lit(status).alias("load_status"),
        error_text(F.lit(error).cast("string")).alias("error_message"),
        F.lit(started).alias("created_at"),
        F.current_timestamp().alias("changed_at"),
    )
    append(line.coalesce(1), spec)


def current_state(history: DataFrame, order=("changed_at", "end_date")) -> DataFrame:
    """Latest state of every batch."""
    return keep_last(history, "batch_id", list(order)).drop("changed_at")


def latest_loads(batches: DataFrame, n: int = 1, kind: str | None = None) -> DataFrame:
    """The newest ``n`` batches, of any kind or of one."""
    if kind is not None:
        batches = batches.where(F.col("load_type") == kind)
    return batches.orderBy(F.desc("created_at"), F.desc("batch_id")).limit(n)


def batches(spark: SparkSession, spec: TableSpec = HISTORY) -> DataFrame:
    return current_state(read(spark, spec))


def compact(spark: SparkSession, spec: TableSpec = HISTORY) -> None:
    """Rewrite the history with the latest state of every batch; call it when no load runs."""
    latest = keep_last(read(spark, spec), "batch_id", ["changed_at", "end_date"])
    replace_all(latest.coalesce(1), spec)
