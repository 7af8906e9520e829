"""Full and incremental loads of readings, with a load history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.coerce import READING_FORMAT, drop_bad_dates, to_number
from millrace.functions.headers import canonical_for_load, standardise
from millrace.functions.identity import device_id_full, device_id_incremental, location
from millrace.operators.dedupe import keep_last
from millrace.operators.profile import load_quality
from millrace.operators.recent import last_n_days
from millrace.operators.summaries import (
    batch_days,
    batch_rows,
    batch_stats,
    day_span,
    load_stats,
    table_stats,
)
from millrace.session import shuffles_sized_for
from millrace.sinks import history as log
from millrace.sinks.rejects import REJECTS, keep_rejects, screened
from millrace.sinks.tables import TableSpec, create, read, replace_all, upsert_partitions
from millrace.sources.position import with_row_number

READING_DDL = (
    "noted_date TIMESTAMP_NTZ, temperature DOUBLE, location STRING, device_id STRING, "
    "load_timestamp TIMESTAMP, batch_id STRING"
)
LOADED_NOW = {"load_timestamp": "current_timestamp()"}

FULL = TableSpec(name="temperature_full", ddl=READING_DDL, defaults=LOADED_NOW)

# Partitioned by day: the day follows from the key, so an upsert rewrites only
# the days in the batch.
INCREMENTAL = TableSpec(
    name="temperature_incremental",
    ddl=f"{READING_DDL}, noted_day DATE",
    key=("noted_date", "device_id"),
    defaults=LOADED_NOW,
    partition="noted_day",
    partition_from="to_date(noted_date)",
    sort_within=("noted_day", "noted_date"),
)

POSITION = "_ord"  # source position, as the readers add it

# Run parameters where neither the run nor the job sets them.
DEFAULT_PARAMETERS = {"last_n_days": 7}
# The preparation step's own cut, an upper bound on last_n_days.
PREPARED_DAYS = 7


def run_parameters(
    run: Mapping | None = None, job: Mapping | None = None
) -> dict[str, int]:
    """Parameters of one run: those of the run win over the job's, then the defaults."""
    return {**DEFAULT_PARAMETERS, **(job or {}), **(run or {})}


@dataclass(frozen=True)
class LoadResult:
    batch_id: str
    status: str
    rows: int


def dated_readings(raw: DataFrame, fmt: str = READING_FORMAT, loose: bool = False) -> DataFrame:
    """Header rules, then dates; rows without a valid date are dropped.

    Without any date column the renamed rows come back as they are.
    """
    named = canonical_for_load(standardise(raw, slash=True), loose)
    return drop_bad_dates(named, fmt=fmt) if "noted_date" in named.columns else named


def numbered(df: DataFrame, order: str = "_row") -> DataFrame:
    """Number the rows from 0 in source order, unless they bring their number.

    Rows read with their position (``_ord``) are numbered by file, block and row.
    """
    if order in df.columns:
        return df
    return with_row_number(df, order, POSITION if POSITION in df.columns else None)


def needs_numbers(df: DataFrame) -> bool:
    """Whether a device id must be made of a row number: the column or a value is missing."""
    if "_row" in df.columns or "id" not in df.columns:
        return True
    device = F.col("id").cast("string")
    return not df.where(device.isNull() | (F.trim(device) == "")).limit(1).isEmpty()


def prepare(raw: DataFrame, fmt: str = READING_FORMAT, loose: bool = False) -> DataFrame:
    """Dated rows with their number, which is only worked out when an id is made of it."""
    dated = dated_readings(raw, fmt, loose)
    return numbered(dated) if needs_numbers(dated) else dated.withColumn("_row", F.lit(0))


def full_records(prepared: DataFrame, batch_id: str, strict_numbers: bool = False) -> DataFrame:
    """Prepared rows in the layout of the full-load table."""
    temp = F.col("temp").cast("double") if strict_numbers else to_number("temp")
    room = "room_id_id" if "room_id_id" in prepared.columns else None
    return prepared.where(F.col("noted_date").isNotNull()).select(
        "noted_date",
        temp.alias("temperature"),
        location("out_in").alias("location"),
        device_id_full("id", room, "_row").alias("device_id"),
        F.lit(batch_id).alias("batch_id"),
    )


def incremental_records(recent: DataFrame, batch_id: str) -> DataFrame:
    """Rows of the window in the table layout, the last one per (date, device)."""
    present = set(recent.columns)
    temp = to_number("temp") if "temp" in present else F.lit(None).cast("double")
    place = location("out_in") if "out_in" in present else F.lit("unknown")
    device = F.col("id") if "id" in present else F.lit(None).cast("string")
    rows = recent.select(
        "noted_date",
        temp.alias("temperature"),
        place.alias("location"),
        device_id_incremental(device, "_row").alias("device_id"),
        F.lit(batch_id).alias("batch_id"),
        F.col(POSITION if POSITION in present else "_row").alias("_last"),
    )
    return keep_last(rows, ("noted_date", "device_id"), "_last").drop("_last")


def _logged(spark, history: TableSpec, kind: str, batch_id: str | None, work) -> LoadResult:
    """Run ``work(batch_id)`` between a ``started`` row and its outcome row."""
    started = dt.datetime.now(dt.timezone.utc)
    batch_id = batch_id or log.batch_name({"incremental": "inc"}.get(kind, kind), started)
    create(spark, history)
    log.record(spark, history, kind, batch_id, log.STARTED, started)
    try:
        status, rows = work(batch_id)
    except Exception as error:
        log.record(spark, history, kind, batch_id, log.FAILED, started, error=str(error))
        raise
    log.record(spark, history, kind, batch_id, status, started, rows)
    return LoadResult(batch_id, status, rows)


def full_load(
    spark: SparkSession,
    raw: DataFrame,
    table: TableSpec = FULL,
    history: TableSpec = log.HISTORY,
    batch_id: str | None = None,
    fmt: str = READING_FORMAT,
    loose: bool = False,
    strict_numbers: bool = False,
) -> LoadResult:
    """Replace the whole table by the rows of ``raw``."""
    create(spark, table)

    def work(batch: str) -> tuple[str, int]:
        with shuffles_sized_for(raw):
            replace_all(full_records(prepare(raw, fmt, loose), batch, strict_numbers), table)
        return log.SUCCESS, read(spark, table).count()

    return _logged(spark, history, "full", batch_id, work)


def _loaded(
    spark: SparkSession, records: DataFrame, table: TableSpec, batch: str, rejects: TableSpec
) -> tuple[str, int]:
    """Upsert a batch and keep the rows the table refuses; its outcome by the rule of ``history.outcome``.

    Rows are judged, counted and stored in one pass over the source. The newest date is
    known here. One row stands for each key, as ``records`` has the last one.
    """
    with screened(records, table) as found:
        if found.errors:
            keep_rejects(spark, found.refused, "incremental", batch, table, rejects)
        taken = found.rows - found.errors
        counts = spark.range(1).select(
            log.outcome(F.lit("known"), F.lit(found.rows), F.lit(taken), F.lit(found.errors))
        )
        loaded = upsert_partitions(found.taken, table, check_key=False) if taken else 0
        return counts.first()[0], loaded


def incremental_load(
    spark: SparkSession,
    raw: DataFrame,
    days: int | None = None,
    table: TableSpec = INCREMENTAL,
    history: TableSpec = log.HISTORY,
    batch_id: str | None = None,
    fmt: str = READING_FORMAT,
    loose: bool = False,
    cap_days: int | None = None,
    run: Mapping | None = None,
    job: Mapping | None = None,
    rejects: TableSpec = REJECTS,
) -> LoadResult:
    """Upsert the rows of the last days by (date, device).

    Rows the table refuses go to ``rejects`` with the reason, the others are loaded:
    the outcome is then ``partial``, or ``no_valid_data`` when none is left. Without ``days``, the parameters of the ``run`` and the ``job`` decide.

    ``cap_days=PREPARED_DAYS`` adds the preparation step's own cut. The batch is
    written once to the shared folder; the row count, the touched days and the
    merge all read that copy.
    """
    create(spark, table)
    days = run_parameters(run, job)["last_n_days"] if days is None else days

    def work(batch: str) -> tuple[str, int]:
        dated = dated_readings(raw, fmt, loose)
        if "noted_date" not in dated.columns:
            return log.NO_DATE_COLUMN, 0
        newest = dated.agg(F.max("noted_date")).first()[0]
        if newest is None:
            return log.NO_DATE, 0
        # Fallback ids number the rows of the prepared cut, or all dated rows; the
        # window comes first where no row of it needs one.
        if cap_days is not None:
            dated = last_n_days(dated, cap_days, newest=newest)
        recent = last_n_days(dated, days, cap_days=cap_days, newest=newest)
        if needs_numbers(recent):
            recent = last_n_days(numbered(dated), days, cap_days=cap_days, newest=newest)
        else:
            recent = recent.withColumn("_row", F.monotonically_increasing_id())
        return _loaded(spark, incremental_records(recent, batch), table, batch, rejects)

    return _logged(spark, history, "incremental", batch_id, work)


def load_summary(
    spark: SparkSession, table: TableSpec, history: TableSpec, kind: str | None = None
) -> dict[str, DataFrame]:
    """What a load leaves behind: table statistics and the newest batch."""
    loaded = read(spark, table)
    return {
        "stats": table_stats(loaded, value="temperature"),
        "devices": load_stats(loaded),
        "last_load": log.latest_loads(log.batches(spark, history), 1, kind),
    }


def batch_summary(
    spark: SparkSession, table: TableSpec, batch_id: str, newest: int = 5
) -> dict[str, DataFrame]:
    """Rows per day, covered days and temperatures of one batch."""
    loaded = read(spark, table)
    return {
        "days": batch_days(loaded, batch_id, newest),
        "span": day_span(batch_rows(loaded, batch_id)),
        "stats": batch_stats(loaded, batch_id),
    }


def quick_check(spark: SparkSession, table: TableSpec, history: TableSpec) -> dict[str, DataFrame]:
    """Counts and duplicate keys of an incremental table, and the last three batches."""
    return {
        "quality": load_quality(read(spark, table)),
        "last_loads": log.latest_loads(log.batches(spark, history), 3),
    }
