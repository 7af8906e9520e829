"""Temperature processing: clean, trim, summarise, rank, report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.coerce import READING_FORMAT, drop_bad_dates, drop_bad_numbers
from millrace.functions.headers import apply_aliases, canonical_for_processing, standardise
from millrace.functions.text import normalised
from millrace.operators.quantiles import between, percentile_trim, quantiles, trim_report
from millrace.operators.ranking import temperature_extremes, top_days
from millrace.operators.summaries import daily_mean, daily_summary, table_stats
from millrace.session import materialize
from millrace.sinks.reports import summary_lines, write_text
from millrace.sinks.tables import TableSpec, create, read, replace_all, upsert_all
from millrace.sources.delimited import write_delimited

TRIM = (0.05, 0.95)  # fixed values: percentiles kept
NOW = {"created_at": "current_timestamp()"}

DATA = TableSpec(
    name="temperature_data",
    ddl="noted_date DATE, temp DOUBLE, out_in STRING, created_at TIMESTAMP",
    defaults=NOW,
)
SUMMARY = TableSpec(
    name="temperature_summary",
    ddl=(
        "date DATE, avg_temp DOUBLE, min_temp DOUBLE, max_temp DOUBLE, "
        "record_count BIGINT, created_at TIMESTAMP"
    ),
    key=("date",),
    defaults=NOW,
)
EXTREMES = TableSpec(
    name="temperature_extremes",
    ddl="date DATE, temperature DOUBLE, type STRING, rank INT, created_at TIMESTAMP",
    defaults=NOW,
)
TABLES = {"data": DATA, "summary": SUMMARY, "extremes": EXTREMES}


def inside_readings(df: DataFrame, column: str = "out/in") -> DataFrame:
    """Rows measured inside; the label itself is normalised. Skipped without the column."""
    if column not in df.columns:
        return df
    return df.withColumn(column, normalised(F.col(f"`{column}`"))).where(F.col(f"`{column}`") == "in")


def usable_readings(raw: DataFrame, fmt: str = READING_FORMAT) -> DataFrame:
    """Header rules, inside filter, day and number coercion; before the trim."""
    df = apply_aliases(canonical_for_processing(standardise(raw)))
    df = inside_readings(df)
    missing = {"noted_date", "temp"} - set(df.columns)
    if missing:
        raise ValueError(f"columns {sorted(missing)} not found among {raw.columns}")
    df = drop_bad_numbers(drop_bad_dates(df, fmt=fmt))
    return df.withColumn("noted_date", F.to_date("noted_date"))


def clean_readings(raw: DataFrame, fmt: str = READING_FORMAT) -> DataFrame:
    return percentile_trim(usable_readings(raw, fmt), "temp", *TRIM)


def process(
    spark: SparkSession,
    raw: DataFrame,
    fmt: str = READING_FORMAT,
    tables: Mapping[str, TableSpec] = TABLES,
    top: int = 5,
    output: str | None = None,
) -> dict[str, DataFrame]:
    """Run the whole job and return its tables and reports as DataFrames.

    The usable rows are written once to the shared folder: the raw text is
    parsed a single time, and the percentile passes read one column of that
    copy. With an ``output`` folder the trimmed rows, all their columns, also go
    to ``results`` (CSV) and the report to ``summary`` (text) in it, replacing
    those of an earlier run.
    """
    data, summary, extremes = tables["data"], tables["summary"], tables["extremes"]
    for spec in (data, summary, extremes):
        create(spark, spec)
    usable = materialize(usable_readings(raw, fmt), "usable-readings")
    bounds = quantiles(usable, "temp", TRIM)
    limits = trim_report(usable, bounds)
    trimmed = between(usable, "temp", bounds)
    replace_all(trimmed.withColumnsRenamed({"out/in": "out_in"}), data)

    loaded = read(spark, data)
    # An upsert: days missing from this run stay and can still rank.
    upsert_all(daily_summary(loaded), summary, on_update=("created_at",))
    replace_all(temperature_extremes(read(spark, summary), top), extremes)

    daily = daily_mean(loaded)
    report = summary_lines(limits, daily, top)
    if output is not None:
        write_delimited(trimmed, f"{output}/results", "overwrite")
        write_text(report, f"{output}/summary", "overwrite")
    return {
        "data": loaded,
        "summary": read(spark, summary),
        "extremes": read(spark, extremes),
        "hottest": top_days(daily, top, hottest=True),
        "coldest": top_days(daily, top, hottest=False),
        "limits": limits,
        "stats": table_stats(loaded),
        "report": report,
    }
